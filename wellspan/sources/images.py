"""A batch data source for image stacks kept as plain arrays, one row per plane.

Vendor formats need their own readers; whatever can give (name, array) plugs in through
``PlaneReader``.  The built-in reader understands ``.npy`` files with axes C, Z, Y, X.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

PLACE = re.compile(r"/(?P<plate>[^/]+)/(?P<row>[^/]+)/(?P<col>[^/]+)/(?P<field>\d+)[^/]*$")
PLANES = "plate string, row string, col string, field int, channel int, plane int, height int, width int, pixels array<int>"


class PlaneReader:
    """Turns the bytes of a file into a stack with axes C, Z, Y, X."""

    def stack(self, content: bytes) -> np.ndarray:
        found = np.load(io.BytesIO(content), allow_pickle=False)
        return found.reshape((1,) * (4 - found.ndim) + found.shape)


def planes(spark: SparkSession, folder: str, pattern: str = "*.npy", reader: PlaneReader | None = None) -> DataFrame:
    """All planes below ``folder/plate/row/col/field*``; files are read on the executors.

    Filters on the path columns come before decoding if they are put on ``binaryFile``'s
    path; column pruning does not reach into files.
    """
    use = reader or PlaneReader()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def decode(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                at = PLACE.search(path)
                if at is None:
                    continue
                stack = use.stack(content)
                rows = [(at["plate"], at["row"], at["col"], int(at["field"]), c, z, *stack.shape[2:], stack[c, z].ravel().astype(int)) for c in range(stack.shape[0]) for z in range(stack.shape[1])]
                yield pd.DataFrame(rows, columns=["plate", "row", "col", "field", "channel", "plane", "height", "width", "pixels"])

    return files.mapInPandas(decode, PLANES)
