"""A Python data source for image stacks that opens no file which a filter rules out.

Files stand at ``folder/plate/row/col/field*.npy``.  The driver lists folders down to wells and
no further; each partition is some wells, whose files tasks list and open.  Equality and ``IN``
filters on plate, row, col and field, and the deny list, are settled by names alone; filters on
channel and plane keep other planes of a file from being decoded into rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from ..session import with_code
from .images import PLANES

FIELD = re.compile(r"^(\d+)[^/]*\.npy$")
NAMED = ("plate", "row", "col", "field", "channel", "plane")


@dataclass
class Wells(InputPartition):
    """Well folders that one task reads."""

    folders: list[tuple[str, str, str, str]]


def _parts(options: dict[str, str]) -> tuple[object, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] else (fs.LocalFileSystem(), options["path"])


class PlaneReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.allowed: dict[str, set] = {}
        self.denied = {tuple(w) for w in json.loads(options.get("denied", "[]"))}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Settle what names can settle; Spark applies the rest."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in NAMED:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.allowed[name] = self.allowed.get(name, values) & values
            else:
                yield f

    def _wanted(self, name: str, value: object) -> bool:
        return name not in self.allowed or value in self.allowed[name]

    def partitions(self) -> list[Wells]:
        from pyarrow import fs

        system, root = _parts(self.options)

        def below(folder: str, name: str) -> list[tuple[str, str]]:
            found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            return sorted((f.path, f.base_name) for f in found if f.type == fs.FileType.Directory and self._wanted(name, f.base_name))

        wells = [(path, plate, row, col) for at, plate in below(root, "plate") for mid, row in below(at, "row") for path, col in below(mid, "col") if (plate, row, col) not in self.denied]
        size = int(self.options.get("wells_a_task", "4"))
        return [Wells(wells[i : i + size]) for i in range(0, len(wells), size)]

    def read(self, partition: Wells | None) -> Iterator[tuple]:
        if partition is None:  # Spark reads once even where there is nothing
            return
        import io

        import numpy as np
        from pyarrow import fs

        system, _ = _parts(self.options)
        for folder, plate, row, col in partition.folders:
            for file in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda f: f.path):
                name = FIELD.match(file.base_name)
                if file.type != fs.FileType.File or name is None or not self._wanted("field", int(name[1])):
                    continue
                with system.open_input_stream(file.path) as stream:
                    stack = np.load(io.BytesIO(stream.read()), allow_pickle=False)
                stack = stack.reshape((1,) * (4 - stack.ndim) + stack.shape)
                for c in range(stack.shape[0]):
                    for z in range(stack.shape[1]):
                        if self._wanted("channel", c) and self._wanted("plane", z):
                            yield plate, row, col, int(name[1]), c, z, *stack.shape[2:], stack[c, z].ravel().astype(int).tolist()


class PlaneSource(DataSource):
    """``format("planes")`` with options ``path``, ``denied`` (JSON list of [plate, row, col]) and ``wells_a_task``."""

    @classmethod
    def name(cls) -> str:
        return "planes"

    def schema(self) -> str:
        return PLANES

    def reader(self, schema: StructType) -> PlaneReader:
        return PlaneReader(dict(self.options))


def planes(spark: SparkSession, folder: str, denied: Iterable[tuple[str, str, str]] = ()) -> DataFrame:
    """All planes below ``folder`` but those of ``denied`` (plate, row, col); filters come before files are opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    with_code(spark).dataSource.register(PlaneSource)
    return spark.read.format("planes").option("path", folder).option("denied", json.dumps([list(w) for w in denied])).load()
