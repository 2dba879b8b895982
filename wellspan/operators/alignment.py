"""Registration of masked images by normalised cross-correlation over all shifts, and warps by a matrix.

The six sums that a masked correlation needs are correlations themselves, so all shifts come from
Fourier transforms: along rows, then along columns in strips of 64 frequencies, and back.  No task
holds more than a line or a strip of an image, and nothing is exploded by shift.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pixels import otsu

STRIP = 64
#: What is correlated: reference values, mask and squares with those of the moving image.
PARTS, PAIRS = 6, ((1, 4), (0, 4), (1, 3), (0, 3), (2, 4), (1, 5))


def _length(n: int) -> int:
    """A power of two that holds all shifts of lines of n places without overlap."""
    return 1 << (2 * n - 2).bit_length()


def _slices(names: list[str], own: pa.RecordBatch, rows: list[tuple[int, int, int, np.ndarray]], extra: str) -> pa.RecordBatch:
    at = pa.array([r[0] for r in rows])
    return pa.record_batch([*(own[c].take(at) for c in names), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([np.ascontiguousarray(r[3]).tobytes() for r in rows], pa.binary())], names=[*names, extra, "block_", "data_"])


def _rows_to_frequencies(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, (y, w, x0) in enumerate(zip(b["y"].to_pylist(), b["w_"].to_pylist(), b["x0_"].to_pylist())):
                p = b["line_"].slice(i, 1).flatten()
                x, a, ma, v, mb = (p.field(k).to_numpy(zero_copy_only=False).astype(float) for k in range(5))
                line = np.zeros((PARTS, w))
                line[:, x.astype(int) - x0] = a * ma, ma, a * a * ma, v * mb, mb, v * v * mb
                spectrum = np.fft.rfft(line, _length(w), axis=1)
                rows += [(i, y, k, spectrum[:, k * STRIP : (k + 1) * STRIP]) for k in range(-(-spectrum.shape[1] // STRIP))]
            if rows:
                yield _slices(names, b, rows, "y")

    return run


def _products(names: list[str]):
    """Strips of frequencies: transformed along y, multiplied, and back to shifts along y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                lines = b["strip_"][i].as_py()
                parts = [np.frombuffer(r["data_"], complex).reshape(PARTS, -1) for r in lines]
                h, y0 = b["h_"][i].as_py(), b["y0_"][i].as_py()
                strip = np.zeros((PARTS, h, parts[0].shape[1]), complex)
                for r, part in zip(lines, parts):
                    strip[:, r["y"] - y0] = part
                size = _length(h)
                spectrum = np.fft.fft(strip, size, axis=1)
                shifts = np.fft.ifft(np.stack([spectrum[p] * spectrum[q].conj() for p, q in PAIRS]), axis=1)
                rows = [(i, dy, b["block_"][i].as_py(), shifts[:, dy % size]) for dy in range(1 - h, h)]
                yield _slices(names, b, rows, "dy")

    return run


def _coefficients(names: list[str]):
    """Back along x: for one shift in y, the overlap and the coefficient at every shift in x."""
    schema_tail = [pa.field("dy", pa.int32()), pa.field("most_", pa.float64()), pa.field("n_", pa.binary()), pa.field("r_", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, w in enumerate(b["w_"].to_pylist()):
                parts = sorted(b["parts_"][i].as_py(), key=lambda r: r["block_"])
                spectrum = np.concatenate([np.frombuffer(r["data_"], complex).reshape(len(PAIRS), -1) for r in parts], axis=1)
                size = _length(w)
                n, a, v, av, aa, vv = np.fft.irfft(spectrum, size, axis=1)[:, np.arange(1 - w, w) % size]
                n = np.rint(n)
                some = np.maximum(n, 1)
                of_a, of_v = aa - a * a / some, vv - v * v / some
                # Transforms leave some 1e-14 of what is summed: a spread below that is none.
                sound = (n >= 2) & (of_a > 1e-10 * np.abs(aa).max()) & (of_v > 1e-10 * np.abs(vv).max())
                r = np.where(sound, (av - a * v / some) / np.sqrt(np.where(sound, of_a * of_v, 1.0)), -np.inf)
                out.append((n.max(), n.tobytes(), np.minimum(r, 1.0).tobytes()))
            if out:
                columns = [b["dy"], *(pa.array([o[k] for o in out], f.type) for k, f in enumerate(schema_tail[1:]))]
                yield pa.record_batch([*(b[c] for c in names), *columns], names=[*names, *(f.name for f in schema_tail)])

    return run


def _best_in_row(names: list[str], overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for n, r, most in zip(b["n_"].to_pylist(), b["r_"].to_pylist(), b["all_"].to_pylist()):
                n, r = np.frombuffer(n), np.frombuffer(r)
                r = np.round(np.where(n >= overlap * most, r, -np.inf), 9)
                at = np.flatnonzero(r == r.max()) - len(r) // 2
                found.append((float(r.max()), float(at.sum()), len(at)))
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.float64(), pa.float64(), pa.int64()))]
            yield pa.record_batch([*(b[c] for c in names), b["dy"], *columns], names=[*names, "dy", "r", "sum_", "ties_"])

    return run


def masked_shift(pairs: DataFrame, key: list[str], kept: Callable[[DataFrame], DataFrame], overlap: float = 0.3) -> DataFrame:
    """(key, dy, dx, r): the shift of the moving image under which it correlates best with the reference.

    ``pairs`` has (key, y, x, a, ma, b, mb): both images in one frame, with masks of 0 and 1.
    Each shift's correlation is that of the pixels which both masks hold there; shifts whose
    overlap is less than ``overlap`` of the largest one do not count, and equal coefficients
    (to nine digits) give the mean of their shifts.  Keys without two masked pixels in common
    have no row.
    """
    kinds = "".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}, " for c in key)
    frame = kept(pairs.groupBy(*key).agg(F.min("y").cast("int").alias("y0_"), (F.max("y") - F.min("y") + 1).cast("int").alias("h_"), F.min("x").cast("int").alias("x0_"), (F.max("x") - F.min("x") + 1).cast("int").alias("w_")))
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    rows = pairs.groupBy(*key, F.col("y").cast("int").alias("y")).agg(F.collect_list(F.struct(F.col("x").cast("int").alias("x"), *map(value, ("a", "ma", "b", "mb")))).alias("line_"))
    across = rows.join(frame.select(*key, "x0_", "w_"), key).mapInArrow(_rows_to_frequencies(key), f"{kinds}y int, block_ int, data_ binary")
    strips = across.groupBy(*key, "block_").agg(F.collect_list(F.struct("y", "data_")).alias("strip_")).join(frame.select(*key, "y0_", "h_"), key)
    shifts = strips.mapInArrow(_products(key), f"{kinds}dy int, block_ int, data_ binary")
    lines = shifts.groupBy(*key, "dy").agg(F.collect_list(F.struct("block_", "data_")).alias("parts_")).join(frame.select(*key, "w_"), key)
    table = kept(lines.mapInArrow(_coefficients(key), f"{kinds}dy int, most_ double, n_ binary, r_ binary"))
    most = table.groupBy(*key).agg(F.max("most_").alias("all_"))
    best = table.join(most, key).mapInArrow(_best_in_row(key, overlap), f"{kinds}dy int, r double, sum_ double, ties_ long").where(F.col("r") > F.lit(float("-inf")))
    top = best.groupBy(*key).agg(F.max("r").alias("top_"))
    tied = best.join(top, key).where("r = top_")
    n = F.sum("ties_")
    return tied.groupBy(*key).agg((F.sum(F.col("dy") * F.col("ties_")) / n).alias("dy"), (F.sum("sum_") / n).alias("dx"), F.first("top_").alias("r"))


def alignment(reference: DataFrame, moving: DataFrame, key: list[str], kept: Callable[[DataFrame], DataFrame], offset: Sequence[int] = (0, 0)) -> DataFrame:
    """(key, dy, dx, matrix): the stored 3 x 3 matrix that takes places of the reference to the moving image.

    Only pixels above each image's two-class threshold take part.  ``offset`` (rows, columns)
    moves the moving image beforehand and is part of the matrix; what it moves in is dark.
    """
    down, right = offset
    images = {}
    for n, df in (("a", reference), ("b", moving)):
        level = df.join(otsu(df, key, "v"), key)
        images[n] = level.select(*key, "y", "x", F.col("v").alias(n), F.when(F.col("v") > F.col("threshold"), 1.0).otherwise(0.0).alias(f"m{n}"))
    there = images["b"].withColumns({"y": F.col("y") + F.lit(down), "x": F.col("x") + F.lit(right)})
    pairs = images["a"].join(there, [*key, "y", "x"], "left").fillna(0.0, ["b", "mb"])
    found = masked_shift(pairs, key, kept)
    one, zero = F.lit(1.0), F.lit(0.0)
    matrix = F.array(one, zero, -F.col("dx") - F.lit(float(right)), zero, one, -F.col("dy") - F.lit(float(down)), zero, zero, one)
    return found.select(*key, "dy", "dx", matrix.alias("matrix"))


def warped(pixels: DataFrame, matrices: DataFrame, key: list[str], planes: Sequence[str] = ()) -> DataFrame:
    """(key, planes, y, x, v): images as their ``matrix`` (nine numbers by rows) takes them from the source.

    Each place of the frame takes the nearest pixel (halves to the even one) at the matrix
    times (x, y, 1), in each of the ``planes``; places that come from outside are 0.  Any
    affine matrix will do: shifts, turns, scales and shears.  One join by pixel.
    """
    at = [*key, *planes]
    m = lambda i: F.col("matrix")[i]
    places = pixels.select(*at, "y", "x").join(matrices.select(*key, "matrix"), key)
    source = lambda i: F.rint(m(i) * F.col("x") + m(i + 1) * F.col("y") + m(i + 2)).cast("int")
    places = places.select(*at, "y", "x", source(3).alias("sy_"), source(0).alias("sx_"))
    values = pixels.select(*at, F.col("y").alias("sy_"), F.col("x").alias("sx_"), "v")
    return places.join(values, [*at, "sy_", "sx_"], "left").select(*at, "y", "x", F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v"))
