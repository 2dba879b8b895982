"""Operators along the axes of images, whose cost does not grow with the size of their window.

Pixels meet once as whole image rows; what a row gives is cut into slices of 64 columns, and
slices meet again as strips of 64 columns along the next axis.  So a pixel is shuffled once as
a row and then as eight bytes of a slice, whatever a window's size, and a task holds one line or
one strip of one image at a time.  Numpy works on the lines of a batch together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (channels, length, lines) to the same, along the length; or with the places that it keeps.
Along = Callable[[np.ndarray], "np.ndarray | tuple[np.ndarray, np.ndarray]"]

BLOCK = 64


def _applied(f: Along, a: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    out = f(a)
    return out if isinstance(out, tuple) else (out, np.arange(first, first + out.shape[1]))


def _across(f: Along, names: list[str]):
    """Whole rows of images to slices of what ``f`` makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            line = b["line_"]
            if not len(line):
                continue
            stops = line.offsets.to_numpy()
            x, v = (line.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            sizes = np.diff(stops)
            low, high = (g.reduceat(x[stops[0] : stops[-1]], stops[:-1] - stops[0]) for g in (np.minimum, np.maximum))
            whose, blocks, places, data = [], [], [], []
            frames, which = np.unique(np.column_stack([low, high]), axis=0, return_inverse=True)
            for k, (first, last) in enumerate(frames):
                rows = np.flatnonzero(which.ravel() == k)
                a = np.full((1, last - first + 1, len(rows)), np.nan)
                for j, i in enumerate(rows):
                    part = slice(stops[i], stops[i] + sizes[i])
                    a[0, x[part] - first, j] = v[part]
                made, at = _applied(f, a, int(first))
                made, cut = made.transpose(2, 0, 1), np.flatnonzero(np.diff(at // BLOCK)) + 1
                for piece in np.split(np.arange(len(at)), cut):
                    place, parts = at[piece].astype("<i4").tobytes(), np.ascontiguousarray(made[:, :, piece])
                    whose.extend(rows)
                    blocks.extend([int(at[piece[0]] // BLOCK)] * len(rows))
                    places.extend([place] * len(rows))
                    data.extend(p.tobytes() for p in parts)
            own = [b[c].take(pa.array(whose)) for c in names]
            yield pa.record_batch([*own, pa.array(blocks, pa.int32()), pa.array(places, pa.binary()), pa.array(data, pa.binary())], names=[*names, "block_", "at_", "data_"])

    return run


def _down(f: Along, names: list[str], axis: str, channels: int, outputs: list[str]):
    """Strips, met from slices, to pixels of what ``f`` makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = b["strip_"][i].as_py()
                at = [np.frombuffer(r["at_"], "<i4") for r in rows]
                columns = np.unique(np.concatenate(at))
                line = np.array([r["line"] for r in rows])
                first = int(line.min())
                a = np.full((channels, int(line.max()) - first + 1, len(columns)), np.nan)
                for r, places, y in zip(rows, at, line, strict=True):
                    a[:, y - first, np.searchsorted(columns, places)] = np.frombuffer(r["data_"], float).reshape(channels, -1)
                made, ys = _applied(f, a, first)
                real = ~np.isnan(made).all(axis=0)
                y, x = np.nonzero(real)
                own = [b[c].take(pa.array(np.full(len(y), i))) for c in names]
                yield pa.record_batch([*own, pa.array(ys[y].astype(np.int32)), pa.array(columns[x].astype(np.int32)), *(pa.array(m[real]) for m in made)], names=[*names, axis, "x", *outputs])

    return run


def transformed(pixels: DataFrame, key: list[str], across: Along, down: Along, outputs: list[str], channels: int = 1, value: str = "v") -> DataFrame:
    """(key, y, x, outputs...): ``across`` along rows and then ``down`` along columns.

    ``across`` gets one channel and gives ``channels``, ``down`` gives one for each output.
    Where all outputs are NaN no pixel comes out; missing pixels are NaN on the way in.  Rows
    with a null coordinate are no pixels.  A pixel that comes twice counts once.
    """
    kinds = lambda names: ", ".join(f"`{c}` {pixels.schema[c].dataType.simpleString()}" for c in names)
    whole = pixels.where("y is not null and x is not null").groupBy(*key, "y").agg(F.collect_list(F.struct(F.col("x").cast("int").alias("x"), F.col(value).cast("double").alias("v"))).alias("line_"))
    slices = whole.withColumn("y", F.col("y").cast("int")).mapInArrow(_across(across, [*key, "y"]), f"{kinds(key)}, y int, block_ int, at_ binary, data_ binary")
    strips = slices.groupBy(*key, "block_").agg(F.collect_list(F.struct(F.col("y").alias("line"), "at_", "data_")).alias("strip_"))
    return strips.mapInArrow(_down(down, key, "y", channels, outputs), f"{kinds(key)}, y int, x int, {', '.join(f'{c} double' for c in outputs)}")


def _windowed(a: np.ndarray, width: int) -> np.ndarray:
    """Sums of ``width`` neighbours, by differences of running sums."""
    total = np.cumsum(np.concatenate([np.zeros_like(a[:, :1]), a], axis=1), axis=1)
    return total[:, width:] - total[:, :-width]


def box_mean(width: int) -> Along:
    """Means of ``width`` (odd) neighbours; lines go on as in a mirror that does not repeat the edge.

    Missing values are passed over.
    """

    def f(a: np.ndarray) -> np.ndarray:
        r = width // 2
        wide = np.pad(a, ((0, 0), (r, r), (0, 0)), mode="reflect")
        gone = np.isnan(wide)
        if not gone.any():
            return _windowed(wide, width) / width
        n = _windowed((~gone).astype(float), width)
        return np.where(np.isnan(a), np.nan, _windowed(np.where(gone, 0.0, wide), width) / np.maximum(n, 1))

    return f


def running_extreme(a: np.ndarray, reach: int, largest: bool) -> np.ndarray:
    """Largest or smallest value up to ``reach`` places away, by extremes of blocks from both sides."""
    if not reach:
        return a
    g, out, width = (np.maximum, -np.inf, 2 * reach + 1) if largest else (np.minimum, np.inf, 2 * reach + 1)
    c, n, w = a.shape
    whole = -(-(n + 2 * reach) // width) * width
    padded = np.full((c, whole, w), out)
    padded[:, reach : reach + n] = np.where(np.isnan(a), out, a)
    blocks = padded.reshape(c, -1, width, w)
    ahead = g.accumulate(blocks, axis=2).reshape(c, whole, w)
    behind = g.accumulate(blocks[:, :, ::-1], axis=2)[:, :, ::-1].reshape(c, whole, w)
    return g(behind[:, :n], ahead[:, 2 * reach : 2 * reach + n])


def _disk_steps(radius: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Half-widths of a disk's rows, and for each row offset which of them it has."""
    half = {dy: int((radius * radius - dy * dy) ** 0.5) for dy in range(-radius, radius + 1)}
    widths = sorted(set(half.values()))
    return widths, [(dy, widths.index(w)) for dy, w in half.items()]


def extreme_in_disk(pixels: DataFrame, key: list[str], radius: int, largest: bool, value: str = "v") -> DataFrame:
    """Largest or smallest value within a disk; the outside of the image does not count.

    A disk is its rows: each half-width is one running extreme along x, and rows are put
    together along y, so a pixel costs some ``4 * radius`` comparisons and is sent
    ``radius`` + 1 times at most, as eight bytes.
    """
    widths, steps = _disk_steps(radius)
    out = -np.inf if largest else np.inf

    def across(a: np.ndarray) -> np.ndarray:
        return np.concatenate([running_extreme(a, w, largest) for w in widths] + [np.where(np.isnan(a), np.nan, 0.0)])

    def down(a: np.ndarray) -> np.ndarray:
        n = a.shape[1]
        filled = np.where(np.isnan(a[:-1]), out, a[:-1])
        best = np.full(a.shape[1:], out)
        for dy, k in steps:
            if abs(dy) < n:
                low, high = max(0, -dy), min(n, n - dy)
                g = np.maximum if largest else np.minimum
                best[low:high] = g(best[low:high], filled[k, low + dy : high + dy])
        return np.where(np.isnan(a[-1]), np.nan, best)[None]

    return transformed(pixels, key, across, down, [value], len(widths) + 1, value)


def gaussian_weights(sigma: float, reach: int) -> Along:
    """Gaussian means; at edges and beside missing values the weights inside are normed.

    Wide kernels go through a Fourier transform, so that a line of n values costs n log n.
    """

    def f(a: np.ndarray) -> np.ndarray:
        n = a.shape[1]
        r = min(reach, n - 1)
        kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
        inside = ~np.isnan(a)
        both = np.concatenate([np.where(inside, a, 0.0), inside.astype(float)])
        if r <= 32:
            padded = np.pad(both, ((0, 0), (r, r), (0, 0)))
            sums = sum(kernel[k] * padded[:, k : k + n] for k in range(2 * r + 1))
        else:
            size = 1 << (n + 2 * r - 1).bit_length()
            spectrum = np.fft.rfft(both, size, axis=1) * np.fft.rfft(kernel, size)[None, :, None]
            sums = np.fft.irfft(spectrum, size, axis=1)[:, r : r + n]
        c = len(a)
        return np.where(inside, sums[:c] / np.maximum(sums[c:], 1e-300), np.nan)

    return f


def blurred(pixels: DataFrame, key: list[str], sigma: float, truncate: float = 4.0) -> DataFrame:
    """Gaussian blur of any width, for instance of a mean field by 500 pixels."""
    f = gaussian_weights(sigma, max(1, int(truncate * sigma + 0.5)))
    return transformed(pixels, key, f, f, ["v"])


def local_moments(pixels: DataFrame, key: list[str], width: int) -> DataFrame:
    """(key, y, x, mean, std) of the ``width`` x ``width`` window around each pixel."""
    mean = box_mean(width)

    def across(a: np.ndarray) -> np.ndarray:
        return mean(np.concatenate([a, a * a]))

    p = transformed(pixels, key, across, mean, ["mean", "square_"], 2)
    return p.withColumn("std", F.sqrt(F.greatest(F.col("square_") - F.col("mean") * F.col("mean"), F.lit(0.0)))).drop("square_")


def local_threshold(pixels: DataFrame, key: list[str], width: int = 51, k: float = 0.2, dynamic_range: float = 1.0) -> DataFrame:
    """(key, y, x, threshold): local mean times 1 + k (local deviation / range - 1), as Sauvola has it.

    ``dynamic_range`` is half of what values can span (1 for images of -1 to 1).
    """
    spread: Column = F.col("std") / F.lit(float(dynamic_range)) - 1
    return local_moments(pixels, key, width).select(*key, "y", "x", (F.col("mean") * (spread * F.lit(float(k)) + 1)).alias("threshold"))


def _fourier(share: float | None) -> Along:
    """Discrete Fourier transform of real lines, or of real and imaginary ones.

    Only frequencies whose distance from the nearer end of the table is within ``share`` of
    the length are kept.
    """

    def f(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = np.where(np.isnan(a), 0.0, a)
        line = whole[:1] + 1j * whole[1:] if len(a) == 2 else whole
        n = a.shape[1]
        spectrum, at = np.fft.fft(line, axis=1), np.arange(n)
        if share is not None:
            at = at[np.minimum(at, n - 1 - at) <= share * n]
        return np.concatenate([spectrum.real, spectrum.imag])[:, at], at

    return f


def spectrum(pixels: DataFrame, key: list[str], share: float | None = None) -> DataFrame:
    """(key, y, x, re, im): the two-dimensional discrete Fourier transform; y and x are frequencies.

    With ``share`` only frequencies near the corners of the table come out, and only the
    columns that these need are sent on between the two passes.
    """
    return transformed(pixels, key, _fourier(share), _fourier(share), ["re", "im"], 2)


def power_slope(pixels: DataFrame, key: list[str], share: float = 0.125) -> DataFrame:
    """(key, power_slope): slope of log power over log radius of an image's spectrum.

    A ring holds the frequencies whose distance from the nearest corner of the table has the
    same whole part; rings 2 up to ``share`` of the shorter side, that one left out, are
    fitted by least squares.  0 where the image is constant or has fewer than two such rings.
    """
    size = pixels.groupBy(*key).agg((F.max("y") - F.min("y") + 1).alias("h_"), (F.max("x") - F.min("x") + 1).alias("w_"), (F.min("v") < F.max("v")).alias("varied_"))
    near = lambda c, n: F.least(F.col(c), F.col(n) - 1 - F.col(c))
    p = spectrum(pixels, key, min(share, 1.0)).join(size, key)
    dy, dx = near("y", "h_"), near("x", "w_")
    ring = F.floor(F.sqrt((dy * dy + dx * dx).cast("double"))) + 1
    rings = p.withColumn("ring_", ring).where((F.col("ring_") >= 2) & (F.col("ring_") < F.floor(F.least("h_", "w_") * F.lit(float(share)))))
    power = rings.groupBy(*key, "ring_").agg(F.sum(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("power_")).where("power_ > 0")
    fit = power.groupBy(*key).agg(F.regr_slope(F.log("power_"), F.log(F.col("ring_").cast("double"))).alias("slope_"))
    return size.join(fit, key, "left").select(*key, F.when(F.col("varied_"), F.coalesce("slope_", F.lit(0.0))).otherwise(0.0).alias("power_slope"))
