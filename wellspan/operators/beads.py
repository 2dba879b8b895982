"""Point spread functions assembled from crops of beads.

A crop is one row: ``pixels`` (array of doubles, planes by rows by columns) of one ``shape``.
Crops stay where they are: what they need of their group (its first crop, its spreads) is one
small row a group, and what they give to it is summed within tasks, so a group that holds most
of all crops spreads over all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fractions
from .filters import within_spread
from .quantiles import same_key, small_side

if TYPE_CHECKING:
    import pandas as pd

#: Two-sided 90 % of a normal distribution.
SPREADS = 1.644854
Shape = tuple[int, int, int]


def _fields(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def measured_crops(crops: DataFrame, key: list[str], order: str, shape: Shape) -> DataFrame:
    """(key, order, pixels, intensity, background) of crops over their largest values.

    ``intensity`` is the mean from the crop's two-class threshold on, ``background`` the 90th
    percentile of its border diagonals.  Null crops, and such of another size, with a value
    that is not finite or without one above 0, are no beads and go.
    """
    size = int(np.prod(shape))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [np.asarray(p, float) for p in pdf["pixels"]]
            sound = [p.size == size and np.isfinite(p).all() and p.max() > 0 for p in rows]
            out, images = pdf[sound].copy(), [p.reshape(shape) / p.max() for p, s in zip(rows, sound) if s]
            bright = [np.where(i < fractions.two_class_threshold(i), 0.0, i) for i in images]
            edges = [fractions.border_diagonal(i) for i in images]
            out["pixels"] = [i.ravel() for i in images]
            out["intensity"] = [float(b.sum() / max(1, (b > 0).sum())) for b in bright]
            out["background"] = [float(np.percentile(e, 90)) if e.size else 0.0 for e in edges]
            yield out

    chosen = crops.where(F.col("pixels").isNotNull()).select(*key, order, F.col("pixels").cast("array<double>").alias("pixels"))
    return chosen.mapInPandas(run, f"{_fields(chosen, [*key, order])}, pixels array<double>, intensity double, background double")


def fractional_shifts(pairs: DataFrame, key: list[str], shape: Shape, upsample: int = 5, keep: bool = False) -> DataFrame:
    """(key, shift, error) that move array ``moving`` onto array ``reference``; see ``fractional_shift``.

    With ``keep`` also ``pixels``, the moved array.
    """
    kinds = f"{_fields(pairs, key)}, shift array<double>, error double{', pixels array<double>' if keep else ''}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            still, moving = ([np.asarray(p, float).reshape(shape) for p in pdf[c]] for c in ("reference", "moving"))
            found = [fractions.fractional_shift(a, b, upsample) for a, b in zip(still, moving)]
            out = pdf[key].copy()
            out["shift"], out["error"] = [list(s) for s, _ in found], [e for _, e in found]
            if keep:
                out["pixels"] = [fractions.shifted(b, s).ravel() for b, (s, _) in zip(moving, found)]
            yield out

    return pairs.select(*key, "reference", "moving").mapInPandas(run, kinds)


def _summed(moved: DataFrame, key: list[str]) -> DataFrame:
    """(key, n_beads, mean): per batch one sum a key, then one sum over batches a voxel."""
    schema = f"{_fields(moved, key)}, n_ long, pixels array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            clear = [np.maximum(np.asarray(p, float) - b, 0.0) for p, b in zip(pdf["pixels"], pdf["background"])]
            scaled, group = [c / (c.max() or 1.0) for c in clear], pdf.groupby(key, dropna=False, sort=False).ngroup().to_numpy()
            out = pdf.loc[~pdf.duplicated(key), key].copy()
            out["n_"] = np.bincount(group, minlength=len(out)) if len(out) else []
            out["pixels"] = [np.sum([scaled[i] for i in np.flatnonzero(group == k)], axis=0) for k in range(len(out))]
            yield out

    parts = moved.select(*key, "pixels", "background").mapInPandas(run, schema)
    voxels = parts.select(*key, "n_", F.posexplode("pixels").alias("at_", "v_")).groupBy(*key, "at_").agg(F.sum("n_").alias("n_"), F.sum("v_").alias("v_"))
    whole = voxels.groupBy(*key).agg(F.max("n_").alias("n_beads"), F.array_sort(F.collect_list(F.struct("at_", (F.col("v_") / F.col("n_")).alias("v")))).alias("all_"))
    return whole.select(*key, "n_beads", F.col("all_.v").alias("mean"))


def _finished(means: DataFrame, key: list[str], shape: Shape, trim: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for m in pdf["mean"]:
                psf = np.maximum(np.asarray(m, float).reshape(shape), 0.0)
                psf /= psf.max() or 1.0
                bright = np.where(psf < fractions.two_class_threshold(psf), 0.0, psf)
                if bright.sum() > 0:
                    middle = [round(shape[0] / 2), round(shape[1] / 2), round(shape[1] / 2)]
                    shift = [0.0 if n == 1 else c - m for n, c, m in zip(shape, middle, fractions.centre_of_mass(bright))]
                    psf = fractions.shifted(psf, tuple(shift))
                    psf /= psf.max() or 1.0
                edge = fractions.border_diagonal(psf)
                level, psf = float(edge.max()) if edge.size else 0.0, fractions.trimmed(psf, trim)
                made.append((list(psf.shape), fractions.as_uint16(psf).ravel(), fractions.as_uint16(psf - level).ravel()))
            out = pdf[[*key, "n_beads"]].copy()
            for c, v in zip(("shape", "psf", "psf_clear"), zip(*made)):
                out[c] = list(v)
            yield out

    return means.mapInPandas(run, f"{_fields(means, key)}, n_beads long, shape array<int>, psf array<int>, psf_clear array<int>")


def assembled(crops: DataFrame, key: list[str], order: str, shape: Shape, kept: Callable[[DataFrame], DataFrame], upsample: int = 5, spreads: float = SPREADS, trim: int = 2) -> DataFrame:
    """(key, n_beads, shape, psf, psf_clear): the mean of each group's beads, 16 unsigned bits.

    Beads whose brightness lies ``spreads`` deviations from their group's mean are left out.
    The others are moved onto the group's first one (smallest ``order``, which only serves as
    that and is no part of the mean), less the group's mean background, and over their
    largest value; beads whose error of registration is an outlier are left out too.  The
    mean is moved so that its bright part has its centre of mass in the middle, and trimmed.
    ``psf_clear`` is ``psf`` less the largest value on its border diagonals.  Rows that tie
    for the first place are told apart by their pixels; such as equal it in both count as it.
    A group without a second bead has no row.  Integers beside nulls are exact up to 2**53.
    """
    sound = kept(within_spread(measured_crops(crops, key, order, shape), "intensity", spreads, key))
    first = sound.groupBy(*key).agg(F.min(F.struct(F.col(order).isNull().alias("no_"), order, "pixels")).alias("first_"), F.avg("background").alias("mean_"), F.count(F.lit(1)).alias("n_"))
    group = small_side(kept(first.where("n_ > 1").select(*key, "first_", F.col("first_.pixels").alias("reference"), "mean_")))
    beads = same_key(sound.select(*key, order, F.col("pixels").alias("moving")), group, key)
    others = beads.where(~(F.col(order).eqNullSafe(F.col(f"first_.{order}")) & (F.col("moving") == F.col("reference")))).withColumn("background", F.col("mean_"))
    moved = fractional_shifts(others, [*key, order, "background"], shape, upsample, keep=True)
    return _finished(_summed(within_spread(kept(moved), "error", spreads, key), key), key, shape, trim)
