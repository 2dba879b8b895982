"""Transforms, fits and models over whole images, distributed by image.

An image is one row (an array of pixels), so a hot plate spreads over all tasks: nothing is
grouped but single images.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame

from ..functions import kernels

if TYPE_CHECKING:
    import pandas as pd


def per_image(images: DataFrame, key: list[str], f: Callable[[np.ndarray], np.ndarray], width: int, column: str = "pixels") -> DataFrame:
    """Apply a kernel to each image array; the result is an array of doubles."""
    kinds = dict(images.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), f"{column} array<double>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.copy()
            pdf[column] = [np.asarray(f(np.asarray(p, float).reshape(-1, width)), float).ravel() for p in pdf[column]]
            yield pdf

    return images.select(*key, column).mapInPandas(run, schema)


def registered(pairs: DataFrame, key: list[str], width: int) -> DataFrame:
    """(key, dy, dx): translation that moves array ``moving`` onto array ``reference``."""
    kinds = dict(pairs.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), "dy int, dx int"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [kernels.translation(np.asarray(a, float).reshape(-1, width), np.asarray(b, float).reshape(-1, width)) for a, b in zip(pdf["reference"], pdf["moving"])]
            out = pdf[key].copy()
            out["dy"], out["dx"] = [f[0] for f in found], [f[1] for f in found]
            yield out

    return pairs.select(*key, "reference", "moving").mapInPandas(run, schema)


def gaussian_widths(profiles: DataFrame, key: list[str], column: str = "profile") -> DataFrame:
    """(key, width): full width at half maximum of a Gaussian fitted to each profile."""
    kinds = dict(profiles.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), "width double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[key].copy()
            out["width"] = [kernels.gaussian_fwhm(np.asarray(p, float)) for p in pdf[column]]
            yield out

    return profiles.select(*key, column).mapInPandas(run, schema)


def predicted(cells: DataFrame, key: list[str], model: Callable[[], Callable[[np.ndarray], np.ndarray]], column: str = "pixels", batch: int = 64) -> DataFrame:
    """``probabilities`` of each crop by a model that every worker loads once.

    Models with weights plug in here: ``model`` returns a function from (n, pixels) to (n, classes).
    """
    kinds = dict(cells.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), "probabilities array<double>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = model()
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                out = part[key].copy()
                out["probabilities"] = list(np.asarray(infer(np.stack([np.asarray(p, float) for p in part[column]])), float))
                yield out

    return cells.select(*key, column).mapInPandas(run, schema)
