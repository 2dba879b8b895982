"""Sinks: partitioned text and columnar tables as downstream tools expect them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, numeric


def well_manifests(wells: DataFrame, path: str) -> None:
    """A headerless table of wells per plate, the last column ``none`` where there is no index."""
    out = wells.select("plate", "well", "row", "col", F.col("plate").alias("plate_"), F.coalesce("index_xml", F.lit("none")).alias("index_xml"))
    out.write.mode("overwrite").partitionBy("plate").csv(path, sep="\t")


def scaling_line(factors: DataFrame) -> DataFrame:
    """One row, one column ``line``: ``<plate>_ch<channel>=<factor>`` joined by spaces."""
    pair = F.concat(keys.scale_key(F.col("plate"), F.col("channel")), F.lit("="), F.col("factor").cast("string"))
    return factors.agg(F.array_join(F.array_sort(F.collect_list(pair)), " ").alias("line"))


def features(table: DataFrame, path: str, columns: list[str], by: list[str]) -> None:
    """Chosen columns, tab separated, a folder per plate and well; missing numbers as NaN."""
    kinds = dict(table.dtypes)
    chosen = [numeric.null_as_nan(F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in columns]
    table.select(*by, *[c for c, n in zip(chosen, columns) if n not in by]).write.mode("overwrite").partitionBy(*by).option("compression", "gzip").csv(path, sep="\t", header=True)


def columnar(table: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by plate, row and so on; only the partitions written to are replaced."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def bucketed(table: DataFrame, name: str, key: str, buckets: int) -> None:
    """A table bucketed and sorted by its join key, so later joins on it need no shuffle."""
    table.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def cell_classes(long: DataFrame, classes: list[str], channels: list[str]) -> DataFrame:
    """(image, object) rows wide: one Localization column per class and channel."""
    name = F.concat_ws("_", F.lit("Localization"), keys.class_column(F.col("class")), "channel")
    wanted = [f"Localization_{''.join(w.capitalize() for w in c.split())}_{h}" for h in channels for c in classes]
    return long.withColumn("column_", name).groupBy("ImageNumber", "ObjectNumber").pivot("column_", wanted).agg(F.first("probability"))
