"""Keys, paths and text conventions of plate-based data, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_letter(well: Column) -> Column:
    """``A`` of ``A01``."""
    return F.regexp_replace(well, r"[0-9]+", "")


def column_number(well: Column) -> Column:
    """``1`` of ``A01``: letters and then leading zeros go."""
    return F.regexp_replace(F.regexp_replace(well, r"[A-Z]+", ""), r"^0+", "")


def well_key(plate: Column, well: Column) -> Column:
    return F.concat_ws(":", plate, well)


def well_path(plate: Column, row: Column, col: Column) -> Column:
    return F.concat_ws("/", plate, row, col)


def row_index(letter: Column) -> Column:
    """1 for A."""
    return F.ascii(letter) - F.lit(64)


def index_row(index: Column) -> Column:
    return F.char(F.lit(64) + index)


def padded(x: Column, width: int) -> Column:
    """Zero-padded on the left; longer values stay whole."""
    text = x.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def channel_list(text: Column) -> Column:
    """``1,2`` -> [0, 1]; ``none`` and null -> null."""
    listed = F.nullif(F.coalesce(text, F.lit("none")), F.lit("none"))
    return F.transform(F.split(listed, ","), lambda x: F.trim(x).try_cast("int") - 1)


def channel_number(text: Column) -> Column:
    """One-based channel text to a zero-based number; -9 if it is no number."""
    return F.coalesce(text.try_cast("int") - 1, F.lit(-9))


def none_as_null(text: Column) -> Column:
    return F.nullif(text, F.lit("none"))


def scale_key(plate: Column, channel: Column) -> Column:
    return F.concat(plate.cast("string"), F.lit("_ch"), channel.cast("string"))


def key_values(text: Column) -> Column:
    """``a=1 b=2`` as a map of strings."""
    return F.str_to_map(text, F.lit(" "), F.lit("="))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]*$", "")


def clean_channel_name(name: Column, index: Column) -> Column:
    """Drop an old ``ch1 - `` prefix and put the running index in its place."""
    return F.concat(F.lit("ch"), index.cast("string"), F.lit(" - "), F.regexp_replace(name, r"^ch[0-9]+ - ", ""))


def class_column(label: Column) -> Column:
    """``nuclear membrane`` -> ``NuclearMembrane``."""
    return F.replace(F.initcap(F.lower(label)), F.lit(" "), F.lit(""))


def number_or_nan(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(float("nan")))
