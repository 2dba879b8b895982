"""Text sources: manifests, lists, statistics, key=value lines and vendor indexes."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys

PLATES = "plate string, index_xml string, channels string, bp_channels string, cp_nucl_channel string, cp_cell_channel string, dc_channels string, dc_psfs string, mask_channels string"
WELLS = "well string, row string, col string, plate string, index_xml string"
CHANNELS = "ref_plate string, plate string, cycle int, channel int, name string, orig_channel int, orig_name string"


def _tsv(spark: SparkSession, path: str | list[str], schema: str, header: bool) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=header, schema=schema)


def plate_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a plate; channel lists become zero-based arrays and ``none`` becomes null.

    Columns are taken by name, so a manifest may lack the optional ones or order them freely.
    """
    raw = spark.read.csv(path, sep="\t", header=True)
    wanted = [c.split()[0] for c in PLATES.split(", ")]
    raw = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in wanted])
    lists = {c: keys.channel_list(F.col(c)) for c in ("channels", "bp_channels", "dc_channels", "mask_channels")}
    single = {c: keys.none_as_null(F.col(c)).try_cast("int") - 1 for c in ("cp_nucl_channel", "cp_cell_channel")}
    return raw.withColumns(lists | single | {"dc_psfs": F.split(keys.none_as_null(F.col("dc_psfs")), ",")})


def flatfield_channels(manifest: DataFrame) -> DataFrame:
    """(plate, channel, index_xml): a row per channel whose flatfield is wanted."""
    return manifest.select("plate", F.explode("bp_channels").alias("channel"), "index_xml")


def well_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Wells of one or many plates; row and column come from the well where they are missing."""
    w = _tsv(spark, paths, WELLS, header=False)
    w = w.withColumns({"row": F.coalesce("row", keys.row_letter(F.col("well"))), "col": F.coalesce("col", keys.column_number(F.col("well")))})
    w = w.where(F.assert_true(F.col("plate").isNotNull() & F.col("well").isNotNull(), F.lit("plate and well are mandatory")).isNull())
    return w.withColumns({"key": keys.well_key(F.col("plate"), F.col("well")), "relpath": keys.well_path(F.col("plate"), F.col("row"), F.col("col"))})


def registration_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(ref_plate, ref_channel, qry_plates, qry array<struct<plate, channel>>), zero-based."""
    r = _tsv(spark, path, "reference_plate string, reference_channel int, query_plates string, query_channels string", header=True)
    plates, chans = F.split("query_plates", ","), F.transform(F.split("query_channels", ","), lambda x: F.trim(x).try_cast("int") - 1)
    return r.select(F.col("reference_plate").alias("ref_plate"), (F.col("reference_channel") - 1).alias("ref_channel"), plates.alias("qry_plates"), F.arrays_zip(plates.alias("plate"), chans.alias("channel")).alias("qry"))


def plate_pairs(registration: DataFrame) -> DataFrame:
    """(plate, ref_plate) for every plate of a registration, the reference included."""
    return registration.select(F.explode(F.concat(F.array("ref_plate"), "qry_plates")).alias("plate"), "ref_plate")


def well_list(spark: SparkSession, path: str) -> DataFrame:
    """Deny or allow list without header: (plate, well, key)."""
    return _tsv(spark, path, "plate string, well string", header=False).withColumn("key", keys.well_key(F.col("plate"), F.col("well")))


def control_list(spark: SparkSession, path: str) -> DataFrame:
    """(plate, well, channel, name): one row per channel of a control."""
    c = _tsv(spark, path, "plate string, well string, channels string, name string", header=True)
    return c.select("plate", "well", F.explode(F.transform(F.split("channels", ","), lambda x: F.trim(x).try_cast("int"))).alias("channel"), "name")


def statistics(spark: SparkSession, folder: str, pattern: str = "intensity_stats.tsv") -> DataFrame:
    """All statistics files below a folder, as one table with the file each row is from."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).csv(folder, sep="\t", header=True, inferSchema=True)
    return raw.withColumn("file", F.input_file_name())


def plates_of_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the folders right below ``folder`` that hold files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    start = folder.rstrip("/").split("/")[-1]
    return files.select(F.regexp_extract("path", rf"/{start}/([^/]+)/", 1).alias("plate")).where("plate <> ''").distinct()


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, md5) of every file below a folder; contents stay on the executors."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.md5("content").alias("md5"))


def key_value_line(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a line such as ``plate_ch1=0.5 plate_ch2=1``; an absent file is empty."""
    try:
        text = spark.read.text(path, wholetext=False)
    except Exception as error:  # the reader says so in more than one way
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "key string, value double")
    return text.select(F.explode(keys.key_values(F.trim("value"))).alias("key", "v")).select("key", F.col("v").try_cast("double").alias("value"))


def channel_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return _tsv(spark, paths, CHANNELS, header=False)


def vendor_index_json(spark: SparkSession, path: str) -> DataFrame:
    """Images of a vendor index: one row per (well, image) with flat positions."""
    position = "struct<x:struct<value:double>,y:struct<value:double>,z:struct<value:double>>"
    schema = f"plate struct<name:string,type:string>, wells array<struct<id:string,row:int,col:int,images:array<struct<field:int,channel:string,plane:string,time_abs:string,position:{position}>>>>"
    raw = spark.read.json(path, schema=schema, multiLine=True)
    wells = raw.select(F.col("plate.name").alias("plate"), F.explode("wells").alias("w"))
    images = wells.select("plate", F.col("w.id").alias("well"), F.col("w.row").alias("row"), F.col("w.col").alias("col"), F.explode("w.images").alias("i"))
    return images.select("plate", "well", "row", "col", "i.field", "i.channel", "i.plane", F.to_timestamp("i.time_abs").alias("time_abs"), *[F.col(f"i.position.{a}.value").alias(a) for a in "xyz"])


def vendor_index_xml(spark: SparkSession, path: str, row_tag: str = "Image") -> DataFrame:
    """Image elements of a vendor XML index, with the reader built into Spark."""
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


#: Named parts of an image file's name (fixed format).
IMAGE_NAME = r"^(\d+)_(.+)_([A-P]\d{2})_ch(\d+)\.tiff?$"
MASK_NAME = r"^(\d+)_(cell|nucl)_mask_d(\d+)_ch(\d+)_cp_masks\.tiff?$"


def named_images(files: DataFrame, path: str = "path") -> DataFrame:
    """File names to (field, plate, well, channel); other names are passed over."""
    name = keys.base_name(F.col(path))
    parts = {n: F.regexp_extract(name, IMAGE_NAME, i) for i, n in enumerate(("field", "plate", "well", "channel"), 1)}
    return files.where(name.rlike(IMAGE_NAME)).withColumns(parts).withColumns({"field": F.col("field").cast("int"), "channel": F.col("channel").cast("int")})


def image_sets(named: DataFrame, names: dict[int, str], path: str = "path") -> DataFrame:
    """One row per (plate, well, field) with a column of paths for each named channel."""
    wide = named.groupBy("plate", "well", "field").pivot("channel", list(names)).agg(F.first(path))
    return wide.withColumnsRenamed({str(k): v for k, v in names.items()}).dropna(subset=list(names.values()))


def first_row(spark: SparkSession, path: str) -> DataFrame:
    """The first data row of a manifest, in the order of the file; manifests are small files."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", r"\r?\n").alias("l"))
    pairs = lines.select(F.map_from_arrays(F.split(F.col("l")[0], "\t"), F.split(F.col("l")[1], "\t")).alias("m"))
    return pairs.select(*(F.col("m")[c.split()[0]].alias(c.split()[0]) for c in PLATES.split(", ")))


#: Most kinds of headers that crop index files of one folder may have.
MOST_HEADERS = 1_000


def merged_crop_index(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """All crop index files below a folder as one table, columns matched by name.

    A file's first line is its header, whatever it begins with; a column without a name, as
    data frames write their row numbers, is called ``row_number``.  Fields may be quoted, but
    hold no line ends.  Empty fields are null, and columns that a file lacks are null in its
    rows.  Files without a line are passed over.  The headers that differ are counted first,
    and only those are brought to the driver.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    # A header stands at the file's first byte: a split that begins there reads it first.
    whole = reader.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_extract("value", r"^\uFEFF?([^\r\n]*)", 1).alias("head")).where("head <> ''")
    heads = [r["head"] for r in whole.select("head").distinct().orderBy("head").limit(MOST_HEADERS + 1).collect()]
    if not heads:
        raise ValueError("no crop index file")
    if len(heads) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} kinds of headers: not crop indexes")
    lines = reader.text(folder).select(F.regexp_replace("value", "^\uFEFF|\r$", "").alias("value"), F.col("_metadata.file_path").alias("file")).where("value <> ''")
    rows = lines.join(whole, "file").where("value <> head")
    out = None
    for head in heads:
        names = [n or "row_number" for n in next(csv.reader([head]))]
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        own = rows.where(F.col("head") == head).select(F.from_csv("value", schema, {"escape": '"'}).alias("r")).select("r.*")
        own = own.select(*(F.nullif(F.col(f"`{n.replace('`', '``')}`"), F.lit("")).alias(n) for n in names))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def blob_list(spark: SparkSession, path: str) -> DataFrame:
    """Spots without header: (y, x, r)."""
    return _tsv(spark, path, "y double, x double, r double", header=False)


def named_masks(files: DataFrame, path: str = "path") -> DataFrame:
    """Mask file names to (field, kind, diameter, channel); other names are passed over."""
    name = keys.base_name(F.col(path))
    parts = {n: F.regexp_extract(name, MASK_NAME, i) for i, n in enumerate(("field", "kind", "diameter", "channel"), 1)}
    return files.where(name.rlike(MASK_NAME)).withColumns(parts).withColumns({c: F.col(c).cast("int") for c in ("field", "diameter", "channel")})
