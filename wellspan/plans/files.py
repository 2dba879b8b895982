"""Queries of sources and sinks: tables are written in the forms of a run, and read back.

Files go to a new folder below the cluster's shared one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, numeric
from ..operators import channels
from ..operators.quantiles import numbered
from ..registry import Tables, query
from ..sources import manifests, sinks
from ..sources.finished import Finished
from .flows import shared_folder
from .tabular import CHANNELS, STATS, registration, stats


def written(t: Tables, df: DataFrame, name: str, header: bool, files: int = 1) -> str:
    """The table as tab-separated text in a new folder."""
    path = f"{shared_folder(t.spark)}/{name}"
    df.coalesce(files).write.csv(path, sep="\t", header=header)
    return path


def manifest(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    none = F.lit("none")
    return t.nation.select(
        F.col("n_name").alias("plate"), F.concat(F.lit("index_"), k.cast("string"), F.lit(".xml")).alias("index_xml"), F.lit("1,2,3").alias("channels"),
        F.when(k % 2 == 0, none).otherwise("1,3").alias("bp_channels"), (k % 4 + 1).cast("string").alias("cp_nucl_channel"), F.when(k % 3 == 0, none).otherwise("2").alias("cp_cell_channel"),
        F.lit("2").alias("dc_channels"), F.when(k % 5 == 0, none).otherwise("a.tif,b.tif").alias("dc_psfs"), none.alias("mask_channels"),
    )


@query("""select n_name as plate, 'index_' || n_nationkey || '.xml' as index_xml, '0,1,2' as channels, case when n_nationkey % 2 = 0 then '' else '0,2' end as bp, cast(n_nationkey % 4 as integer) as nucl, case when n_nationkey % 3 = 0 then -9 else 1 end::integer as cell, '1' as dc, case when n_nationkey % 5 = 0 then 0 else 2 end::integer as psfs, true as unmasked from nation""")
def plate_manifest_scan(t: Tables) -> DataFrame:
    m = manifests.plate_manifest(t.spark, written(t, manifest(t), "manifest", True))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return m.select("plate", "index_xml", text("channels").alias("channels"), F.coalesce(text("bp_channels"), F.lit("")).alias("bp"), F.col("cp_nucl_channel").alias("nucl"), F.coalesce("cp_cell_channel", F.lit(-9)).alias("cell"), text("dc_channels").alias("dc"), F.coalesce(F.size("dc_psfs"), F.lit(0)).alias("psfs"), F.col("mask_channels").isNull().alias("unmasked"))


@query("select n_name as plate, unnest([0, 2])::integer as channel, 'index_' || n_nationkey || '.xml' as index_xml, false as first_ from nation where n_nationkey % 2 = 1 union all select n_name, -1, 'index_' || n_nationkey || '.xml', true from nation where n_nationkey = (select min(n_nationkey) from nation)")
def manifest_flatfields(t: Tables) -> DataFrame:
    """A row per channel with a flatfield, and the manifest's first row by itself."""
    path = written(t, manifest(t).repartition(1).sortWithinPartitions(F.regexp_extract("index_xml", "[0-9]+", 0).cast("int")), "manifest", True)
    m = manifests.flatfield_channels(manifests.plate_manifest(t.spark, path)).withColumn("first_", F.lit(False))
    return m.unionByName(manifests.first_row(t.spark, path).select("plate", F.lit(-1).alias("channel"), "index_xml", F.lit(True).alias("first_")))


@query("select s_nationkey || '' as plate, chr(cast(65 + s_suppkey % 16 as integer)) || lpad(cast(s_suppkey % 24 + 1 as varchar), 2, '0') as well, chr(cast(65 + s_suppkey % 16 as integer)) as row_, cast(s_suppkey % 24 + 1 as varchar) as col_, s_nationkey || ':' || chr(cast(65 + s_suppkey % 16 as integer)) || lpad(cast(s_suppkey % 24 + 1 as varchar), 2, '0') as key, s_nationkey || '/' || chr(cast(65 + s_suppkey % 16 as integer)) || '/' || (s_suppkey % 24 + 1) as relpath from supplier")
def well_manifest_scan(t: Tables) -> DataFrame:
    """Wells of several headerless files, as the sink of manifests writes them; row and column follow from the well."""
    well = F.concat(keys.index_row((F.col("s_suppkey") % 16 + 1)), keys.padded(F.col("s_suppkey") % 24 + 1, 2))
    wells = t.supplier.select(well.alias("well"), F.lit(None).cast("string").alias("row"), F.lit(None).cast("string").alias("col"), F.col("s_nationkey").cast("string").alias("plate"), F.lit("none").alias("index_xml"))
    halves = [written(t, wells.where(c), "wells", False) for c in ("plate < '2'", "plate >= '2'")]
    return manifests.well_manifest(t.spark, halves).select("plate", "well", F.col("row").alias("row_"), F.col("col").alias("col_"), "key", "relpath")


@query("with n as (select n_nationkey as k, min(n_nationkey) over (partition by n_regionkey) as ref from nation) select k || '' as plate, ref || '' as ref_plate, case when k = ref then 0 else k % 3 end::integer as channel from n")
def registration_scan(t: Tables) -> DataFrame:
    """Registration file to pairs of plate and reference, with the channel that each registers by."""
    r = registration(t)
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    table = r.select(F.col("ref_plate").alias("reference_plate"), F.lit(1).alias("reference_channel"), text("qry_plates").alias("query_plates"), text(F.transform("qry_plates", lambda x: x % 3 + 1)).alias("query_channels"))
    m = manifests.registration_manifest(t.spark, written(t, table, "registration", True))
    of = m.select("ref_plate", F.explode("qry").alias("q")).select(F.col("q.plate").alias("plate"), F.col("q.channel").alias("channel"))
    own = m.select(F.col("ref_plate").alias("plate"), F.col("ref_channel").alias("channel"))
    return manifests.plate_pairs(m).join(of.union(own), "plate").select("plate", "ref_plate", "channel")


@query("select s_suppkey, s_nationkey || ':' || s_name as key from supplier where s_acctbal >= 0")
def well_list_anti(t: Tables) -> DataFrame:
    """Wells without those on a deny list that is a headerless file."""
    s = t.supplier.select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("string").alias("plate"), F.col("s_name").alias("well"))
    denied = manifests.well_list(t.spark, written(t, s.where("s_acctbal < 0").select("plate", "well"), "blacklist", False))
    return s.withColumn("key", keys.well_key(F.col("plate"), F.col("well"))).join(denied, "key", "left_anti").select("s_suppkey", "key")


@query("select s_nationkey || '' as plate, s_name as well, unnest([1, s_nationkey % 4 + 2])::integer as channel, 'control ' || s_nationkey as name from supplier where s_acctbal > 5000")
def control_list_scan(t: Tables) -> DataFrame:
    c = t.supplier.where("s_acctbal > 5000").select("s_nationkey", F.col("s_name").alias("well"), F.concat(F.lit("1, "), (F.col("s_nationkey") % 4 + 2).cast("string")).alias("channels"), F.concat(F.lit("control "), F.col("s_nationkey").cast("string")).alias("name"))
    return manifests.control_list(t.spark, written(t, c.withColumnRenamed("s_nationkey", "plate"), "controls", True))


@query("select r_name as plate, n_name as name, n_nationkey as value, upper(substr(r_name, 1, 1)) as initial from nation join region on n_regionkey = r_regionkey")
def folder_scan(t: Tables) -> DataFrame:
    """Plates are folders, each with a file of statistics somewhere below."""
    folder = shared_folder(t.spark)
    for r in t.region.select("r_regionkey", "r_name").collect():
        part = t.nation.where(F.col("n_regionkey") == r["r_regionkey"]).select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("value"))
        part.coalesce(1).write.csv(f"{folder}/{r['r_name'].replace(' ', '_')}/deep/stats", sep="\t", header=True)
    plates = manifests.plates_of_folder(t.spark, folder)
    found = manifests.statistics(t.spark, folder, "part-*").withColumn("plate", F.regexp_extract("file", r"/([^/]+)/deep/", 1))
    return found.join(plates, "plate").select(F.replace("plate", F.lit("_"), F.lit(" ")).alias("plate"), "name", "value", F.substring("plate", 1, 1).alias("initial"))


@query("select p_brand as plate, p_type as well, cast(p_size as integer) as row_, cast(p_partkey % 24 as integer) as col_, cast(p_partkey as integer) as field, p_size / 2.0::double as x, p_retailprice as y, 0.0::double as z, timestamp '2024-01-01 00:00:00' + to_seconds(p_partkey) as time_abs from part")
def vendor_index_scan(t: Tables) -> DataFrame:
    """An index of JSON documents, a file a plate, with positions nested in images in wells."""
    p, z = F.col, F.lit(0.0)
    at = lambda c: F.struct(c.cast("double").alias("value"))
    stamp = F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, p_partkey)"), "yyyy-MM-dd'T'HH:mm:ss")
    image = F.struct(p("p_partkey").cast("int").alias("field"), F.lit("1").alias("channel"), F.lit("1").alias("plane"), stamp.alias("time_abs"), F.struct(at(p("p_size") / 2).alias("x"), at(p("p_retailprice")).alias("y"), at(z).alias("z")).alias("position"))
    well = F.struct(p("p_type").alias("id"), p("p_size").cast("int").alias("row"), (p("p_partkey") % 24).cast("int").alias("col"), F.array(image).alias("images"))
    docs = t.part.groupBy("p_brand").agg(F.collect_list(well).alias("wells")).select(F.struct(F.col("p_brand").alias("name"), F.lit("384").alias("type")).alias("plate"), "wells")
    path = f"{shared_folder(t.spark)}/index"
    docs.repartition("plate").select(F.to_json(F.struct("plate", "wells")).alias("value"), F.col("plate.name").alias("brand")).write.partitionBy("brand").text(path)
    found = manifests.vendor_index_json(t.spark, path)
    return found.select("plate", "well", F.col("row").alias("row_"), F.col("col").alias("col_"), "field", "x", "y", "z", F.col("time_abs").cast("timestamp_ntz").alias("time_abs"))


@query(f"with {STATS} select plate || '_ch' || channel as key, round(avg(q1) / 65535, 6)::double as value from stats group by plate, channel")
def scaling_line_roundtrip(t: Tables) -> DataFrame:
    """Factors as one line of key=value pairs, written and read."""
    f = stats(t).groupBy("plate", "channel").agg(F.round(F.avg("q1") / 65535, 6).alias("factor"))
    path = f"{shared_folder(t.spark)}/scaling_factors"
    sinks.scaling_line(f).coalesce(1).write.text(path)
    return manifests.key_value_line(t.spark, path)


@query(f"with {CHANNELS} select ref_plate || '' as ref_plate, c.plate || '' as plate, cast(cycle as integer) as cycle, cast(row_number() over (partition by ref_plate order by cycle, orig_channel) - 1 as integer) as channel, orig_name from cycles c join chans h on c.plate = h.plate")
def channel_table_scan(t: Tables) -> DataFrame:
    chans = stats(t).select("plate", F.ascii("channel").alias("orig_channel"), F.col("channel").alias("orig_name")).distinct()
    index = channels.channel_index(channels.cycles(registration(t)), chans)
    return manifests.channel_table(t.spark, written(t, index, "channels", False)).select("ref_plate", "plate", "cycle", "channel", "orig_name")


CHANGED = "1999-06-01"


@query(f"""select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as total, case when min(o_orderdate) >= timestamp '{CHANGED}' then 'new' when max(o_orderdate) >= timestamp '{CHANGED}' then 'changed' else 'kept' end as state from orders group by o_custkey""")
def resumed_results(t: Tables) -> DataFrame:
    """A second run over a grown table makes only units that are new or changed; the others are read."""
    store, by = Finished(t.spark, shared_folder(t.spark)), ["o_custkey"]
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    early = F.col("o_orderdate") < F.lit(CHANGED).cast("timestamp")

    def summed(first: bool) -> Callable[[DataFrame], DataFrame]:
        state = F.when(F.lit(first), "kept").when(F.min("o_orderdate") < F.lit(CHANGED).cast("timestamp"), "changed").otherwise("new")
        return lambda df: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), state.alias("state"))

    store.completed(orders.where(early), "totals", by, summed(True))
    return store.completed(orders, "totals", by, summed(False), portions=2)


@query("select s_nationkey as plate, s_name as well, case when s_acctbal < 0 then 'none' else 'index.xml' end as index_xml from supplier")
def well_manifest_sink(t: Tables) -> DataFrame:
    """Manifests by plate, written without header and read back with the plate from the folder's name."""
    w = t.supplier.select(F.col("s_nationkey").alias("plate"), F.col("s_name").alias("well"), F.lit("A").alias("row"), F.lit("1").alias("col"), F.when(F.col("s_acctbal") >= 0, "index.xml").alias("index_xml"))
    path = f"{shared_folder(t.spark)}/manifests"
    sinks.well_manifests(w, path)
    back = t.spark.read.csv(path, sep="\t", schema="well string, row string, col string, plate_ string, index_xml string, plate int")
    return back.select("plate", "well", "index_xml")


@query("select c_nationkey as plate, c_mktsegment as well, c_custkey as number, case when c_acctbal < 0 then 'NaN' else 'number' end as kind from customer")
def features_sink(t: Tables) -> DataFrame:
    """Chosen columns as gzipped text by plate and well; what is missing is NaN."""
    c = t.customer.select(F.col("c_nationkey").alias("plate"), F.col("c_mktsegment").alias("well"), F.col("c_custkey").alias("number"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("area"), F.lit("x").alias("unwanted"))
    path = f"{shared_folder(t.spark)}/features"
    sinks.features(c, path, ["number", "area"], ["plate", "well"])
    back = t.spark.read.csv(path, sep="\t", header=True, schema="number long, area string, plate int, well string")
    return back.select("plate", "well", "number", F.when(F.col("area") == "NaN", "NaN").otherwise("number").alias("kind"))


@query("select c_nationkey as plate, c_custkey as number, case when c_nationkey = 3 then 'again' else 'first' end as run from customer")
def columnar_sink(t: Tables) -> DataFrame:
    """Parquet by plate; a second run that holds one plate replaces that plate alone."""
    c = t.customer.select(F.col("c_nationkey").alias("plate"), F.col("c_custkey").alias("number"))
    path = f"{shared_folder(t.spark)}/columnar"
    sinks.columnar(c.withColumn("run", F.lit("first")), path, ["plate"])
    sinks.columnar(c.where("plate = 3").withColumn("run", F.lit("again")), path, ["plate"])
    return t.spark.read.parquet(path).select("plate", "number", "run")


@query("""select n_nationkey as cell, n_name || ', "' || n_nationkey || '"' as name, case when n_regionkey < 2 then n_nationkey * 2 else -1 end as width, case when n_regionkey >= 2 then n_nationkey * 3 else -1 end as corr, case when n_regionkey >= 2 then n_nationkey + 100 else -1 end as row_number from nation""")
def crop_index_merge(t: Tables) -> DataFrame:
    """Index files of two kinds, united by name: one with row numbers under an empty header, and quoted names."""
    folder = shared_folder(t.spark)
    name = F.concat(F.col("n_name"), F.lit(', "'), F.col("n_nationkey").cast("string"), F.lit('"'))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    a = t.nation.where("n_regionkey < 2").select(F.concat_ws(",", quoted(name), "n_nationkey", F.col("n_nationkey") * 2).alias("value"))
    b = t.nation.where("n_regionkey >= 2").select(F.concat_ws(",", F.col("n_nationkey") + 100, F.col("n_nationkey") * 3, quoted(name), "n_nationkey").alias("value"))
    for kind, head, rows in (("a", "name,cell,width", a), ("b", ",corr,name,cell", b)):
        first = t.spark.createDataFrame([(head,)], "value string")
        first.unionByName(rows).coalesce(1).write.option("compression", "none").text(f"{folder}/{kind}")
    m = manifests.merged_crop_index(t.spark, folder, "*.txt")
    number = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c)
    return m.select(F.col("cell").cast("int").alias("cell"), "name", number("width"), number("corr"), number("row_number"))


@query("select page_id, regexp_replace(string_split(url, '/')[-1], '\\.[^./]*$', '') as stem, coalesce(try_cast(regexp_extract(url, '([^/]+)\\.html$', 1) as double), -1.0)::double as number, lpad(cast(page_id as varchar), cast(greatest(5, length(cast(page_id as varchar))) as integer), '0') as padded, round(page_id * 2 * sqrt(2 * ln(2)), 6) as fwhm, round(pi() * pow(page_id / 6.0, 2), 4) as least_area from pages")
def name_functions(t: Tables) -> DataFrame:
    """Names without extension, text as numbers, padded numbers, widths of spreads, least sizes."""
    number = keys.number_or_nan(F.regexp_extract("url", r"([^/]+)\.html$", 1))
    size = F.lit(numeric.least_size(1.0, 2)) * F.col("page_id") * F.col("page_id")
    return t.pages.select("page_id", keys.without_extension(keys.base_name(F.col("url"))).alias("stem"), F.when(F.isnan(number), -1.0).otherwise(number).alias("number"), keys.padded(F.col("page_id"), 5).alias("padded"), F.round(numeric.fwhm_of_sigma(F.col("page_id")), 6).alias("fwhm"), F.round(size, 4).alias("least_area"))


@query("select vec_id, round(embedding[1]::double, 5) as y, round(embedding[2]::double, 5) as x, 1.5::double as r from embeddings")
def blob_list_scan(t: Tables) -> DataFrame:
    e = t.embeddings.select(F.round(F.col("embedding")[0].cast("double"), 5).alias("y"), F.round(F.col("embedding")[1].cast("double"), 5).alias("x"), F.lit(1.5).alias("r"), "vec_id")
    path = written(t, e.drop("vec_id"), "blobs", False)
    return manifests.blob_list(t.spark, path).distinct().join(e.select("vec_id", "y", "x"), ["y", "x"]).select("vec_id", "y", "x", "r")


NAMED = "n as (select vec_id as field, label as plate, 'A' || lpad(cast(vec_id % 12 + 1 as varchar), 2, '0') as well from embeddings)"


@query(f"with {NAMED} select field, 'p_' || plate as plate, well, field || '_p_' || plate || '_' || well || '_ch1.tiff' as dna, field || '_p_' || plate || '_' || well || '_ch2.tiff' as actin from n")
def image_names(t: Tables) -> DataFrame:
    """Parts of file names, and one row per field with a column of files for each named channel."""
    well = F.concat(F.lit("A"), keys.padded(F.col("vec_id") % 12 + 1, 2))
    base = t.embeddings.select(F.concat_ws("_", F.col("vec_id").cast("string"), F.lit("p"), F.col("label").cast("string"), well).alias("base"))
    files = base.select(F.explode(F.array(*(F.concat("base", F.lit(x)) for x in ("_ch1.tiff", "_ch2.tiff", "_ch1.png", "_thumb.tiff")))).alias("path"))
    return manifests.image_sets(manifests.named_images(files), {1: "dna", 2: "actin"}).select("field", "plate", "well", "dna", "actin")


@query("select vec_id as field, case when vec_id % 2 = 0 then 'cell' else 'nucl' end as kind, cast(label * 10 as integer) as diameter, 1 as channel from embeddings")
def mask_names(t: Tables) -> DataFrame:
    kind = F.when(F.col("vec_id") % 2 == 0, "cell").otherwise("nucl")
    name = F.concat(F.lit("m/"), F.col("vec_id").cast("string"), F.lit("_"), kind, F.lit("_mask_d"), (F.col("label") * 10).cast("string"), F.lit("_ch1_cp_masks.tif"))
    files = t.embeddings.select(F.explode(F.array(name, F.lit("m/other.tif"))).alias("path"))
    return manifests.named_masks(files).select("field", "kind", "diameter", "channel")


@query("""with l as (select user_id as image, event_type, count(*) as n from events group by 1, 2) select image as "ImageNumber", 1 as "ObjectNumber", coalesce(max(n) filter (event_type = 'click'), 0) / 100.0::double as "Localization_Click_dna", coalesce(max(n) filter (event_type = 'error'), 0) / 100.0::double as "Localization_Error_dna" from l group by image""")
def cell_class_tables(t: Tables) -> DataFrame:
    """Probabilities by class and channel side by side, one row per cell."""
    long = t.events.groupBy(F.col("user_id").alias("ImageNumber"), F.col("event_type").alias("class")).agg((F.count(F.lit(1)) / 100.0).alias("probability")).withColumns({"ObjectNumber": F.lit(1), "channel": F.lit("dna")})
    wide = sinks.cell_classes(long, ["click", "error"], ["dna"])
    return wide.fillna(0.0, ["Localization_Click_dna", "Localization_Error_dna"])


@query("select n_nationkey as row_, n_regionkey as col_, 'image ' || n_name as url from nation")
def vendor_xml_scan(t: Tables) -> DataFrame:
    """Image elements of an XML index, read by the reader built into Spark."""
    path = f"{shared_folder(t.spark)}/Index.xml"
    image = F.concat(F.lit("<Image><Row>"), F.col("n_nationkey").cast("string"), F.lit("</Row><Col>"), F.col("n_regionkey").cast("string"), F.lit("</Col><URL>image "), F.col("n_name"), F.lit("</URL></Image>"))
    doc = t.nation.agg(F.concat(F.lit("<Index><Images>"), F.array_join(F.collect_list(image), "\n"), F.lit("</Images></Index>")).alias("value"))
    doc.coalesce(1).write.text(path)
    found = manifests.vendor_index_xml(t.spark, path)
    return found.select(F.col("Row").cast("int").alias("row_"), F.col("Col").cast("int").alias("col_"), F.col("URL").alias("url"))


@query("select o_orderkey, c_mktsegment from orders join customer on o_custkey = c_custkey")
def bucketed_join(t: Tables) -> DataFrame:
    """Tables that are bucketed by the join key meet without a shuffle."""
    mark = uuid.uuid4().hex
    sinks.bucketed(t.orders.select("o_orderkey", F.col("o_custkey").alias("k")), f"wellspan_orders_{mark}", "k", 8)
    sinks.bucketed(t.customer.select(F.col("c_custkey").alias("k"), "c_mktsegment"), f"wellspan_customers_{mark}", "k", 8)
    return t.spark.table(f"wellspan_orders_{mark}").join(t.spark.table(f"wellspan_customers_{mark}"), "k").select("o_orderkey", "c_mktsegment")


@query("select n_name as name, cast(row_number() over (partition by n_regionkey order by n_nationkey) - 1 as integer) as channel, n_regionkey as plate from nation")
def channel_listing(t: Tables) -> DataFrame:
    """Channels of each plate with a running index from 0."""
    return numbered(t.nation, ["n_regionkey"], "n_nationkey", "at").select(F.col("n_name").alias("name"), (F.col("at") - 1).cast("int").alias("channel"), F.col("n_regionkey").alias("plate"))
