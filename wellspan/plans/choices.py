"""Queries of run-level joins, choices and small conventions, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import channels, pixels, runs, scaling, spatial
from ..operators.quantiles import numbered
from ..registry import Tables, query
from ..sources import sinks
from .flows import shared_folder
from .imaging import PX, QUAD, STRIPE, images, quadrants, rounded, stripes
from .tabular import CHANNELS, DIST, OFFSETS, POINTS, STATS, offsets, points, registration, sample_without_replacement, stats


@query(f"with {QUAD}, {STRIPE} select q.vec_id, count(*) as pixels, count(distinct s.label) as labels, sum(s.label)::bigint as total from q join s on q.vec_id = s.vec_id and q.y = s.y and q.x = s.x and q.label > 0 and s.label > 0 group by q.vec_id")
def relabel_by_cell(t: Tables) -> DataFrame:
    """Nuclei pixels with the label of the cell they lie in."""
    p = images(t)
    return runs.relabelled_by(quadrants(p), stripes(p), ["vec_id"]).groupBy("vec_id").agg(F.count(F.lit(1)).alias("pixels"), F.countDistinct("label").alias("labels"), F.sum("label").alias("total"))


@query(f"""with {STATS}, im as (select distinct plate, cycle as row_, channel as col_, field from stats where q2 >= 25), mk as (select distinct plate, cycle as row_, channel as col_, field from stats where q2 < 10)
select plate, row_, col_, field from im semi join mk using (plate, row_, col_, field)""")
def images_join_masks(t: Tables) -> DataFrame:
    at = lambda c: stats(t).where(c).select("plate", F.col("cycle").alias("row"), F.col("channel").alias("col"), "field").distinct()
    return runs.images_with_masks(at("q2 >= 25"), at("q2 < 10").withColumn("mask", F.lit("m"))).select("plate", F.col("row").alias("row_"), F.col("col").alias("col_"), "field")


INDEX = f"{CHANNELS}, ix as (select ref_plate, c.plate, cast(cycle as integer) as cycle, cast(row_number() over (partition by ref_plate order by cycle, orig_channel) - 1 as integer) as channel, orig_channel, orig_name from cycles c join chans h on c.plate = h.plate)"


def channel_index(t: Tables) -> DataFrame:
    chans = stats(t).select("plate", F.ascii("channel").alias("orig_channel"), F.col("channel").alias("orig_name")).distinct()
    return channels.channel_index(channels.cycles(registration(t)), chans)


@query(f"with {INDEX} select ix.plate, ix.orig_channel, channel, 'ch' || channel || ' - ' || orig_name as name from ix where orig_channel <> 78")
def registration_channel_map(t: Tables) -> DataFrame:
    """The merged channel of every plate's registration channels."""
    wanted = channel_index(t).where("orig_channel <> 78").select("plate", "orig_channel")
    return runs.with_channel_map(wanted, channel_index(t)).select("plate", "orig_channel", "channel", "name")


@query(f"with {INDEX}, {OFFSETS.removeprefix(STATS + ', ')} select ix.ref_plate, ix.plate, cycle, ix.channel, orig_name, round(plate_offset, 6) as factor from ix join offs on ix.plate = offs.plate and ix.orig_name = offs.channel")
def channel_index_with_scaling(t: Tables) -> DataFrame:
    """The channel index with each channel's factor, which must be there once."""
    f = runs.one_each(offsets(t), ["plate", "channel"]).select("plate", F.col("channel").alias("orig_name"), F.round("plate_offset", 6).alias("factor"))
    return scaling.must_match(channel_index(t), f, ["plate", "orig_name"]).select("ref_plate", "plate", "cycle", "channel", "orig_name", "factor")


@query(f"""with {INDEX}, f as (select cycle as own_cycle, orig_name, min(plate) as source from ix group by 1, 2) select ix.plate, ix.cycle, ix.orig_name, source as shared_field, ix.plate as own_field from ix join f on ix.cycle = own_cycle and ix.orig_name = f.orig_name""")
def flatfields_by_cycle(t: Tables) -> DataFrame:
    """Each plate's own flatfield, and the one that its cycle and channel share."""
    ix = channel_index(t).select("plate", "cycle", F.col("orig_name").alias("channel"))
    cycled, listed = ix.select("plate", "cycle").distinct(), ix.select("plate", "channel")
    shared = ix.groupBy("cycle", "channel").agg(F.min("plate").alias("shared_field"))
    own = ix.select("plate", "channel", F.col("plate").alias("own_field"))
    both = runs.cycle_flatfields(cycled, listed, shared, True).join(runs.cycle_flatfields(cycled, listed, own, False), ["plate", "cycle", "channel"])
    return both.select("plate", "cycle", F.col("channel").alias("orig_name"), "shared_field", "own_field")


@query(f"""with {PX}, c as (select plate, row_number() over (order by plate) - 1 as k from (select distinct plate from px)), r as (select plate, k // 2 as ref_plate, k % 2 + 1 as cycle from c)
select ref_plate, cast(cycle as integer) as cycle, cast(case when cycle = 1 then ch else ch + 2 end as integer) as channel, y, x, max(v) as v from px join r on px.plate = r.plate cross join (select unnest([0, 1]) as ch) group by 1, 2, 3, 4, 5""")
def merge_cycles(t: Tables) -> DataFrame:
    """Two channels of each of two cycles as channels 0 to 3 of one image."""
    p = images(t)
    plates = p.select("plate").distinct()
    order = spatial.grid_index(plates.select(F.lit(0).alias("w"), F.col("plate").alias("x"), F.lit(0).alias("y"), F.lit(0).alias("z"), F.lit(0).alias("field")), ["w"])
    cycled = order.select(F.col("x").alias("plate"), F.expr("cast(index_x as bigint) div 2").alias("ref_plate"), (F.col("index_x") % 2 + 1).cast("int").alias("cycle"))
    two = p.select("plate", "y", "x", "v", F.explode(F.array(F.lit(0), F.lit(1))).alias("channel"))
    return runs.merged_cycles(two, cycled, plates.withColumn("n_channels", F.lit(2))).groupBy("ref_plate", "cycle", "channel", "y", "x").agg(F.max("v").alias("v"))


@query("select event_id from events where (user_id, event_type) in (select user_id, event_type from events group by user_id, event_type having count(*) between 2 and 14)")
def objects_within_cap(t: Tables) -> DataFrame:
    return runs.within_cap(t.events, ["user_id", "event_type"], 14, 2).select("event_id")


@query("select l_orderkey, l_linenumber from lineitem join (select l_returnflag as k, quantile_cont(l_discount, 0.9) as top from lineitem where l_discount <> 0 group by 1) on l_returnflag = k where l_discount <> 0 and l_discount < top")
def trim_values(t: Tables) -> DataFrame:
    return runs.trimmed(t.lineitem, ["l_returnflag"], "l_discount", 0.9).select("l_orderkey", "l_linenumber")


@query(f"with {PX} select vec_id, y, x, case when v >= 0.3 or v < -0.1 then 0.0 else v end as v from px")
def saturated_to_zero(t: Tables) -> DataFrame:
    return images(t).select("vec_id", "y", "x", runs.unsaturated(F.col("v"), 0.3, -0.1).alias("v"))


@query(f"with {PX} select vec_id, y, x, v from px where abs(y - 4) % 2 = 0 and abs(y - 4) <= 2")
def stepped_planes(t: Tables) -> DataFrame:
    return runs.stepped_planes(images(t), "y", 4, 2, 1).select("vec_id", "y", "x", "v")


@query("with g as (select user_id, event_type, count(*) as n from events group by 1, 2), r as (select *, row_number() over (partition by user_id order by n desc, event_type) as r from g) select user_id, string_agg(event_type, ',' order by r) as classes from r where r <= 3 group by user_id")
def top_three_classes(t: Tables) -> DataFrame:
    long = t.events.groupBy("user_id", F.col("event_type").alias("class")).agg(F.count(F.lit(1)).alias("probability"))
    return runs.top_classes(long, ["user_id"]).select("user_id", F.array_join("classes", ",").alias("classes"))


@query(f"with {PX} select vec_id, round(sum(case when v > 0 then v end) / nullif(count(*) filter (v > 0), 0), 8) as foreground, round(avg(v), 8) as baseline from px group by vec_id")
def masked_means(t: Tables) -> DataFrame:
    p = images(t)
    return rounded(runs.masked_mean(p, ["vec_id"], F.col("v") > 0).withColumnRenamed("mean", "foreground").join(p.groupBy("vec_id").agg(F.avg("v").alias("baseline")), "vec_id"), ["foreground", "baseline"], 8)


@query(f"with {QUAD} select vec_id, label, max(x) - min(x) as width, max(y) - min(y) as height, greatest(max(x) - min(x), max(y) - min(y)) as diameter, cast(round_even(avg(y), 0) as integer) as cy, cast(round_even(avg(x), 0) as integer) as cx from q where label > 0 group by 1, 2")
def object_extents(t: Tables) -> DataFrame:
    return runs.extents(quadrants(images(t)), ["vec_id"])


@query(f"with {PX} select plate, vec_id, " + ", ".join(f"round(quantile_cont(v, {q}), 8) as {n}" for q, n in ((0.0, "q0"), (0.25, "q25"), (0.5, "q50"), (0.999, "q99_9"), (1.0, "q100"))) + ", round(avg(v), 8) as mean from px group by plate, vec_id")
def intensity_statistics(t: Tables) -> DataFrame:
    """What the statistics writer keeps of every image; written to and read from the shared folder."""
    s = runs.image_statistics(images(t), ["plate", "vec_id"], [0.0, 0.25, 0.5, 0.999, 1.0])
    path = f"{shared_folder(t.spark)}/statistics"
    sinks.columnar(s, path, ["plate"])
    return rounded(t.spark.read.parquet(path), ["q0", "q25", "q50", "q99_9", "q100", "mean"], 8)


@query(f"with {PX}, s as (select vec_id, max(v) * 0.5 as threshold from px group by 1) select round(avg(threshold), 7) as threshold_mean, round(median(threshold), 7) as threshold_median, round(stddev_samp(threshold), 7) as threshold_std from s")
def experiment_thresholds(t: Tables) -> DataFrame:
    per_image = images(t).groupBy("vec_id").agg((F.max("v") * 0.5).alias("threshold"))
    return rounded(runs.experiment_thresholds(per_image), ["threshold_mean", "threshold_median", "threshold_std"], 7)


@query(f"with {PX}, s as (select plate, vec_id, row_number() over (partition by plate order by md5(vec_id || ':7'), vec_id) as r from (select distinct plate, vec_id from px)) select px.plate, y, x, max(v) as v from px join s on px.vec_id = s.vec_id and s.r <= 5 group by 1, 2, 3")
def compound_image(t: Tables) -> DataFrame:
    """Largest value of five sampled images of each plate, pixel by pixel."""
    few = sample_without_replacement(t).select("vec_id")
    return pixels.projected(images(t).join(few, "vec_id", "left_semi"), ["plate"])


@query("select 0 as threshold, l_orderkey, l_linenumber, l_extendedprice as v from lineitem union all select 1, l_orderkey, l_linenumber, l_extendedprice from lineitem where l_extendedprice > 30000")
def variants_union(t: Tables) -> DataFrame:
    """Raw and thresholded values, told apart by a tag."""
    raw = t.lineitem.select(F.lit(0).alias("threshold"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("v"))
    return raw.unionByName(raw.where("v > 30000").withColumn("threshold", F.lit(1)))


@query("select event_id, strftime(ts, '%Y%m%d_%H%M') as stamp, len(list_filter([nullif(event_type, 'click'), nullif(event_type, 'view'), event_type], lambda x: x is not null)) as kept, round(value / max(value) over (partition by event_type), 8) as of_most, round(value / avg(value) over (partition by event_type), 7) as of_mean, round(log2(abs(value) + 1), 7) as logged, round(pow(2, log2(abs(value) + 1)) - 1, 5) as back, user_id // 7 as part, cast(round_even(user_id / 4.0, 0) as integer) as quarter, round(user_id / 3.0 / 2, 6) as ratio from events")
def number_conventions(t: Tables) -> DataFrame:
    """Stamps, lists without nulls, shares of the largest and of the mean, logs and back, whole and rounded parts."""
    e, v = t.events, F.col("value")
    tops = e.groupBy("event_type").agg(F.max("value").alias("most"), F.avg("value").alias("mean"))
    listed = F.array_compact(F.array(F.nullif("event_type", F.lit("click")), F.nullif("event_type", F.lit("view")), F.col("event_type")))
    logged = F.log2(F.abs(v) + 1)
    return e.join(tops, "event_type").select(
        "event_id", F.date_format("ts", "yyyyMMdd_HHmm").alias("stamp"), F.size(listed).cast("long").alias("kept"), F.round(v / F.col("most"), 8).alias("of_most"), F.round(v / F.col("mean"), 7).alias("of_mean"),
        F.round(logged, 7).alias("logged"), F.round(F.pow(F.lit(2.0), logged) - 1, 5).alias("back"), F.expr("user_id div 7").alias("part"), F.rint(F.col("user_id") / 4).cast("int").alias("quarter"), F.round(F.col("user_id") / 3 / 2, 6).alias("ratio"),
    )


@query("select vec_id, 'plane_' || vec_id || '.tif' as name, row_number() over (order by vec_id) - 1 as place from embeddings")
def sort_by_number(t: Tables) -> DataFrame:
    """Files in order of the number in their name, not of the name."""
    files = t.embeddings.select("vec_id", F.concat(F.lit("plane_"), F.col("vec_id").cast("string"), F.lit(".tif")).alias("name"))
    at = F.regexp_extract("name", r"_([0-9]+)\.", 1).cast("long")
    return numbered(files.withColumn("n_", at), [], "n_", "place").select("vec_id", "name", (F.col("place") - 1).alias("place"))


@query("select vec_id, round(list_sum(list_transform(range(0, 16), lambda k: embedding[k + 1]::double * pow(0.5, k // 4) * pow(0.25, k % 4))), 8) as v from embeddings")
def surface_vandermonde(t: Tables) -> DataFrame:
    """A surface of the full degree three in either axis, at (0.25, 0.5): terms x**j y**i."""
    terms = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.col("embedding")[k].cast("double") * F.pow(F.lit(0.5), F.floor(k / 4)) * F.pow(F.lit(0.25), k % 4))
    return t.embeddings.select("vec_id", F.round(F.aggregate(terms, F.lit(0.0), lambda a, v: a + v), 8).alias("v"))


@query(f"""with {POINTS}, n as (select a.label, a.id, b.id as other, b.y - a.y as dy, b.x - a.x as dx, {DIST} as dist from pts a join pts b on a.label = b.label and a.id <> b.id), r as (select *, row_number() over (partition by label, id order by dist, other) as place from n),
f as (select * from r where place = 1), s as (select * from r where place = 2)
select f.id, f.other as first_, s.other as second_, round(f.dist, 7) as first_distance, round(s.dist, 7) as second_distance, round(degrees(acos(least(1, greatest(-1, (f.dy * s.dy + f.dx * s.dx) / (f.dist * s.dist))))), 3) as angle from f join s on f.id = s.id""")
def two_closest(t: Tables) -> DataFrame:
    """The two closest others, however far, and the angle between them."""
    two = spatial.closest_two(points(t), 0.05, ["label"])
    return rounded(two.select("id", "first_", "second_", "first_distance", "second_distance", F.round("angle", 3).alias("angle")), ["first_distance", "second_distance"], 7)


@query("select n_regionkey as field_row, coalesce(max(case when n_nationkey % 5 = 0 then n_name end), '-') as c0, coalesce(max(case when n_nationkey % 5 = 1 then n_name end), '-') as c1, coalesce(max(case when n_nationkey % 5 = 2 then n_name end), '-') as c2, coalesce(max(case when n_nationkey % 5 = 3 then n_name end), '-') as c3, coalesce(max(case when n_nationkey % 5 = 4 then n_name end), '-') as c4 from nation group by n_regionkey")
def grid_matrix(t: Tables) -> DataFrame:
    """Long to wide: a row of the grid per region, a column per index."""
    wide = t.nation.withColumn("at", F.col("n_nationkey") % 5).groupBy(F.col("n_regionkey").alias("field_row")).pivot("at", [0, 1, 2, 3, 4]).agg(F.max("n_name"))
    return wide.select("field_row", *(F.coalesce(F.col(str(i)), F.lit("-")).alias(f"c{i}") for i in range(5)))
