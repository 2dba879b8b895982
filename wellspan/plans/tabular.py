"""Queries of the relational and statistical operators, bound to the driver's tables.

Roles: a supplier's nation is a plate, line status a cycle, return flag a channel, extended
price the first quantile of an image; regions are reference plates and nations their cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys, numeric
from ..operators import channels, filters, scaling, spatial, timing
from ..operators.quantiles import numbered, small_side
from ..registry import Tables, query


def stats(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("plate"))
    return t.lineitem.join(s, "l_suppkey").select("plate", F.col("l_linestatus").alias("cycle"), F.col("l_returnflag").alias("channel"), F.col("l_extendedprice").alias("q1"), F.col("l_quantity").alias("q2"), F.col("l_linenumber").alias("field"))


STATS = "stats as (select s_nationkey as plate, l_linestatus as cycle, l_returnflag as channel, l_extendedprice as q1, l_quantity as q2, l_linenumber as field from lineitem join supplier on l_suppkey = s_suppkey)"


@query(f"""with {STATS}, c as (select cycle, channel, quantile_cont(q1, 0.95) / 65535 as total from stats group by cycle, channel),
p as (select distinct plate, cycle, channel from stats), f as (select plate, channel, quantile_cont(q1, 0.95) / 65535 as own from stats group by plate, channel)
select p.plate, p.cycle, p.channel, round(total, 8) as total, round(own, 8) as own, round(own / total, 6) as deviation from p join c using (cycle, channel) join f using (plate, channel)""")
def scale_factor_cycle_channel(t: Tables) -> DataFrame:
    s = stats(t)
    total = scaling.scale_factors(s, ["cycle", "channel"], "q1", 95).withColumnRenamed("factor", "total")
    own = scaling.scale_factors(s, ["plate", "channel"], "q1", 95).withColumnRenamed("factor", "own")
    rows = s.select("plate", "cycle", "channel").distinct()
    found = scaling.must_match(scaling.must_match(rows, total, ["cycle", "channel"]), own, ["plate", "channel"])
    return found.select("plate", "cycle", "channel", F.round("total", 8).alias("total"), F.round("own", 8).alias("own"), F.round(F.col("own") / F.col("total"), 6).alias("deviation"))


@query(f"""with {STATS} select cycle, null::varchar as plate, channel, round(quantile_cont(q1, 0.9) / 65535, 8) as factor, 0 as of_plate from stats group by cycle, channel
union all select null, plate::varchar, channel, round(quantile_cont(q1, 0.9) / 65535, 8), 1 from stats group by plate, channel""")
def scale_factor_both_grains(t: Tables) -> DataFrame:
    return scaling.both_grains(stats(t), "cycle", "plate", "channel", "q1", 90).withColumns({"plate": F.col("plate").cast("string"), "factor": F.round("factor", 8)})


SUMMARY_SQL = " union all ".join(
    f"select channel, '{m}' as measure, '{n}' as statistic, round({e}, 4) as value from stats group by channel"
    for m in ("q1", "q2")
    for n, e in [*((f"q{100 * q:g}", f"quantile_cont({m}, {q!r})") for q in scaling.SUMMARY), ("mean", f"avg({m})")]
)


@query(f"with {STATS} {SUMMARY_SQL}")
def intensity_summary_13q(t: Tables) -> DataFrame:
    return scaling.summary(stats(t), ["channel"], ["q1", "q2"]).withColumn("value", F.round("value", 4))


OFFSETS = f"""{STATS}, obj as (select plate, channel, avg(q1) as intensity from stats where field <= 2 group by plate, channel),
offs as (select plate, channel, intensity / min(intensity) over (partition by channel) as plate_offset from obj)"""


@query(f"with {OFFSETS} select plate, channel, round(plate_offset, 6) as plate_offset from offs")
def plate_offset_ratio_min(t: Tables) -> DataFrame:
    return offsets(t).select("plate", "channel", F.round("plate_offset", 6).alias("plate_offset"))


def offsets(t: Tables) -> DataFrame:
    controls = stats(t).where("field <= 2").groupBy("plate", "channel").agg(F.avg("q1").alias("intensity"))
    return scaling.plate_offsets(controls, "channel", "intensity").select("plate", "channel", "plate_offset")


@query(f"""with {OFFSETS}, p as (select plate, channel, quantile_cont(q1, 0.95) / 65535 as plate_scale from stats where field > 1 group by plate, channel),
j as (select coalesce(p.plate, o.plate) as plate, coalesce(p.channel, o.channel) as channel, plate_scale, coalesce(plate_offset, 1.0) as plate_offset from p full join (select * from offs where plate_offset < 1.02) o on p.plate = o.plate and p.channel = o.channel),
b as (select *, max(plate_scale / plate_offset) over (partition by channel) as base_scale from j)
select plate, channel, round(plate_offset, 6) as plate_offset, round(base_scale, 8) as base_scale, round(coalesce(base_scale * plate_offset, 1.0), 8) as factor from b""")
def final_scale_factor(t: Tables) -> DataFrame:
    plates = scaling.scale_factors(stats(t).where("field > 1"), ["plate", "channel"], "q1", 95).withColumnRenamed("factor", "plate_scale")
    f = scaling.final_factors(plates, offsets(t).where("plate_offset < 1.02"))
    return f.select("plate", "channel", F.round("plate_offset", 6).alias("plate_offset"), F.round("base_scale", 8).alias("base_scale"), F.round("factor", 8).alias("factor"))


CONTROL = """with o as (select s_nationkey as plate, l_returnflag as channel, l_suppkey as well, l_linenumber as field, l_partkey as label, l_linestatus as name, l_quantity as area, l_tax as threshold, l_extendedprice as im, l_discount as ix
 from lineitem join supplier on l_suppkey = s_suppkey),
e as (select * from (select distinct plate from o) cross join (select distinct channel from o)),
g as (select plate, channel, count(distinct concat_ws('_', label, well, field)) as nobjects, count(distinct field) as nfields, count(distinct (well, field)) as nfields_total, count(distinct well) as nwells,
 array_to_string(list_sort(list(distinct name)), ',') as name, avg(threshold) as mt, avg(im) as mi, avg(area * im) as ii, avg(ix) as mx from o group by plate, channel)
select e.plate, e.channel, coalesce(nobjects, 0) as nobjects, coalesce(nfields, 0) as nfields, coalesce(nfields_total, 0) as nfields_total, coalesce(nwells, 0) as nwells, name, round(mt, 6) as mean_threshold, round(mi, 3) as mean_mean_object_intensity,
 round(ii, 2) as mean_integrated_object_intensity, round(mx, 6) as mean_max_object_intensity from e left join g on e.plate = g.plate and e.channel = g.channel"""


@query(CONTROL)
def control_summary(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    o = t.lineitem.join(s, "l_suppkey").select(
        F.col("s_nationkey").alias("plate"), F.col("l_returnflag").alias("channel"), F.col("l_suppkey").alias("well"), F.col("l_linenumber").alias("field"), F.col("l_partkey").alias("label"),
        F.col("l_linestatus").alias("name"), F.col("l_quantity").alias("area"), F.col("l_tax").alias("threshold"), F.col("l_extendedprice").alias("intensity_mean"), F.col("l_discount").alias("intensity_max"),
    )
    c = scaling.control_summary(o)
    for name, n in (("mean_threshold", 6), ("mean_mean_object_intensity", 3), ("mean_integrated_object_intensity", 2), ("mean_max_object_intensity", 6)):
        c = c.withColumn(name, F.round(name, n))
    return c


@query("select s_suppkey, s_nationkey from supplier where s_suppkey not in (select s_suppkey from supplier where s_acctbal < 0)")
def blacklist_anti(t: Tables) -> DataFrame:
    return filters.without_listed(t.supplier, t.supplier.where("s_acctbal < 0"), ["s_suppkey"]).select("s_suppkey", "s_nationkey")


@query("select c_custkey, c_nationkey from customer where c_nationkey in (select n_nationkey from nation where n_regionkey in (1, 3))")
def allowlist_semi(t: Tables) -> DataFrame:
    listed = t.nation.where(F.col("n_regionkey").isin(1, 3)).select(F.col("n_nationkey").alias("c_nationkey"))
    return filters.only_listed(t.customer, listed, ["c_nationkey"]).select("c_custkey", "c_nationkey")


@query("select doc_id from documents d where not exists (select 1 from benchmark b where contains(d.text, b.text))")
def substring_anti(t: Tables) -> DataFrame:
    return filters.without_containing(t.documents.select("doc_id", "text"), "text", t.benchmark, "text").select("doc_id")


@query("""select p_partkey, cast(a.pos - 1 as integer) as pos, a.word from (select p_partkey, unnest([{'pos': i, 'word': string_split(p_name, ' ')[i]} for i in range(1, len(string_split(p_name, ' ')) + 1)]) as a from part)""")
def manifest_explode(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"))


@query("select o_orderkey, coalesce(try_cast(string_split(o_orderpriority, '-')[1] as integer) - 1, -9) as channel, case when o_orderpriority = '5-LOW' then null else o_orderpriority end as priority from orders")
def channel_type_parse(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", keys.channel_number(F.element_at(F.split("o_orderpriority", "-"), 1)).alias("channel"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))


@query("""with w as (select s_suppkey, s_nationkey as plate, chr(cast(65 + s_suppkey % 16 as integer)) || lpad(cast(s_suppkey % 24 + 1 as varchar), 2, '0') as well from supplier)
select s_suppkey, well, regexp_replace(well, '[0-9]+', '', 'g') as row_, regexp_replace(regexp_replace(well, '[A-Z]+', '', 'g'), '^0+', '') as col_, plate || ':' || well as key,
 plate || '/' || regexp_replace(well, '[0-9]+', '', 'g') || '/' || regexp_replace(regexp_replace(well, '[A-Z]+', '', 'g'), '^0+', '') as path, cast(ascii(well) - 64 as integer) as row_index, lpad(cast(s_suppkey as varchar), cast(greatest(4, length(cast(s_suppkey as varchar))) as integer), '0') as cell from w""")
def well_key_parse(t: Tables) -> DataFrame:
    well = F.concat(keys.index_row((F.col("s_suppkey") % 16 + 1)), keys.padded(F.col("s_suppkey") % 24 + 1, 2))
    w = t.supplier.withColumn("well", well)
    row, col = keys.row_letter(F.col("well")), keys.column_number(F.col("well"))
    return w.select("s_suppkey", "well", row.alias("row_"), col.alias("col_"), keys.well_key(F.col("s_nationkey"), F.col("well")).alias("key"), keys.well_path(F.col("s_nationkey"), row, col).alias("path"), keys.row_index(F.col("well")).alias("row_index"), keys.padded(F.col("s_suppkey"), 4).alias("cell"))


URL = r"^(https?)://([^/]+)/([a-z]+)/([0-9]+)"


@query(f"select page_id, regexp_extract(url, '{URL}', 1) as scheme, regexp_extract(url, '{URL}', 2) as host, regexp_extract(url, '{URL}', 3) as lang, try_cast(regexp_extract(url, '{URL}', 4) as bigint) as number, string_split(url, '/')[-1] as base from pages")
def url_regex_groups(t: Tables) -> DataFrame:
    return t.pages.select("page_id", *[F.regexp_extract("url", URL, i).alias(n) for i, n in ((1, "scheme"), (2, "host"), (3, "lang"))], F.regexp_extract("url", URL, 4).try_cast("bigint").alias("number"), keys.base_name(F.col("url")).alias("base"))


@query("select c_custkey, 'ch' || (c_custkey % 4) || ' - ' || regexp_replace('ch' || (c_custkey % 9) || ' - ' || c_mktsegment, '^ch[0-9]+ - ', '') as name, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as class_ from customer")
def channel_name_cleanup(t: Tables) -> DataFrame:
    old = F.concat(F.lit("ch"), (F.col("c_custkey") % 9).cast("string"), F.lit(" - "), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", keys.clean_channel_name(old, F.col("c_custkey") % 4).alias("name"), keys.class_column(F.col("c_mktsegment")).alias("class_"))


@query(f"with {STATS} select plate || '_ch' || channel as key, cast(count(*) as bigint) as n from stats group by plate, channel")
def kv_string_roundtrip(t: Tables) -> DataFrame:
    counts = stats(t).groupBy("plate", "channel").agg(F.count(F.lit(1)).alias("n"))
    pair = F.concat(keys.scale_key(F.col("plate"), F.col("channel")), F.lit("="), F.col("n").cast("string"))
    line = counts.groupBy("plate").agg(F.array_join(F.array_sort(F.collect_list(pair)), " ").alias("line"))
    return line.select(F.explode(keys.key_values(F.col("line"))).alias("key", "v")).select("key", F.col("v").cast("bigint").alias("n"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k, event_type from events")
def json_props_flatten(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), "event_type")


@query("select doc_id, md5(text) as md5 from documents")
def md5_checksum(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"))


@query("select s_suppkey, s_nationkey, n_name, n_regionkey from supplier join nation on s_nationkey = n_nationkey")
def wells_join_manifest(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name", "n_regionkey")


@query("select s_suppkey from supplier where s_nationkey in (select min(n_nationkey) from nation group by n_regionkey)")
def ref_semi_join(t: Tables) -> DataFrame:
    refs = t.nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("s_nationkey"))
    return filters.only_listed(t.supplier, refs, ["s_nationkey"]).select("s_suppkey")


def registration(t: Tables) -> DataFrame:
    """Each region's first nation is the reference, the others its queries in order."""
    listed = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_nationkey")).alias("plates"))
    return listed.select(F.col("plates")[0].alias("ref_plate"), F.slice("plates", F.lit(2), F.size("plates")).alias("qry_plates"))


CYCLES = "cycles as (select min(n_nationkey) over (partition by n_regionkey) as ref_plate, n_nationkey as plate, row_number() over (partition by n_regionkey order by n_nationkey) as cycle from nation)"


@query(f"with {CYCLES} select ref_plate, plate, cast(cycle as integer) as cycle from cycles")
def cycle_pairs_explode(t: Tables) -> DataFrame:
    return channels.cycles(registration(t))


CHANNELS = f"{STATS}, {CYCLES}, chans as (select distinct plate, ascii(channel) as orig_channel, channel as orig_name from stats)"


@query(f"""with {CHANNELS}, m as (select ref_plate, c.plate, cycle, row_number() over (partition by ref_plate order by cycle, orig_channel) - 1 as channel, orig_channel, orig_name from cycles c join chans h on c.plate = h.plate),
n as (select *, 'ch' || channel || ' - ' || orig_name as name from m),
x as (select n.ref_plate, n.plate, cycle, n.channel as orig_channel, n.name as orig_name, unnest([0, 1]) as which from n where orig_channel = 78 and cycle = 1),
y as (select x.*, l.last + row_number() over (partition by x.ref_plate order by orig_channel, which) as channel from x join (select ref_plate, max(channel) as last from n group by ref_plate) l on x.ref_plate = l.ref_plate)
select ref_plate, plate, cast(cycle as integer) as cycle, cast(channel as integer) as channel, name, cast(orig_channel as integer) as orig_channel, orig_name from n
union all select ref_plate, plate, cast(cycle as integer), cast(channel as integer), 'ch' || channel || ' - ' || orig_name || ' - ' || case when which = 0 then 'mask inclusive' else 'mask exclusive' end, cast(orig_channel as integer), orig_name from y""")
def channel_index_running(t: Tables) -> DataFrame:
    cycled = channels.cycles(registration(t))
    chans = stats(t).select("plate", F.ascii("channel").alias("orig_channel"), F.col("channel").alias("orig_name")).distinct()
    masked = cycled.where("cycle = 1").select("plate", F.lit(78).alias("orig_channel"))
    return channels.channel_index(cycled, chans, masked)


@query(f"""with {STATS}, {CYCLES}, im as (select distinct plate, channel as row_, cycle as col_, field from stats where q2 >= 50),
e as (select ref_plate, count(*) as expected from cycles group by ref_plate)
select c.ref_plate, row_, col_, field from im join cycles c on im.plate = c.plate join e on e.ref_plate = c.ref_plate group by c.ref_plate, row_, col_, field, expected having count(distinct im.plate) = expected""")
def all_cycles_present(t: Tables) -> DataFrame:
    images = stats(t).where("q2 >= 50").select("plate", F.col("channel").alias("row"), F.col("cycle").alias("col"), "field").distinct()
    return channels.in_all_cycles(images, channels.cycles(registration(t))).withColumnsRenamed({"row": "row_", "col": "col_"})


@query("select n_nationkey, round(n_nationkey / total, 6) as share from nation cross join (select sum(n_nationkey) as total from nation)")
def cross_broadcast_singleton(t: Tables) -> DataFrame:
    total = t.nation.agg(F.sum("n_nationkey").alias("total"))
    return t.nation.crossJoin(F.broadcast(total)).select("n_nationkey", F.round(F.col("n_nationkey") / F.col("total"), 6).alias("share"))


@query("""select coalesce(a.k, b.k) as nation, coalesce(n, 0) as suppliers, coalesce(m, 0) as customers from (select s_nationkey as k, count(*) as n from supplier where s_acctbal > 5000 group by 1) a
full join (select c_nationkey as k, count(*) as m from customer where c_acctbal > 9000 group by 1) b on a.k = b.k""")
def offset_full_outer(t: Tables) -> DataFrame:
    a = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    b = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    return a.join(b, "nation", "full_outer").fillna(0)


@query("select o_orderkey, c_mktsegment from orders left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey")
def scale_left_lookup(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_mktsegment")


@query("""with r as (select c_nationkey, c_custkey, (row_number() over (partition by c_nationkey order by c_custkey) - 1) // 1000 as part from customer)
select c_nationkey, part, string_agg(cast(c_custkey as varchar), ' ' order by c_custkey) as customers, min(c_custkey) as first_ from r group by c_nationkey, part""")
def grouptuple_sorted(t: Tables) -> DataFrame:
    """Sorted lists by nation, in parts of a thousand, so that no row holds a whole group."""
    placed = numbered(t.customer.select("c_nationkey", "c_custkey"), ["c_nationkey"], "c_custkey").withColumn("part", F.expr("(number - 1) div 1000"))
    ids = F.array_sort(F.collect_list("c_custkey"))
    return placed.groupBy("c_nationkey", "part").agg(F.array_join(F.transform(ids, lambda x: x.cast("string")), " ").alias("customers"), F.min("c_custkey").alias("first_"))


@query("select conv_id, count(*) as n from conversations group by conv_id having count(*) = max(turn) + 1 and count(*) > 3")
def sized_groups(t: Tables) -> DataFrame:
    return t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last")).where("n = last + 1 and n > 3").drop("last")


@query("select s_suppkey as id, s_nationkey as nation, s_acctbal as balance, null::varchar as segment, 's' as tag from supplier union all select c_custkey, c_nationkey, c_acctbal, c_mktsegment, 'c' from customer")
def union_by_name(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.lit("s").alias("tag"))
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("c").alias("tag"))
    return s.unionByName(c, allowMissingColumns=True)


@query("select 'except' as op, k from (select s_nationkey as k from supplier except select c_nationkey from customer where c_acctbal > 9900) union all select 'intersect', k from (select s_nationkey as k from supplier intersect select c_nationkey from customer where c_acctbal > 9900) union all select 'union', k from (select s_nationkey as k from supplier union select c_nationkey from customer)")
def set_operations(t: Tables) -> DataFrame:
    a, b = t.supplier.select(F.col("s_nationkey").alias("k")), t.customer.select(F.col("c_nationkey").alias("k"))
    few = t.customer.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k"))
    tag = lambda name, df: df.select(F.lit(name).alias("op"), "k")
    return tag("except", a.distinct().join(few, "k", "left_anti")).union(tag("intersect", a.intersect(few))).union(tag("union", a.union(b).distinct()))


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r from events) where r = 1")
def dedupe_first(t: Tables) -> DataFrame:
    return filters.first_of(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@query("select user_id, cast(count(*) filter (event_type = 'click') as bigint) as click, cast(count(*) filter (event_type = 'error') as bigint) as error, cast(count(*) filter (event_type = 'view') as bigint) as view_ from events group by user_id")
def image_set_pivot(t: Tables) -> DataFrame:
    p = t.events.groupBy("user_id").pivot("event_type", ["click", "error", "view"]).count().fillna(0)
    return p.withColumnRenamed("view", "view_")


@query("""with a as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as r from events where event_type = 'click'),
b as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as r from events where event_type = 'error') select a.user_id, cast(a.r as integer) as place, a.event_id as a_id, b.event_id as b_id from a join b on a.user_id = b.user_id and a.r = b.r""")
def image_set_by_order(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    one = lambda kind, name: t.events.where(F.col("event_type") == kind).select("user_id", F.row_number().over(w).alias("place"), F.col("event_id").alias(name))
    return one("click", "a_id").join(one("error", "b_id"), ["user_id", "place"])


@query("""with x as (select l_orderkey, l_linenumber, l_extendedprice / 3.0 as v, l_quantity as q from lineitem)
select l_orderkey, l_linenumber, cast(least(greatest(round_even(v, 0), 0), 65535) as integer) as u16, cast(least(greatest(round_even(v * 100000, 0), 0), 4294967295) as bigint) as u32, cast(least(greatest(round_even(least(v, 20000.0) / 20000.0 * 65535, 0), 0), 65535) as integer) as clipped,
 round(v * (1 - 1 / (1 + exp(-0.01 * (v - 9000)))) + v / q * (1 / (1 + exp(-0.01 * (v - 9000)))), 7) as sigmoid, round(pow(v / 65535.0, 0.5), 8) as power from x""")
def uint_conversion(t: Tables) -> DataFrame:
    v = F.col("l_extendedprice") / 3.0
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", numeric.to_uint16(v).alias("u16"), numeric.to_uint32(v * 100000).alias("u32"), numeric.clipped_to_uint16(v, 20000.0).alias("clipped"),
        F.round(numeric.sigmoid_scaled(v, F.col("l_quantity"), F.lit(0.01), F.lit(9000.0)), 7).alias("sigmoid"), F.round(numeric.power_of_scaled(v, 0.5), 8).alias("power"),
    )


@query("select event_id from events join (select event_type, avg(value) as m, stddev_pop(value) as s from events group by event_type) g on events.event_type = g.event_type where value between m - 1.644854 * s and m + 1.644854 * s")
def sd_filter(t: Tables) -> DataFrame:
    return filters.within_spread(t.events, "value", 1.644854, ["event_type"]).select("event_id")


MAD = "select l_orderkey, l_linenumber, l_returnflag, {v} as v, median({v}) over (partition by l_returnflag) as m from lineitem"


@query("""with a as (select *, median(value) over (partition by event_type) as m from events), b as (select *, median(abs(value - m)) over (partition by event_type) as d from a)
select event_id, round(case when d = 0 then 0.0 else (value - m) / d end, 6) as mad_score from b""")
def mad_scores(t: Tables) -> DataFrame:
    return filters.mad_scores(t.events, ["value"], ["event_type"], ["mad_score"]).select("event_id", F.round("mad_score", 6).alias("mad_score"))


@query("""with a as (select *, median(l_quantity) over (partition by l_returnflag) as m1, median(l_extendedprice) over (partition by l_returnflag) as m2 from lineitem),
b as (select *, median(abs(l_quantity - m1)) over (partition by l_returnflag) as d1, median(abs(l_extendedprice - m2)) over (partition by l_returnflag) as d2 from a)
select l_orderkey, l_linenumber, l_partkey from b where (l_quantity - m1) / d1 between -1.5 and 1.5 and (l_extendedprice - m2) / d2 between -1.5 and 1.5""")
def mad_filter_multi(t: Tables) -> DataFrame:
    return filters.within_mad(t.lineitem, ["l_quantity", "l_extendedprice"], 1.5, ["l_returnflag"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("select o_orderkey from orders join (select o_orderstatus, quantile_cont(o_totalprice, 0.05) as a, quantile_cont(o_totalprice, 0.95) as b from orders group by o_orderstatus) g on orders.o_orderstatus = g.o_orderstatus where o_totalprice between a and b")
def percentile_band(t: Tables) -> DataFrame:
    return filters.percentile_band(t.orders, "o_totalprice", 5, 95, ["o_orderstatus"]).select("o_orderkey")


@query("select p_partkey from part where p_size between 5 and 45 and p_retailprice between 950 and 1500")
def border_exclusion(t: Tables) -> DataFrame:
    return filters.inside_border(t.part, "p_size", "p_retailprice", (5, 45, 950, 1500)).select("p_partkey")


@query("select c_custkey, case when c_acctbal between 0 and 5000 then 'kept' else 'removed' end as set_ from customer")
def filter_keep_removed(t: Tables) -> DataFrame:
    kept, removed = filters.split_by(t.customer, F.col("c_acctbal").between(0, 5000))
    return kept.select("c_custkey", F.lit("kept").alias("set_")).union(removed.select("c_custkey", F.lit("removed").alias("set_")))


@query("select o_orderkey from orders where o_custkey in (select o_custkey from orders group by o_custkey having count(*) >= 12)")
def flag_and_skip(t: Tables) -> DataFrame:
    return filters.with_enough(t.orders, ["o_custkey"], 12).select("o_orderkey")


@query("""select l_orderkey, l_linenumber, l_partkey, w > 0 and h > 0 and round_even(cy, 0) - floor(greatest(w, h, 1) / 2) >= 0 and round_even(cy, 0) + floor(greatest(w, h, 1) / 2) <= 50 and round_even(cx, 0) - floor(greatest(w, h, 1) / 2) >= 0 and round_even(cx, 0) + floor(greatest(w, h, 1) / 2) <= 2000 as eligible
from (select *, l_linenumber * 2 as w, l_suppkey % 9 as h, l_quantity as cy, l_partkey / 1.0 as cx from lineitem)""")
def crop_eligibility(t: Tables) -> DataFrame:
    w, h = F.col("l_linenumber") * 2, F.col("l_suppkey") % 9
    ok = filters.crop_eligible(w, h, F.lit(1), F.col("l_quantity"), F.col("l_partkey") / 1.0, 50, 2000)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", ok.alias("eligible"))


def points(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding")[0].cast("double").alias("y"), F.col("embedding")[1].cast("double").alias("x"))


POINTS = "pts as (select vec_id as id, label, cast(embedding[1] as double) as y, cast(embedding[2] as double) as x from embeddings)"
DIST = "sqrt((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))"


@query(f"with {POINTS} select id, label from pts a where not exists (select 1 from pts b where a.id <> b.id and a.label = b.label and {DIST} < 0.02)")
def close_points_antijoin(t: Tables) -> DataFrame:
    return spatial.without_close(points(t), 0.02, ["label"]).select("id", "label")


@query(f"with {POINTS} select a.id, a.label, count(b.id) as neighbours from pts a left join pts b on a.label = b.label and a.id <> b.id and {DIST} < 0.05 group by a.id, a.label")
def neighbours_within_d(t: Tables) -> DataFrame:
    return spatial.neighbour_counts(points(t), 0.05, ["label"]).select("id", "label", "neighbours")


@query(f"with {POINTS}, n as (select a.label, a.id, b.id as other, {DIST} as dist from pts a join pts b on a.label = b.label and a.id <> b.id and {DIST} < 0.1), r as (select *, row_number() over (partition by label, id order by dist, other) as place from n) select label, id, cast(place as integer) as place, other, round(dist, 9) as dist from r where place <= 2")
def nearest_two(t: Tables) -> DataFrame:
    return spatial.nearest(points(t), 2, 0.1, ["label"]).select("label", "id", "place", "other", F.round("dist", 9).alias("dist"))


@query("""with p as (select distinct event_type as well, cast(user_id % 7 as double) as x, cast(user_id % 5 as double) as y, cast(user_id % 2 as double) as z, user_id as field from events)
select well, x, y, z, field, cast(dense_rank() over (partition by well order by x) - 1 as integer) as index_x, cast(dense_rank() over (partition by well order by y desc) - 1 as integer) as index_y, cast(dense_rank() over (partition by well order by z) - 1 as integer) as index_z from p""")
def field_grid_dense_rank(t: Tables) -> DataFrame:
    u = F.col("user_id")
    p = t.events.select(F.col("event_type").alias("well"), (u % 7).cast("double").alias("x"), (u % 5).cast("double").alias("y"), (u % 2).cast("double").alias("z"), u.alias("field"))
    return spatial.grid_index(p, ["well"])


@query("""with r as (select event_type as plate, min(ts) as started, max(ts) as ended, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as seconds, count(distinct user_id) as n_wells, count(*) as n_images, count(distinct json_extract_string(props, '$.k')) as n_channels, count(distinct date_trunc('day', ts)) as n_fields from events group by event_type)
select plate, strftime(started, '%Y-%m-%d %H:%M:%S') as started, strftime(ended, '%Y-%m-%d %H:%M:%S') as ended, round(seconds, 3) as seconds, n_wells, n_images, n_channels, n_fields, round(seconds / n_wells, 4) as per_well, round(seconds / n_images, 4) as per_image, round(seconds / n_images * n_channels, 3) as per_field, n_channels * n_fields as images_by_product from r""")
def timing_report(t: Tables) -> DataFrame:
    e = t.events.select(F.col("event_type").alias("plate"), "ts", "user_id", F.get_json_object("props", "$.k").alias("channel"), F.date_trunc("day", "ts").alias("field"))
    r = timing.report(e, "plate", "ts", "user_id", "channel", "field")
    shown = F.date_format
    return r.select("plate", shown("started", "yyyy-MM-dd HH:mm:ss").alias("started"), shown("ended", "yyyy-MM-dd HH:mm:ss").alias("ended"), F.round("seconds", 3).alias("seconds"), "n_wells", "n_images", "n_channels", "n_fields", F.round("per_well", 4).alias("per_well"), F.round("per_image", 4).alias("per_image"), F.round("per_field", 3).alias("per_field"), "images_by_product")


@query("""with g as (select event_type, avg(value) as m, stddev_samp(value) as s, count(*) as n, min(value) as lo, max(value) as hi from events group by event_type having count(*) > 1),
grid as (select *, unnest(range(0, 50)) as i from g), p as (select event_type, i, lo + (hi - lo) * i / 49.0 as x, s * pow(n, -0.2) as h, n from grid)
select p.event_type, cast(i as integer) as i, round(x, 6) as x, round(sum(exp(-0.5 * pow((p.x - e.value) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 8) as density from p join events e on e.event_type = p.event_type group by p.event_type, i, x""")
def kde_grid(t: Tables) -> DataFrame:
    """Gaussian density on a grid with Scott's bandwidth; groups of one row are passed over."""
    g = t.events.groupBy("event_type").agg(F.stddev_samp("value").alias("s"), F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).where("n > 1")
    # A sum for each grid point in one aggregate: rows are not multiplied.
    x = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / 49.0
    h = F.col("s") * F.pow("n", F.lit(-0.2))
    u = lambda i: (x(i) - F.col("value")) / h
    sums = [F.sum(F.exp(-0.5 * u(i) * u(i))).alias(f"d{i}") for i in range(50)]
    wide = t.events.select("event_type", "value").join(small_side(g), "event_type").groupBy("event_type", "s", "n", "lo", "hi").agg(*sums)
    long = wide.select("*", F.posexplode(F.array(*(f"d{i}" for i in range(50)))).alias("i", "d"))
    return long.select("event_type", "i", F.round(x(F.col("i")), 6).alias("x"), F.round(F.col("d") / (F.col("n") * h * F.sqrt(2 * F.pi())), 8).alias("density"))


@query("select l_returnflag, cast(least(floor(l_extendedprice / 5000), 19) as integer) as bin, count(*) as n from lineitem group by 1, 2")
def histogram(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", F.least(F.floor(F.col("l_extendedprice") / 5000), F.lit(19)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("select label, vec_id from (select label, vec_id, row_number() over (partition by label order by md5(vec_id || ':7'), vec_id) as r from embeddings) where r <= 5")
def sample_without_replacement(t: Tables) -> DataFrame:
    """Five images of every plate, drawn by a seeded hash: reruns agree."""
    w = Window.partitionBy("label").orderBy(F.md5(F.concat(F.col("vec_id").cast("string"), F.lit(":7"))), "vec_id")
    return t.embeddings.select("label", "vec_id").withColumn("r", F.row_number().over(w)).where("r <= 5").drop("r")


@query("""with s as (select label, unnest(range(0, 8)) as draw from (select distinct label from embeddings)), k as (select label, vec_id, row_number() over (partition by label order by vec_id) - 1 as place, count(*) over (partition by label) as n from embeddings)
select s.label, cast(draw as integer) as draw, vec_id from s join k on s.label = k.label and ('0x' || substr(md5(s.label || ':' || draw), 1, 7))::bigint % n = place""")
def sample_with_replacement(t: Tables) -> DataFrame:
    """Eight seeded draws of every plate's images, repeats possible."""
    images = numbered(t.embeddings.select("label", "vec_id"), ["label"], "vec_id").withColumn("at", F.col("number") - 1).drop("number")
    sizes = t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    drawn = sizes.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(7))))
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("label").cast("string"), F.col("draw").cast("string"))), 1, 7), 16, 10).cast("bigint")
    return drawn.withColumn("at", number % F.col("n")).join(images, ["label", "at"]).select("label", "draw", "vec_id")


@query("select 'objects' as name, count(*) as n from customer where c_acctbal is null union all select 'plates', count(*) from supplier where s_nationkey is null")
def null_guard(t: Tables) -> DataFrame:
    """Counts behind the guard that no plate is missing."""
    a = t.customer.where("c_acctbal is null").agg(F.lit("objects").alias("name"), F.count(F.lit(1)).alias("n"))
    return a.union(t.supplier.where("s_nationkey is null").agg(F.lit("plates").alias("name"), F.count(F.lit(1)).alias("n")))


@query("select c_nationkey, 1.0::double as intensity_mean, 1.0::double as plate_offset from (select distinct c_nationkey from customer)")
def dummy_mode(t: Tables) -> DataFrame:
    """All measures set to 1: every offset must come out as 1."""
    ones = t.customer.select("c_nationkey").distinct().withColumns({"channel": F.lit(0), "intensity_mean": F.lit(1.0)})
    return scaling.plate_offsets(ones, "channel", "intensity_mean").select("c_nationkey", "intensity_mean", "plate_offset")
