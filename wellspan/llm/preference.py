"""Preference formatting of chosen and rejected conversations, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "|>"


def _plain(c: Column) -> Column:
    """Role or text as rendered: null is empty, and marks of the template lose their shape."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit(OPEN), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn["role"]), F.lit(CLOSE + "\n"))


def _body(turn: Column) -> Column:
    return F.concat(_plain(turn["text"]), F.lit(f"{OPEN}end{CLOSE}\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column) -> Column:
    """Runs over the rendered characters: ``-n`` are masked, ``+n`` count in the loss."""

    def runs(t: Column) -> Column:
        sign = F.when(t["role"] == "assistant", F.lit("+")).otherwise(F.lit("-"))
        return F.concat(F.lit("-"), F.length(_head(t)).cast("string"), F.lit(","), sign, F.length(_body(t)).cast("string"))

    return F.array_join(F.transform(turns, runs), ",")


def preference_pairs(conversations: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """One row per pair: the shared prompt once, and both masked completions.

    ``conversations`` has (conv_id, turn, role, text), a row per turn; ``pair`` is a pair's
    key and ``chosen`` tells its two conversations apart.  Turns are put in order of (turn,
    role, text), so ties and repeated rows have one result.  The prompt is the longest
    common prefix of turns whose role and text agree (null equals null); it may be empty,
    and if one conversation is a prefix of the other its completion is empty.  Only
    assistants' texts and their end marks count in the loss.  A pair that lacks a side keeps
    its row: that side is null, the prompt is empty and ``sides`` says which one is there.
    Rows with a null pair key are not of any pair and are left out.  One shuffle by pair; a
    row is as large as its two conversations.
    """
    turn = F.struct("turn", "role", "text")
    both = conversations.withColumn("pair_id", pair).where("pair_id is not null").groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.when(chosen, turn))).alias("a"),
        F.array_sort(F.collect_list(F.when(~chosen, turn))).alias("b"),
    )
    shorter = F.least(F.size("a"), F.size("b"))
    a, b = F.col("a"), F.col("b")
    same = F.transform(F.sequence(F.lit(0), shorter - 1), lambda i: a[i]["role"].eqNullSafe(b[i]["role"]) & a[i]["text"].eqNullSafe(b[i]["text"]))
    stop = F.array_position(same, F.lit(False))
    n = F.when(shorter < 1, F.lit(0)).when(stop > 0, stop.cast("int") - 1).otherwise(shorter)
    both = both.withColumn("n_prefix", n)

    def side(c: Column, make) -> Column:
        return F.when(F.size(c) > 0, make(F.slice(c, F.col("n_prefix") + 1, F.size(c))))

    return both.select(
        "pair_id",
        F.when((F.size("a") > 0) & (F.size("b") > 0), "both").when(F.size("a") > 0, "chosen").otherwise("rejected").alias("sides"),
        "n_prefix",
        _render(F.slice("a", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        side(a, _render).alias("chosen"),
        side(a, _mask).alias("chosen_mask"),
        side(b, _render).alias("rejected"),
        side(b, _mask).alias("rejected_mask"),
    )


SQL = """
with ordered as (select conv_id >> 1 as pair_id, conv_id % 2 = 0 as is_chosen, turn, role, text,
    row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place,
    '<|' || replace(coalesce(role, ''), '<|', '< |') || '|>' || chr(10) as head,
    replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) as body
  from conversations where conv_id is not null),
sizes as (select pair_id, count(*) filter (is_chosen) as na, count(*) filter (not is_chosen) as nb from ordered group by pair_id),
broken as (select a.pair_id, min(a.place) as at from ordered a join ordered b on a.pair_id = b.pair_id and a.place = b.place and a.is_chosen and not b.is_chosen
  where a.role is distinct from b.role or a.text is distinct from b.text group by a.pair_id),
prefixes as (select s.pair_id, na, nb, coalesce(b.at - 1, least(na, nb)) as n from sizes s left join broken b on s.pair_id = b.pair_id),
rendered as (select o.pair_id, o.is_chosen, o.place, o.place <= p.n as shared, o.head || o.body as whole,
    '-' || length(o.head) || ',' || case when o.role = 'assistant' then '+' else '-' end || length(o.body) as runs
  from ordered o join prefixes p on o.pair_id = p.pair_id)
select p.pair_id, case when na > 0 and nb > 0 then 'both' when na > 0 then 'chosen' else 'rejected' end as sides, cast(n as integer) as n_prefix,
  coalesce(string_agg(whole, '' order by place) filter (is_chosen and shared), '') as prompt,
  case when na > 0 then coalesce(string_agg(whole, '' order by place) filter (is_chosen and not shared), '') end as chosen,
  case when na > 0 then coalesce(string_agg(runs, ',' order by place) filter (is_chosen and not shared), '') end as chosen_mask,
  case when nb > 0 then coalesce(string_agg(whole, '' order by place) filter (not is_chosen and not shared), '') end as rejected,
  case when nb > 0 then coalesce(string_agg(runs, ',' order by place) filter (not is_chosen and not shared), '') end as rejected_mask
from prefixes p join rendered r on p.pair_id = r.pair_id group by p.pair_id, na, nb, n
"""
