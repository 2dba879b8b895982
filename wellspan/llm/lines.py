"""Line dedup over overlapping three-line windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

WIDTH = 3


def _hashed(line: Column) -> Column:
    """128 bits of a line, and whether it holds a word."""
    return F.struct(
        F.xxhash64(line).alias("h1"),
        F.xxhash64(F.lit("second"), line).alias("h2"),
        (F.length(F.ltrim(line, F.lit(" \t\x0b\x0c\r"))) > 0).alias("worded"),
    )


def _windows(hashed: Column) -> Column:
    """Position and hash of every window that holds a word."""

    def one(i: Column) -> Column:
        three = [hashed[i + k] for k in range(WIDTH)]
        worded = three[0]["worded"]
        for x in three[1:]:
            worded = worded | x["worded"]
        return F.struct(i.alias("at"), *[F.xxhash64(*[x[h] for x in three]).alias(h) for h in ("h1", "h2")], worded.alias("worded"))

    count = F.size(hashed) - F.lit(WIDTH - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one))


def _row() -> Column:
    """Tells the rows of one doc_id apart: 60 bits of the text's MD5, which SQL can compute too."""
    return F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 15), 16, 10).cast("long")


def repeated_positions(docs: DataFrame) -> DataFrame:
    """(doc_id, row, covered): the line numbers, sorted, inside later occurrences of a window."""
    # Each line is hashed once, in a projection of its own: inside the lambda over windows
    # the text would be split anew for every window.  Windows are read twice, so kept.
    hashed = docs.select("doc_id", _row().alias("row"), F.transform(F.split("text", "\n", -1), _hashed).alias("hashed"))
    found = materialize(hashed.select("doc_id", "row", F.explode(_windows(F.col("hashed"))).alias("w")).select("doc_id", "row", "w.*").where("worded").drop("worded"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = found.join(first, ["h1", "h2"]).where(place > F.col("first"))
    lines = F.array_sort(F.array_distinct(F.flatten(F.transform(F.collect_list("at"), lambda i: F.sequence(i, i + (WIDTH - 1))))))
    return later.groupBy("doc_id", "row").agg(lines.alias("covered"))


def _unused(name: str, taken: list[str]) -> str:
    """The name, with underscores until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with every later occurrence of a repeated three-line window cut out.

    Lines are what ``\\n`` separates, compared exactly.  Of equal windows the one with the
    smallest (doc_id, row, line) stays, rows without an id last; the lines of all later ones,
    also within one text, are merged and removed, so overlapping windows remove a long
    passage whole.  Rows of one doc_id are apart as long as their texts differ, and in order
    of a hash of these; rows equal in both count as one row and are cut alike.  Windows
    without a word are never removed; texts of fewer than three lines and null texts pass
    unchanged.  Adds ``n_lines`` and ``n_removed`` (int; null text: 0), in place of input
    columns of these names, and replaces ``text``; all other columns pass, whatever they are
    called.
    """
    docs = docs.drop("n_lines", "n_removed")
    at, row, covered, lines = (_unused(n, docs.columns) for n in ("at_", "row_", "covered_", "lines_"))
    found = repeated_positions(docs).withColumnsRenamed({"doc_id": at, "row": row, "covered": covered})
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(at)) & (_row() == F.col(row)), "left")
    cut = joined.withColumn(lines, F.when(F.col(covered).isNotNull(), F.split("text", "\n", -1)))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(covered))
    rest = F.array_join(F.transform(keep, lambda i: F.col(lines)[i]), "\n")
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return cut.withColumns(
        {
            "text": F.when(F.col(covered).isNull(), F.col("text")).otherwise(rest),
            "n_lines": F.coalesce(breaks + 1, F.lit(0)),
            "n_removed": F.coalesce(F.size(covered), F.lit(0)),
        }
    ).drop(at, row, covered, lines)


SQL = """
with lined as (select doc_id, text, md5(text) as row, string_split(text, chr(10)) as lines from documents),
spots as (select doc_id, row, lines, unnest(range(1, len(lines) - 1)) as pos from (select distinct doc_id, row, lines from lined) where len(lines) >= 3),
windows as (select doc_id, row, pos, struct_pack(a := lines[pos], b := lines[pos + 1], c := lines[pos + 2]) as w from spots
  where regexp_matches(lines[pos] || lines[pos + 1] || lines[pos + 2], '[^\\x20\\x09-\\x0D]')),
ranked as (select doc_id, row, pos, row_number() over (partition by w order by doc_id nulls last, row, pos) as place from windows),
covered as (select distinct doc_id, row, unnest([pos, pos + 1, pos + 2]) as line from ranked where place > 1),
gone as (select doc_id, row, list(line) as covered from covered group by doc_id, row)
select l.doc_id,
  case when g.covered is null then l.text else coalesce(array_to_string([l.lines[i] for i in range(1, len(l.lines) + 1) if not list_contains(g.covered, i)], chr(10)), '') end as text,
  cast(coalesce(len(l.lines), 0) as integer) as n_lines, cast(coalesce(len(g.covered), 0) as integer) as n_removed
from lined l left join gone g on l.doc_id is not distinct from g.doc_id and l.row = g.row
"""
