"""Quality rules with adaptive thresholds.

Per-document measures feed mergeable KLL quantile sketches for each language and source.
Sketches of sources with few documents are merged up to their language, and the fences
drawn from the sketches replace fixed cut-offs in a joined filter.  No fence has a fixed
width: the group's spread sets it, widened only by the counting error of the document's own
measure, so that short texts are not judged by a few characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, materialize, small_side, text_bytes, window_hashes, word_hashes

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
TABLE_ROWS = 3
#: Sources with fewer documents in a language use the fences of the whole language.
LEAST_DOCS = 50
#: Fences stand this many inner-quartile ranges of the group outside its quartiles, and this
#: many counting errors of the document, added as squares.
SPREAD, ERRORS = 6.0, 4.0
MEASURES = ("symbol_ratio", "mean_word_chars", "dup_line_ratio")
#: Measures with a lower fence; few symbols or repeated lines are no fault.
TWO_SIDED = ("mean_word_chars",)


def measure(text: bytes, n_chars: int) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_separators of one text."""
    words = text.split()
    word_chars = n_chars - (len(text) - len(text.translate(None, BLANK)))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), word_chars, n_symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words), separators(lines)


def separators(lines: list[bytes]) -> int:
    """Cell borders: words that are a single | in TABLE_ROWS or more lines running that hold equally many."""
    total = run = last = 0
    for n in [*(x.split().count(b"|") if b"|" in x else 0 for x in lines), 0]:
        if n != last:
            total += run * last if run >= TABLE_ROWS else 0
            run, last = 0, n
        run += 1
    return total


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that the text holds twice or more."""
    if len(words) <= width:
        return 0
    _, place, count = np.unique(window_hashes(word_hashes(words), width), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def with_measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus the measures of each whole text; null is the empty text."""
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_separators"]
    keep = beside(keep, (*names, *MEASURES, *(f"{m}_error" for m in MEASURES), "base_failed", "kept"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [f"{x} bigint" for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            found = [measure(t, len(t.decode("utf-8", "surrogatepass"))) for t in text_bytes(texts)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *columns], names=[*keep, *names])

    # A text that is carried along is sent to Python once.
    at = keep.index("text") if "text" in keep else len(keep)
    measured = docs.select(*keep, *([] if "text" in keep else [docs["text"].alias("__text")])).mapInArrow(run, schema)
    words, chars = F.col("n_words"), F.col("word_chars")

    def share(m: str, part: Column, whole: Column) -> dict[str, Column]:
        # Half a count more, as a count is only known to half a unit: none of 100 is not none of 10,000.
        value = (part + 0.5) / (whole + 1)
        return {m: F.when(whole > 0, value), f"{m}_error": F.when(whole > 0, F.sqrt(value * (1 - value) / (whole + 1)))}

    return measured.withColumns(
        share("symbol_ratio", F.col("n_symbols") - F.col("n_separators"), chars - F.col("n_separators"))
        | share("dup_line_ratio", F.col("n_dup_lines"), F.col("n_lines"))
        | {
            "mean_word_chars": F.when(words > 0, chars / words),
            "mean_word_chars_error": F.when(words > 0, F.sqrt(chars) / words),
            "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        }
    )


def fences(measured: DataFrame) -> DataFrame:
    """One row per (lang, source): the quartiles of each measure.

    Sketches are built map-side and merged in the shuffle, so a hot source costs one
    partial sketch per task.  Documents that fail the base rules do not shape the fences.
    """
    sound = measured.where(~F.col("base_failed"))
    parts = sound.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(m).alias(m) for m in MEASURES))
    parts = materialize(parts)
    whole = parts.groupBy("lang").agg(*(F.kll_merge_agg_double(m).alias(f"all_{m}") for m in MEASURES))
    joined = parts.join(whole.withColumnRenamed("lang", "lang_"), F.col("lang").eqNullSafe(F.col("lang_")), "left")

    def bounds(m: str) -> list[Column]:
        sketch = F.when(F.col("n") >= LEAST_DOCS, F.col(m)).otherwise(F.col(f"all_{m}"))
        return [F.kll_sketch_get_quantile_double(sketch, F.lit(q)).alias(f"{m}_{x}") for x, q in (("low", 0.25), ("high", 0.75))]

    return joined.select("lang", "source", *(c for m in MEASURES for c in bounds(m)))


def judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the measures, ``base_failed`` and ``kept``.

    Null or empty texts have no words and fail the base rules.  Null languages and sources
    form groups of their own.  Repeated rows and repeated ids are judged row by row.
    Columns of ``docs`` other than ``keep``, lang, source and text are not looked at.
    """
    carried = list(dict.fromkeys([*keep, "lang", "source"]))
    # Texts are measured once, and read again from the shared folder.
    measured = materialize(with_measures(docs, carried))
    limits = small_side(materialize(fences(measured)))
    limits = limits.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    near = F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_"))
    cells = F.try_divide(F.col("word_chars") - F.col("n_separators"), F.col("n_words") - F.col("n_separators"))
    inside = F.lit(True)
    for m in MEASURES:
        low, high = F.col(f"{m}_low"), F.col(f"{m}_high")
        gap = F.hypot(SPREAD * (high - low), ERRORS * F.col(f"{m}_error"))
        within = F.col(m) <= high + gap
        if m in TWO_SIDED:
            # Cell borders are short words: what they take from the mean is given back here.
            within &= cells >= low - gap
        inside &= F.coalesce(within, F.lit(True))
    joined = measured.join(limits, near, "left")
    return joined.withColumn("kept", ~F.col("base_failed") & inside).drop("lang_", "source_", *(f"{m}_{x}" for m in MEASURES for x in ("low", "high", "error")))
