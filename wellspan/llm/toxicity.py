"""Counterfactual-regularised toxicity classifier.

A logistic model over word-form features is trained with a second term: identity terms in
the labelled texts are swapped, once for other terms of their group and once for no term at
all, and the squared change of the score (as a logit) is penalised.  Swaps within a group
alone would let all its terms share one weight; so naming a group carries no weight by
itself, whatever company the name keeps in the training rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside

#: Terms that name groups of people, by language; those of one row stand in for each other.
IDENTITY_TERMS = """
en: woman man person
en: women men people
en: female male nonbinary
en: gay straight bisexual lesbian queer
en: transgender cisgender trans
en: muslim christian jewish hindu buddhist atheist
en: muslims christians jews hindus buddhists atheists
en: black white asian latino hispanic indigenous
en: african european american arab chinese indian mexican
en: immigrant citizen refugee
en: immigrants citizens refugees
en: disabled blind deaf autistic
en: old young elderly
de: frau mann mensch
de: frauen männer menschen
de: schwul lesbisch bisexuell heterosexuell
de: muslim christ jude hindu buddhist atheist
de: muslime christen juden hindus buddhisten atheisten
de: muslimisch christlich jüdisch hinduistisch buddhistisch
de: türke deutscher araber russe pole afrikaner
de: türken deutsche araber russen polen afrikaner
de: ausländer einheimischer flüchtling einwanderer
de: behindert blind gehörlos
fr: femme homme personne
fr: femmes hommes personnes
fr: gay lesbienne bisexuel hétérosexuel homosexuel
fr: musulman chrétien juif hindou bouddhiste athée
fr: musulmans chrétiens juifs hindous bouddhistes athées
fr: arabe français africain chinois noir blanc
fr: arabes français africains chinois noirs blancs
fr: immigré citoyen réfugié étranger
fr: immigrés citoyens réfugiés étrangers
fr: handicapé aveugle sourd
es: mujer hombre persona
es: mujeres hombres personas
es: gay lesbiana bisexual heterosexual homosexual
es: musulmán cristiano judío hindú budista ateo
es: musulmanes cristianos judíos hindúes budistas ateos
es: negro blanco asiático latino indígena gitano
es: negros blancos asiáticos latinos indígenas gitanos
es: inmigrante ciudadano refugiado extranjero
es: inmigrantes ciudadanos refugiados extranjeros
es: discapacitado ciego sordo
"""
IDENTITY_GROUPS = [tuple(x.split()[1:]) for x in IDENTITY_TERMS.strip().split("\n")]
#: A term of several rows is swapped as in the first of them.
SWAP = {t: g[(i + 1) % len(g)] for g in reversed(IDENTITY_GROUPS) for i, t in enumerate(g)}

BUCKETS = 1 << 20
#: Labelled rows used for fitting at most: those with the smallest hashes of their ids.
MOST_LABELLED = 20_000
#: A feature must mark this many toxic rows of the sample to be looked at.
LEAST_TOXIC = 3
REMEMBERED = 200_000

_word = regex.compile(r"[\p{L}\p{M}\p{N}_']+")


def words_of(text: str) -> set[str]:
    return set(_word.findall(text.lower()))


def forms(word: str) -> list[int]:
    """Buckets of a word: the word, its first three to six letters, its inner four-grams."""
    crc = zlib.crc32
    found = [crc(b"w" + word.encode("utf-8", "surrogatepass"))]
    found += [crc(b"p" + word[:k].encode("utf-8", "surrogatepass")) for k in range(3, min(6, len(word) - 1) + 1)]
    found += [crc(b"g" + word[i : i + 4].encode("utf-8", "surrogatepass")) for i in range(len(word) - 3)]
    return [x % BUCKETS for x in found]


@dataclass(frozen=True)
class Model:
    """Weights of the selected buckets."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


class _Forms(dict):
    """Word -> its selected buckets' places; most words have none."""

    def __init__(self, buckets: np.ndarray):
        super().__init__()
        self.place = {int(b): i for i, b in enumerate(buckets)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        place = self.place
        found = tuple({place[b] for b in forms(word) if b in place})
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


def places(words: Iterable[str], known: _Forms) -> list[int]:
    """Distinct selected features of a text."""
    found: set[int] = set()
    for p in map(known.__getitem__, words):
        if p:
            found.update(p)
    return sorted(found)


def fit_logistic(rows: list[list[int]], swapped: list[tuple[int, list[int]]], y: np.ndarray, n: int, penalty: float, ridge: float = 1e-4, steps: int = 600) -> tuple[np.ndarray, float]:
    """Minimise mean log loss + penalty * mean squared logit change under swaps + ridge.

    Accelerated gradient descent over sparse binary rows; ``swapped`` holds the counterfactuals
    of the rows that name a group: the row's number, and its features after the swap.
    """

    def flat(x: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(x)), [len(r) for r in x]), np.array([p for r in x for p in r], np.int64)

    (ri, rj), (si, sj) = flat(rows), flat([x for _, x in swapped])
    origin = np.array([i for i, _ in swapped], np.int64)
    count, named = max(len(y), 1), max(len(swapped), 1)

    def product(i: np.ndarray, j: np.ndarray, v: np.ndarray, n_rows: int) -> np.ndarray:
        return np.bincount(i, v[j], n_rows) if len(j) else np.zeros(n_rows)

    def back(i: np.ndarray, j: np.ndarray, e: np.ndarray) -> np.ndarray:
        return np.bincount(j, e[i], n) if len(j) else np.zeros(n)

    def pulls(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits without bias, and the penalty's gradient by row and by counterfactual."""
        z = product(ri, rj, v, count)
        change = 2.0 * penalty * (z[origin] - product(si, sj, v, len(swapped))) / named
        return z, np.bincount(origin, change, count) if len(origin) else np.zeros(count), change

    # The step comes from the largest curvature, found by power iteration.
    v, vb, most = np.ones(n), 1.0, 1.0
    for _ in range(30):
        z, by_row, change = pulls(v)
        pull = 0.25 * (z + vb) / count
        g, gb = ridge * v + back(ri, rj, pull + by_row) - back(si, sj, change), pull.sum()
        most = float(np.sqrt((g * g).sum() + gb * gb))
        v, vb = g / most, gb / most
    rate = 0.8 / most
    w, b = np.zeros(n), 0.0
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        z, by_row, change = pulls(ahead_w)
        error = (1.0 / (1.0 + np.exp(-np.clip(z + ahead_b, -30, 30))) - y) / count
        grad = ridge * ahead_w + back(ri, rj, error + by_row) - back(si, sj, change)
        new_w, new_b = ahead_w - rate * grad, ahead_b - rate * error.sum()
        nt = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        ahead_w, ahead_b = new_w + (t - 1.0) / nt * (new_w - w), new_b + (t - 1.0) / nt * (new_b - b)
        w, b, t = new_w, new_b, nt
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, penalty: float = 1.0, most_labelled: int = MOST_LABELLED) -> Model:
    """Fit on at most ``most_labelled`` of the rows of ``labels`` (doc_id, toxic 0/1).

    Rows with a null label or id are passed over; with no usable rows the model scores all
    texts alike.  Of rows that share a doc_id the smallest text is the labelled one, so the
    sample stays bounded.  Feature counts are summed over the sample by Spark; the driver gets
    the features that mark toxic rows (of BUCKETS at most) and the sample's rows in terms of
    them.
    """
    few = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled)
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    sample = found.groupBy("doc_id").agg(F.min(F.struct("toxic", "text")).alias("x")).select("x.*").repartition(16)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for y, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(x.as_py() or "")
                found = np.unique(np.array([b for w in words for b in forms(w)], np.int64))
                total[int(y > 0), found] += 1
        seen = np.flatnonzero(total.any(axis=0))
        for i in range(0, len(seen), 100_000):
            part = seen[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *(pa.array(total[k, part].astype(np.int64)) for k in (0, 1))], names=["bucket", "n0", "n1"])

    counts = sample.mapInArrow(count, "bucket bigint, n0 bigint, n1 bigint").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    by_class = {bool(r["toxic"]): r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = by_class.get(False, 0), by_class.get(True, 0)
    if not n1 or not n0:
        return Model(np.empty(0, np.int64), np.empty(0), 20.0 if n1 else -20.0)
    p1, p0 = F.col("n1") / F.lit(float(n1)), F.col("n0") / F.lit(float(n0))
    spread = F.sqrt(p1 * (1 - p1) / n1 + (p0 + 1.0 / n0) * (1 - p0) / n0 + 1e-12)
    chosen = counts.where(F.col("n1") >= LEAST_TOXIC).withColumn("z", (p1 - p0) / spread).where("z > 3 and n1 * %d > 4 * n0 * %d" % (n0, n1))
    # Stated identity terms are always features, so that the penalty can see them.
    named = sorted({b for t in SWAP for b in forms(t)[:1]})
    picked = [r["bucket"] for r in chosen.select("bucket").collect()]
    buckets = np.unique(np.array(picked + named, np.int64))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Forms(buckets)
        for batch in batches:
            rows, swaps = [], []
            for x in batch.column(1):
                words = words_of(x.as_py() or "")
                rows.append(places(words, known))
                named = not words.isdisjoint(SWAP)
                swaps.append([places({SWAP.get(w, w) for w in words}, known), places(words - SWAP.keys(), known)] if named else [])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(rows, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.list_(pa.int32())))], names=["y", "x", "s"])

    got = sorted((r["x"], r["y"], r["s"]) for r in sample.mapInArrow(sparse, "y int, x array<int>, s array<array<int>>").collect())
    swapped = [(i, s) for i, (_, _, ss) in enumerate(got) for s in ss]
    weights, bias = fit_logistic([x for x, _, _ in got], swapped, np.array([y > 0 for _, y, _ in got], float), len(buckets), penalty)
    return Model(buckets, weights, bias)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) of each whole text; null and empty texts get the bias.

    Rows are scored one by one without a shuffle; the model is a few thousand numbers.
    """
    keep = beside(keep, ("score",))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Forms(model.buckets)
        for batch in batches:
            z = [model.bias + float(model.weights[places(words_of(x.as_py() or ""), known)].sum()) for x in batch.column(len(keep))]
            found = 1.0 / (1.0 + np.exp(-np.clip(np.array(z, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(found)], names=[*keep, "score"])

    return docs.select(*keep, docs["text"].alias("__text")).mapInArrow(run, schema)
