"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are densities of a lexicon, nearness of its words to second-person words, capitals, punctuation and obfuscation
rates. The lexicon is a short fixed list and terms learned from the training sample: words, and word beginnings of 4 to 7
letters, that toxic texts hold far more often than others. The sample has at most SAMPLE_ROWS labelled documents outside the
held-out fold; a quarter of it trains the calibration only. labels, lang, source and doc_id are no inputs. Trees and
calibration are Spark ML's; features are made from whole texts, a batch at a time, and nothing is shuffled but the sample.

Defined results: a null or empty text has features of zero and gets their score; repeated rows get equal scores; a null id
is carried and falls in the fold of the empty text; without labels of both classes every score is the smoothed share of
label 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_TABLE_ENTRIES, staged, texts
from .labelled import fold, training_sample

SAMPLE_ROWS = 12_000
FOLDS, HELD_OUT = 4, 2
#: Learned terms at most, their least number of toxic texts, and their least log odds.
TERMS, LEAST_TEXTS, LEAST_ODDS = 3_000, 4, 2.0
STEMS = (4, 5, 6, 7)
#: Fixed words: insults, and words that speak to a reader, in the corpus's languages.
INSULTS = frozenset("idiot moron stupid dumb loser scum trash pathetic worthless disgusting clown".split())
SECOND_PERSON = frozenset("you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch euer ti tú usted vosotros vuestro".split())
_TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Marks between two letters, or four equal characters; one letter on either side is enough, and takes time in proportion.
_OBFUSCATED = re.compile(r"[^\W\d_][\d@$!*#%&+|]+[^\W\d_]|(.)\1\1\1")
NEAR = 6
NAMES = ("fixed", "words", "stems", "odds", "top", "near", "any_near", "capitals", "capital_words", "exclaim", "marks", "digits", "obfuscated", "obfuscated_hits", "length", "hits", "share_hit", "long_stems")


def terms(word: str) -> list[str]:
    """A word, and its beginnings marked by a star; both without case and outer punctuation."""
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


def plain(word: str) -> str:
    return word.strip(_TRIM).lower()


class Judged(dict):
    """raw word -> (fixed, whole, stems, long stems, odds, second person, obfuscated, capitals), or () if all are zero."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, raw: str) -> tuple:
        if len(self) >= WORD_TABLE_ENTRIES:
            self.clear()
        word = plain(raw)
        known = [(t, self.lexicon[t]) for t in terms(word) if t in self.lexicon]
        stems = [t for t, _ in known if t[-1:] == "*"]
        fixed = word in INSULTS
        odds = max([4.0 * fixed, *(w for _, w in known)])
        obfuscated = not raw.isalnum() and bool(_OBFUSCATED.search(raw))
        judged = (fixed, len(known) - len(stems), len(stems), sum(len(t) > 6 for t in stems), odds, word in SECOND_PERSON, obfuscated, raw.isupper())
        value = self[raw] = judged if any(judged) else ()
        return value


def features(text: str, judged: Judged) -> list[float]:
    """The dense features of one whole text, in the order of NAMES."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    found = [(i, v) for i, v in enumerate(map(judged.__getitem__, words)) if v]
    fixed, whole, stem, long_stem, odds, _, obfuscated, capitals = map(sum, zip(*(v for _, v in found), strict=True)) if found else [0] * 8
    hits, people = [i for i, v in found if v[4]], [i for i, v in found if v[5]]
    top, odd_hit = max((v[4] for _, v in found), default=0.0), sum(1 for _, v in found if v[4] and v[6])
    near = 0.0
    if hits and people:
        at, who = np.array(hits), np.array(people)
        place = np.searchsorted(who, at)
        gap = np.minimum(np.abs(at - who[np.minimum(place, len(who) - 1)]), np.abs(at - who[np.maximum(place - 1, 0)]))
        near = float((gap <= NEAR).sum())
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n, size, counts = len(words), len(data), np.bincount(data, minlength=256)
    upper, digits, letters = counts[65:91].sum(), counts[48:58].sum(), counts[97:123].sum()
    marks = counts[33:127].sum() - upper - digits - letters
    rate = lambda x: 1000.0 * x / n
    return list(map(float, (rate(fixed), rate(whole), rate(stem), rate(odds), top, rate(near), near > 0, upper / size, capitals / n, counts[33] / n, marks / size, digits / size, rate(obfuscated), rate(odd_hit), math.log1p(n), math.log1p(len(hits)), len(hits) / n, rate(long_stem))))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """term -> log odds, for at most TERMS terms. Every batch counts its texts first; the sums are made by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = {plain(w) for w in text.split()}
                seen[label > 0].update({t for w in words if w for t in terms(w)})
            names = list(seen[1] | seen[0])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][t] for t in names], pa.int64()), pa.array([seen[0][t] for t in names], pa.int64())], names=["term", "toxic", "clean"])

    total = sample.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    toxic, clean = float(total.toxic or 0), float(total.clean or 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    summed = sample.select("text", "label").mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    best = summed.where(F.col("toxic") >= LEAST_TEXTS).select("term", odds.alias("odds"), "toxic").where(F.col("odds") >= LEAST_ODDS)
    return {r.term: r.odds for r in best.orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term").limit(TERMS).collect()}


def with_features(rows: DataFrame, lexicon: dict[str, float], keep: tuple[str, ...]) -> DataFrame:
    """keep, and the vector column features, for rows with a column text."""
    types = {"doc_id": pa.int64(), "label": pa.float64()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = Judged(lexicon)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                made = [features(t, judged) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(made, pa.list_(pa.float64()))], names=[*keep, "made"])

    schema = ", ".join(f"{k} {'long' if types[k] == pa.int64() else 'double'}" for k in keep) + ", made array<double>"
    return rows.select("text", *(F.col(k).cast("long" if types[k] == pa.int64() else "double").alias(k) for k in keep)).mapInArrow(task, schema).select(*keep, array_to_vector("made").alias("features"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, rows: int = SAMPLE_ROWS, label: str = "toxic") -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    source = texts(docs, id_col, text_col)
    sample = staged(training_sample(source, labels, label, FOLDS, HELD_OUT, rows).select("doc_id", "text", "label").coalesce(8), "toxicity-sample")
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    lexicon = learn_lexicon(sample.where(~calibrates))
    featured = staged(with_features(sample, lexicon, ("doc_id", "label")), "toxicity-features")
    share = featured.groupBy(calibrates.alias("later"), "label").count().collect()
    both = lambda later: len({r.label for r in share if r.later == later}) == 2
    held_out = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    if not both(False):
        ones, n = sum(r["count"] for r in share if r.label > 0), sum(r["count"] for r in share)
        scored = source.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit((ones + 1) / (n + 2)).alias("score"))
    else:
        trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=24, maxDepth=4, maxBins=64, stepSize=0.2, subsamplingRate=0.8, seed=7).fit(featured.where(~calibrates))
        raw = vector_to_array(F.col("probability"))[1]
        score = raw
        judged = trees.transform(with_features(source, lexicon, ("doc_id",))).select("doc_id", raw.alias("raw"))
        if both(True):
            level = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="level").fit(trees.transform(featured.where(calibrates)).select(raw.alias("raw"), "label"))
            judged = level.transform(judged)
            score = 0.98 * F.col("level") + 0.02 * F.col("raw")  # the trees' score orders equal levels
            scored = judged.select("doc_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))
        else:
            scored = judged.select("doc_id", F.col("raw").alias("score"))
    return scored.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
