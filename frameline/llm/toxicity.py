"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its lower-cased words, their stems (first ``STEM`` letters), word pairs and
word pairs with one or two words between them, over the whole text. Training walks ``PASSES`` times over a sample of
labelled texts in a fixed random order; each coordinate has its own rate (by the gradients it has seen), and L1 keeps
coordinates without evidence at exactly zero, so the model is a short list of (index, weight) pairs: at most
``DIMENSIONS`` of them, usually a few hundred. It is broadcast; scoring is a narrow pass.

**Bounded sample.** The model is fitted on at most ``PER_CLASS`` labelled texts of each class, those with the smallest
hash of ``doc_id``. The class shares of all labelled rows enter as a prior correction of the intercept. All texts are
scored.

Labels, lang, source and doc_id are never inputs of a score; rows held out (``crc32(doc_id as text) mod 4 = 2``) are never
used for fitting. Repeated labels of one id count once (toxic if one of them is). Null text is empty; an empty text has
the intercept's score. Without labelled rows of both classes every score is the smoothed share of toxic rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.llm.common import keep

BITS = 20
DIMENSIONS = 1 << BITS
PER_CLASS = 10_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.1
FULL_L1 = 1500  # toxic texts from which on L1 holds; with fewer it shrinks with their root, as the evidence for a word does
PASSES = 2
THRESHOLD = 0.3
STEM = 4
SKIPS = (1, 2, 3)  # distance of the two words of a pair: neighbours, one word between, two words between
WORD_CACHE = 300_000

_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Distinct feature indexes of a text; keeps a bounded cache of word hashes."""

    def __init__(self):
        self._known: dict[str, tuple[int, int]] = {}

    def _hash(self, word: str) -> int:
        """FNV-1a of the word's UTF-8: the same in every process."""
        h = 0xCBF29CE484222325
        for b in word.encode("utf-8", "surrogatepass"):
            h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
        return h

    def of(self, text: str) -> np.ndarray:
        return np.unique(self.all(text))

    def all(self, text: str) -> np.ndarray:
        """Feature indexes as they come, repeats included."""
        known = self._known
        if len(known) > WORD_CACHE:
            known.clear()
        words = _WORD.findall(text.lower())
        if not words:
            return np.empty(0, np.int64)
        pairs = [known.get(w) or known.setdefault(w, (self._hash(w), self._hash(w[:STEM] + "*"))) for w in words]
        hashes, stems = np.array(pairs, np.uint64).T
        mixed = hashes * _MIX
        parts = [mixed, stems * _MIX]
        for gap in SKIPS:
            if len(hashes) > gap:
                parts.append(((hashes[:-gap] * np.uint64(2 * gap + 1)) ^ (mixed[gap:] >> np.uint64(7))) * _MIX + np.uint64(gap))
        return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """Sparse weights; ``index`` is sorted."""

    index: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        w = np.zeros(DIMENSIONS, np.float32)
        w[self.index] = self.weight
        return w


class Ftrl:
    """FTRL-proximal for the logistic loss with features of value 1; the intercept (last coordinate) has no L1."""

    def __init__(self, l1: float = L1, dimensions: int = DIMENSIONS):
        self.l1 = l1
        self.z, self.n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray, float]:
        w = self.weights(np.arange(len(self.z)))
        index = np.flatnonzero(w[:-1])
        return index, w[index], float(w[-1])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``_toxic`` of the labelled rows that may be learnt from."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("_toxic")).dropna()
    return rows.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("_toxic").alias("_toxic"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, passes: int = PASSES) -> Model:
    """Train on at most ``per_class`` labelled texts of each class, in one task; the model alone reaches the driver."""
    rows = keep(training_rows(labels), "labels")
    share = {r._toxic: r.n for r in rows.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = share.get(1, 0), share.get(0, 0)
    if not ones or not zeros:
        rate = (ones + 0.5) / (ones + zeros + 1)
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(rate / (1 - rate))))
    by_hash = F.xxhash64("doc_id")
    sample = rows.filter("_toxic = 1").orderBy(by_hash).limit(per_class).unionByName(rows.filter("_toxic = 0").orderBy(by_hash).limit(per_class))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 x per_class rows of two numbers are broadcast.
    chosen = known.join(F.broadcast(sample), "doc_id").select("text", "_toxic", F.xxhash64("doc_id", "text").alias("_order"))

    l1 = L1 * min(1.0, (min(ones, per_class) / FULL_L1) ** 0.5)

    def train(batches):
        model, features, order, seen, marks = Ftrl(l1), Features(), [], [], []
        for batch in batches:
            seen += [features.of(t).astype(np.int32) for t in batch["text"]]
            marks += batch["_toxic"].tolist()
            order += batch["_order"].tolist()
        for p in range(passes):
            for i in sorted(range(len(order)), key=lambda i: (order[i] * (2 * p + 1)) & 0xFFFFFFFFFFFFFFFF):
                model.learn(seen[i], marks[i])
        index, weight, intercept = model.sparse()
        yield pd.DataFrame({"at": np.append(index, -1), "weight": np.append(weight, intercept)})

    learnt = keep(chosen.repartition(1).mapInPandas(train, "at long, weight double"), "toxicity").toPandas()
    learnt = learnt[learnt["at"] >= 0].sort_values("at"), learnt[learnt["at"] < 0]
    intercept = float(learnt[1]["weight"].sum())
    # Each class was thinned by its own factor; undo that in the log odds.
    intercept += np.log(ones / min(ones, per_class)) - np.log(zeros / min(zeros, per_class))
    return Model(learnt[0]["at"].to_numpy(np.int64), learnt[0]["weight"].to_numpy(float), intercept)


def scorer(spark, model: Model):
    """Column function from text to the probability of label 1."""
    shipped = spark.sparkContext.broadcast(model)
    state: dict = {}

    @F.pandas_udf("double")
    def toxicity(column: pd.Series) -> pd.Series:
        if not state:
            weights = shipped.value.dense()
            state.update(weights=weights, used=weights != 0, features=Features(), intercept=shipped.value.intercept)
        w, used, indexes, b = state["weights"], state["used"], state["features"].all, state["intercept"]
        hits = (at[used[at]] for at in (indexes(t or "") for t in column))
        logits = np.array([b + float(w[np.unique(at)].sum(dtype=np.float64)) for at in hits])
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -35, 35))))

    return toxicity


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    toxic = scorer(docs.sparkSession, fit(docs, labels))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), toxic(F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents whose score reaches the threshold."""
    toxic = scorer(docs.sparkSession, fit(docs, labels))
    return docs.filter(toxic(F.col("text")) < THRESHOLD)
