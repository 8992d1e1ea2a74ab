"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Items and passages are lower-cased words (``\\w+``); terms are pairs of neighbouring words (an item of one word is a
single-word term). The weight of a term in an item is its BM25 weight divided by the item's own total, so a passage that
holds the whole item scores 1. Every document is cut into passages of two segments, each as long as the longest item, so
that every place an item can stand in lies inside one passage. Each passage is a query; the threshold is fixed, and WAND
skips items whose maximal sum, over the list or over the block, stays below it: all items above it are found.

A candidate counts if enough of the word pairs of both its question and its answer stand in the passage. Without a
column for it, the answer is an item's last sentence (of a single sentence: its last quarter).

The index is as large as the benchmark, not the corpus: items are split into shards of at most ``SHARD_CHARS``
characters (by measured size), each shard's index is broadcast, and every passage is asked against every shard. Document
frequencies and the mean length are those of all items.

Null or wordless items match nothing; null documents are empty. Repeated items count once; repeated documents give
repeated rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameline.llm.common import keep, texts

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.6
POSTINGS_PER_BLOCK = 16
SHARD_CHARS = 64_000_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return sum(parts[:-1], []), parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4) if len(words) > 1 else len(words)
    return words[:cut], words[cut:]


def terms_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:])] if len(words) > 1 else words


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the distinct terms of ``part`` that ``passage`` has; an empty part is covered."""
    wanted = set(terms_of(part))
    if not wanted:
        return 1.0
    there = set(passage) if len(part) == 1 else set(terms_of(passage))
    return len(wanted & there) / len(wanted)


@dataclass
class Index:
    """Postings of one shard, by term number: items ascending, weights, block maxima."""

    items: list[tuple[int | None, list[str], list[str]]]
    longest: int
    words: dict[str, int] = field(default_factory=dict)
    keys: np.ndarray | None = None
    single: bool = False
    tops: np.ndarray | None = None
    postings: list[tuple[list[int], list[float], list[float], float]] = field(default_factory=list)

    def key(self, term: str) -> int:
        first, _, second = term.partition(" ")
        return self.words[first] * (len(self.words) + 1) + (self.words[second] if second else len(self.words))


def build(rows: list, count: int, mean: float, longest: int) -> Index:
    """``rows``: item_id, text, and the document frequency of each distinct term of the item."""
    index = Index([], longest)
    weights: dict[str, list[tuple[int, float]]] = {}
    for row in rows:
        question, answer = question_and_answer(row.text)
        words = question + answer
        terms = terms_of(words)
        tf: dict[str, int] = {}
        for t in terms:
            tf[t] = tf.get(t, 0) + 1
        df = {d["term"]: d["df"] for d in row.terms}
        norm = K1 * (1 - B + B * len(terms) / mean)
        own = {t: math.log(1 + (count - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in tf.items()}
        total = sum(own.values())
        at = len(index.items)
        index.items.append((row.item_id, question, answer))
        for t, w in own.items():
            weights.setdefault(t, []).append((at, w / total))
        for w in words:
            index.words.setdefault(w, len(index.words))
        index.single |= len(words) == 1
    ordered = sorted(weights, key=index.key)
    index.keys = np.array([index.key(t) for t in ordered], np.int64)
    for t in ordered:
        docs, scores = [p[0] for p in weights[t]], [p[1] for p in weights[t]]
        tops = [max(scores[i : i + POSTINGS_PER_BLOCK]) for i in range(0, len(scores), POSTINGS_PER_BLOCK)]
        index.postings.append((docs, scores, tops, max(scores)))
    index.tops = np.array([p[3] for p in index.postings])
    return index


def wand(index: Index, terms: list[int], least: float) -> list[tuple[int, float]]:
    """All items whose summed weights over ``terms`` reach ``least``, by block-max WAND."""
    lists = [index.postings[t] for t in terms]
    at = [0] * len(lists)
    live = list(range(len(lists)))
    found = []
    slack = least - 1e-9
    while live:
        live.sort(key=lambda i: lists[i][0][at[i]])
        bound, pivot = 0.0, None
        for n, i in enumerate(live):
            bound += lists[i][3]
            if bound >= slack:
                pivot = n
                break
        if pivot is None:
            break
        item = lists[live[pivot]][0][at[live[pivot]]]
        while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == item:
            pivot += 1
        block_bound, skip_to = 0.0, None
        for i in live[: pivot + 1]:
            docs, _, tops, _ = lists[i]
            b = at[i] // POSTINGS_PER_BLOCK
            while b < len(tops) and docs[min((b + 1) * POSTINGS_PER_BLOCK, len(docs)) - 1] < item:
                b += 1
            if b < len(tops):
                block_bound += tops[b]
                end = docs[min((b + 1) * POSTINGS_PER_BLOCK, len(docs)) - 1]
                skip_to = end if skip_to is None else min(skip_to, end)
        if block_bound < slack:  # no item up to the nearest block end can reach the threshold
            target = item + 1 if skip_to is None else skip_to + 1
            if pivot + 1 < len(live):
                target = min(target, lists[live[pivot + 1]][0][at[live[pivot + 1]]])
            target = max(target, item + 1)
            moved = live[: pivot + 1]
        elif lists[live[0]][0][at[live[0]]] == item:
            score = sum(lists[i][1][at[i]] for i in live[: pivot + 1])
            if score >= slack:
                found.append((item, score))
            target, moved = item + 1, live[: pivot + 1]
        else:
            target, moved = item, live[:pivot]
        for i in moved:
            docs = lists[i][0]
            while at[i] < len(docs) and docs[at[i]] < target:
                at[i] += 1
        live = [i for i in live if at[i] < len(lists[i][0])]
    return found


def _hits(index: Index, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and term numbers of the index terms in a run of words."""
    known, none = index.words, -1
    ids = np.fromiter((known.get(w, none) for w in words), np.int64, len(words))
    base = len(known) + 1
    first = ids[:-1]
    both = np.flatnonzero((first >= 0) & (ids[1:] >= 0))
    where, key = both, first[both] * base + ids[both + 1]
    if index.single:
        alone = np.flatnonzero(ids >= 0)
        where, key = np.append(where, alone), np.append(key, ids[alone] * base + len(known))
    slot = np.searchsorted(index.keys, key)
    real = slot < len(index.keys)
    real[real] = index.keys[slot[real]] == key[real]
    return where[real], slot[real]


def search(index: Index, words: list[str], least: float = THRESHOLD, needed: float = OVERLAP) -> dict[int, tuple[float, float, float]]:
    """Best score and overlaps of every verified item in a document given as words."""
    if not len(index.keys) or not words:
        return {}
    where, term = _hits(index, words)
    if not len(where):
        return {}
    step = index.longest
    tops = index.tops
    if tops[np.unique(term)].sum() < least - 1e-9:
        return {}
    segment = where // step
    cells = np.unique(segment * len(index.keys) + term)
    segment, term = cells // len(index.keys), cells % len(index.keys)
    names, start = np.unique(segment, return_index=True)
    bound = np.add.reduceat(tops[term], start)
    best: dict[int, tuple[float, float, float]] = {}
    by_name = dict(zip(names.tolist(), range(len(names))))
    ends = np.append(start[1:], len(term))
    for s in sorted({*names.tolist(), *(n - 1 for n in names.tolist() if n)}):
        parts = [by_name[x] for x in (s, s + 1) if x in by_name]
        if sum(bound[p] for p in parts) < least - 1e-9:
            continue
        asked = np.unique(np.concatenate([term[start[p] : ends[p]] for p in parts])).tolist()
        passage = None
        for item, score in wand(index, asked, least):
            passage = words[s * step : (s + 2) * step] if passage is None else passage
            _, question, answer = index.items[item]
            q, a = overlap(question, passage), overlap(answer, passage)
            if q >= needed and a >= needed and (score, q, a) > best.get(item, (0.0, 0.0, 0.0)):
                best[item] = (score, q, a)
    return best


def indexes(items: DataFrame, shard_chars: int = SHARD_CHARS):
    """The index of each shard, one after the other."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna(subset=["text"]).dropDuplicates()
    rows = rows.withColumn("_key", F.xxhash64("item_id", "text"))

    def terms(batches):
        for batch in batches:
            got = [terms_of(sum(question_and_answer(t), [])) for t in batch["text"]]
            yield pd.DataFrame({"_key": batch["_key"], "length": [len(g) for g in got], "term": [sorted(set(g)) for g in got]})

    listed = keep(rows.mapInPandas(terms, "_key long, length long, term array<string>").filter("length > 0"), "items")
    total = listed.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), F.max("length").alias("longest")).first()
    if not total.n:
        return
    each = listed.select("_key", F.explode("term").alias("term"))
    frequency = each.join(each.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term")
    known = keep(rows.join(frequency.groupBy("_key").agg(F.collect_list(F.struct("term", "df")).alias("terms")), "_key"), "items")
    shards = math.ceil((known.agg(F.sum(F.length("text"))).first()[0] or 1) / shard_chars)
    for shard in range(shards):
        mine = known.filter(F.pmod(F.col("_key"), F.lit(shards)) == shard)  # bounded by shard_chars
        yield build(mine.orderBy("item_id", "_key").collect(), total.n, total.mean, total.longest + 1)


def contaminated(docs: DataFrame, items: DataFrame, least: float = THRESHOLD, needed: float = OVERLAP, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap``: one row per item found in a document."""
    shape = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    spark, found = docs.sparkSession, []

    def finder(shipped):
        def run(batches):
            index = shipped.value
            for batch in batches:
                out = []
                for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                    for item, numbers in search(index, words_of(text), least, needed).items():
                        out.append((doc_id, index.items[item][0], *numbers))
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        return run

    for index in indexes(items, shard_chars):
        found.append(texts(docs).mapInPandas(finder(spark.sparkContext.broadcast(index)), shape))
    if not found:
        return spark.createDataFrame([], shape)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _holds_item(shipped):
    @F.pandas_udf("boolean")
    def hit(column: pd.Series) -> pd.Series:
        return column.map(lambda t: bool(search(shipped.value, words_of(t or ""))))

    return hit


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents in which a test item was found."""
    for index in indexes(items):
        docs = docs.filter(~_holds_item(docs.sparkSession.sparkContext.broadcast(index))(F.col("text")))
    return docs
