"""Near-duplicates by order MinHash (OMH), verified by banded alignment.

**Sketch.** K-mers are runs of five words, labelled with their occurrence number. For each of ``SKETCHES`` hash functions
the ``PICKED`` k-mers with the smallest hashes are taken *in text order*; a sketch is the hash of that sequence, so it
agrees only if the k-mers are shared and stand in the same order, which follows edit similarity more closely than sets.

**Candidates.** Equal texts are one node from the start. Nodes that share a sketch form a bucket, and all pairs of a bucket
are candidates. As only classes are asked for, a pair inside one class needs no comparison. So every node is first compared
with at most two others: the hubs (the node that shares most sketches) of its largest and of its smallest bucket
(a group of thousands of near copies costs two comparisons each, not the square). Then the
rest is settled exactly: in buckets of at most ``SMALL`` nodes by all pairs across classes, in larger ones by those pairs
across classes that pass a prefix filter. The filter loses no link: texts with a distance of at most a fifth have four
fifths of the longer one's words in common, so if the words of each (with their occurrence numbers) are ordered by how many
of the texts left hold them, the first fifth and one more of both lists have a word in common, and behind it enough words
are left. A passage that many texts share stands at the end of these lists and makes no pairs. Nothing is capped; texts
that hold nearly the same words and are still in many classes keep the square of their number.

**Verification.** Two texts are linked if their word edit distance is at most a fifth of the longer one's words
(similarity of 0.8 or more). The distance is computed on a diagonal band, bit-parallel, with a band that is widened until
the distance fits or the limit is reached; a comparison of the word counts, a lower bound, goes first.

**Classes** are the connected components of the links: steps that join the neighbours of each node to their smallest one,
on tables in the shared folder. Nothing but counters and a bitmap of at most 8 MB reaches the driver; the bitmap keeps texts that share no
sketch out of the shuffle.

Null text is empty; empty texts are copies of one another. Texts of fewer than five words have one k-mer. Repeated rows
are copies. Null ids are kept; a class whose ids are all null has a null class. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameline.llm.common import fresh, keep
from frameline.llm.minhash import Fingerprinter

KMER = 5
SKETCHES = 24
PICKED = 2
SMALL = 8
FIRST_BAND = 16
BITMAP = 26
SEED = 8128

_LABEL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


class OrderSketcher:
    def __init__(self, sketches: int = SKETCHES, picked: int = PICKED, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 63, sketches, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.b = rng.integers(0, 1 << 63, sketches, np.uint64)[:, None]
        self.salt = rng.integers(0, 1 << 63, sketches, np.uint64)
        self.picked = picked
        self._words = Fingerprinter(1)

    def kmers(self, text: str, k: int = KMER) -> np.ndarray:
        """Hashes of the occurrence-labelled k-mers, in text order."""
        plain = Fingerprinter.shingles(self._words.word_hashes(text.split()), k)
        order = np.argsort(plain, kind="stable")
        ranked = plain[order]
        starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        if len(starts) < len(plain):
            seen = np.empty(len(plain), np.uint64)
            seen[order] = np.arange(len(plain)) - np.repeat(starts, np.diff(np.append(starts, len(plain))))
            plain = plain ^ (seen * _LABEL)
        plain = plain * _MIX
        return plain ^ (plain >> np.uint64(29))

    def of(self, text: str) -> np.ndarray:
        found = self.kmers(text)
        values = self.a * found + self.b
        rows = np.arange(len(values))
        places = []
        for _ in range(min(self.picked, len(found))):
            at = values.argmin(axis=1)
            values[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
            places.append(at)
        key = self.salt.copy()
        for at in np.sort(np.array(places), axis=0):
            key = (key ^ found[at]) * _MIX
            key ^= key >> np.uint64(31)
        return key.view(np.int64)


def banded_distance(a: list[str], b: list[str], k: int) -> int | None:
    """Edit distance of two word lists if it is at most ``k``, on the diagonals -k to k; else None.

    Bit t of a vector stands for row ``j - k + t`` of column j, so the band moves down one row with each column.
    """
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    m, n = len(a), len(b)
    if abs(m - n) > k:
        return None
    if not m or not n:
        return max(m, n)
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << (2 * k + 1)) - 1
    up, down = full & ~((1 << k) - 1), 0
    distance, last = min(k, m), 1 << (2 * k)
    for j in range(1, n + 1):
        match, shift = where.get(b[j - 1], 0), j - k - 1
        match = (match >> shift if shift >= 0 else match << -shift) & full
        same = (((match & up) + up) ^ up) | match | down
        right_up = (down | ~(same | up)) & full
        right_down = same & up
        if j <= m - k:
            distance += not same & last
        else:
            row = 1 << (m - j + k)
            distance += bool(right_up & row) - bool(right_down & row)
        same = (same & full) >> 1
        up = (right_down | ~(same | right_up)) & full
        down = same & right_up
    return distance if distance <= k else None


def alike(a: str, b: str) -> bool:
    """Whether the word edit distance is at most a fifth of the longer text's words."""
    left, right = a.split(), b.split()
    limit = max(len(left), len(right)) // 5
    if abs(len(left) - len(right)) > limit:
        return False
    count, other = Counter(left), Counter(right)
    least = max((count - other).total(), (other - count).total())
    if least > limit:
        return False
    band = min(FIRST_BAND, limit)
    while band < least:
        band = min(4 * band, limit)
    while True:
        if banded_distance(left, right, band) is not None:
            return True
        if band >= limit:
            return False
        band = min(4 * band, limit)


def nodes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``node`` (64-bit hash of the text: two of n different texts meet with a chance of n² / 2^65) and ``text``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"))


def sketches(rows: DataFrame) -> DataFrame:
    """``node`` and ``sketches``, one row per different text (copies are reduced before the shuffle)."""

    def run(batches):
        maker = OrderSketcher()
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "sketches": [maker.of(t) for t in batch["text"]]})

    return rows.select("node", "text").mapInPandas(run, "node long, sketches array<long>").groupBy("node").agg(F.first("sketches").alias("sketches"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def buckets(one: DataFrame) -> DataFrame:
    """``key``, ``node``, ``n`` of every bucket of two or more nodes (the keys of different sketches are salted)."""
    members = one.select("node", F.explode("sketches").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return members.join(sizes, "key")


def _mixed(seated: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``key``, ``node``, ``n``, ``label`` of the buckets that hold several classes."""
    if labels is None:
        return seated.withColumn("label", F.col("node"))
    named = seated.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = named.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low != _high").select("key")
    return keep(named.join(spread, "key", "left_semi"), "mixed")


def hub_pairs(mixed: DataFrame, largest: bool | None = None) -> DataFrame:
    """Every node with the hub of its largest or smallest bucket (None: of both) whose hub is of another class."""
    ranks = mixed.groupBy("node").agg(F.sum("n").alias("_rank"))
    hubs = mixed.join(ranks, "node").groupBy("key").agg(F.max_by(F.struct("node", "label"), F.struct("_rank", "node")).alias("_hub"))
    met = mixed.join(hubs, "key").filter("_hub.label != label")
    ends = [F.max_by("_hub.node", F.struct(F.col("n") if most else -F.col("n"), "key")) for most in (True, False) if largest in (most, None)]
    chosen = met.groupBy("node").agg(F.array(*ends).alias("_hubs"))
    return _ordered(chosen.select(F.col("node").alias("x"), F.explode("_hubs").alias("y")))


def small_pairs(mixed: DataFrame, small: int = SMALL) -> DataFrame:
    """All pairs across the classes of the buckets of at most ``small`` nodes."""
    few = mixed.filter(F.col("n") <= small)
    left = few.select("key", F.col("node").alias("x"), F.col("label").alias("_l"))
    right = few.select("key", F.col("node").alias("y"), F.col("label").alias("_r"))
    return _ordered(left.join(right, "key").filter("x < y and _l != _r").select("x", "y"))


def word_lists(kept_texts: DataFrame) -> DataFrame:
    """``node`` and ``words``: a hash of each word with its occurrence number (equal hashes only add candidates)."""

    def run(batches):
        maker = OrderSketcher()
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "words": [maker.kmers(t, 1).view(np.int64) if t.strip() else [] for t in batch["text"]]})

    return kept_texts.select("node", "text").mapInPandas(run, "node long, words array<long>")


def prefixes(mixed: DataFrame, kept_texts: DataFrame, small: int = SMALL) -> DataFrame:
    """The first fifth and one more of each list of words in larger buckets, as far as other texts hold them.

    ``word``, ``node``, ``label``, ``keys``, ``len``, the whole prefix as ``list`` and ``left``, the words from this one on.
    """
    many = mixed.filter(F.col("n") > small).groupBy("node", "label").agg(F.collect_set("key").alias("keys"))
    lists = word_lists(kept_texts.join(many.select("node").hint("merge"), "node", "left_semi"))
    dealt = lists.select("node", F.size("words").alias("len"), F.explode("words").alias("word"))
    held = dealt.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("word")))
    # a word that no other text holds makes no pair, but comes first in the list
    shared = held.filter("held > 1").groupBy("node", "len").agg(F.sort_array(F.collect_list(F.struct("held", "word"))).alias("_list"))
    sized = shared.withColumn("own", F.col("len") - F.size("_list"))
    first = sized.withColumn("_list", F.slice("_list.word", F.lit(1), F.greatest(F.lit(0), F.floor(F.col("len") / 5).cast("int") + 1 - F.col("own"))))
    flat = first.join(many, "node").select("node", "label", "keys", "len", "own", F.col("_list").alias("list"), F.posexplode("_list").alias("at", "word"))
    return flat.withColumn("left", F.col("len") - F.col("own") - F.col("at")).drop("own", "at")


def prefix_pairs(mixed: DataFrame, kept_texts: DataFrame, small: int = SMALL) -> DataFrame:
    """All pairs across the classes of larger buckets that the prefix filter cannot rule out."""
    flat = keep(prefixes(mixed, kept_texts, small), "prefixes")
    left, right = (flat.select("word", *[F.col(c).alias(f"{c}{i}") for c in ("node", "label", "keys", "len", "list", "left")]) for i in (1, 2))
    longer = F.greatest("len1", "len2")
    fits = F.least("left1", "left2") >= longer - F.floor(longer / 5)
    once = F.array_intersect("list1", "list2")[0] == F.col("word")  # a pair is made by its first common word
    met = left.join(right, "word").filter(F.expr("node1 < node2 and label1 != label2") & fits & F.arrays_overlap("keys1", "keys2") & once)
    return _ordered(met.select(F.col("node1").alias("x"), F.col("node2").alias("y")))


def verified(pairs: DataFrame, kept_texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike. ``kept_texts``: node, text. No side is small enough to broadcast for long."""
    with_b = pairs.hint("merge").join(kept_texts.select(F.col("node").alias("b"), F.col("text").alias("_tb")), "b")
    both = with_b.hint("merge").join(kept_texts.select(F.col("node").alias("a"), F.col("text").alias("_ta")), "a").select("a", "b", "_ta", "_tb")

    def run(batches):
        for batch in batches:
            good = [alike(s, t) for s, t in zip(batch["_ta"], batch["_tb"])]
            yield batch.loc[good, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def _stars(edges: DataFrame) -> DataFrame:
    """One step of :func:`components`: every node and its neighbours get an edge to the smallest of them.

    ``a`` (smallest), ``b``, ``own`` (the edge of the node itself, at most one), ``new`` (it was not among the node's edges).
    """
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
    near = Window.partitionBy("x").orderBy("y")
    seen = both.filter("x != y").select("x", "y", F.least("x", F.first("y").over(near)).alias("a"), F.lag("y").over(near).alias("_last"))
    own = F.col("y") == F.col("a")
    return seen.filter("_last IS NULL OR _last != y").select("a", F.when(own, F.col("x")).otherwise(F.col("y")).alias("b"), own.alias("own"), (~own & (F.col("a") != F.col("x"))).alias("new"))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node of its component) for every node of ``edges`` (a, b).

    With each step a node meets the smallest of its neighbours' neighbours at least. A step makes no new edge only if every node
    is either smaller than all its neighbours or has one neighbour, a smaller one.
    """
    while True:
        edges = keep(_stars(edges), "edges")
        if not edges.agg(F.max("new")).first()[0]:
            return edges.filter("own").select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())


def _marked(asked: DataFrame):
    """A test whether a node may be among ``asked``: a bitmap of its lowest bits (16 a node, 2^``BITMAP`` at most)."""
    spark = asked.sparkSession
    bits = min(BITMAP, max(16, (16 * asked.count()).bit_length()))
    place = F.col("node").bitwiseAND(F.lit((1 << bits) - 1))
    slots = asked.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(node & 63 AS INT))")).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[slots["slot"].to_numpy()] = slots["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def may_be(node: pd.Series) -> pd.Series:
        at = node.to_numpy() & ((1 << bits) - 1)
        return pd.Series((sent.value[at >> 6] >> (at & 63)) & 1 == 1)

    return may_be


def _chosen_texts(rows: DataFrame, seated: DataFrame) -> DataFrame:
    """One text for each node of a bucket and for few others; most texts of no bucket and copies in a task are left out before the shuffle."""
    may_be = _marked(seated.select("node").distinct())
    return keep(rows.select("node", "text").filter(may_be("node")).groupBy("node").agg(F.first("text").alias("text")), "texts")


def near_classes(docs: DataFrame, small: int = SMALL) -> DataFrame:
    """``doc_id``, ``node``, ``class_id`` (smallest ``doc_id`` of the class) and ``class_size`` of every document."""
    rows = nodes(docs)
    one = keep(sketches(rows), "nodes")
    seated = keep(buckets(one), "buckets")
    known = _chosen_texts(rows, seated)
    rest = lambda mixed: small_pairs(mixed, small).unionByName(prefix_pairs(mixed, known, small)).distinct()
    done, labels = None, None
    for pairs_of in (hub_pairs, rest):
        mixed = _mixed(seated, labels)
        if mixed.isEmpty():
            break
        pairs = pairs_of(mixed)
        pairs = keep(pairs if done is None else pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        done = pairs if done is None else done.unionByName(pairs)
        added = keep(verified(pairs, known), "links")
        labels = components(added if labels is None else added.unionByName(labels.select(F.col("label").alias("a"), F.col("node").alias("b"))))
    named = rows.select("doc_id", "node")
    named = named.withColumn("label", F.col("node")) if labels is None else named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = keep(named, "members")
    sizes = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return named.join(sizes, "label").select("doc_id", "node", "class_id", "class_size")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one row for each class: that with the smallest ``doc_id`` (null only if all are)."""
    classes = near_classes(docs)
    place = F.coalesce("doc_id", F.lit(2**63 - 1))
    group = F.struct("class_id", F.when(F.col("class_id").isNull(), F.col("node")))  # classes without ids: by text
    stays = classes.groupBy(group.alias("_group")).agg(F.min(F.struct(place.alias("place"), "node")).alias("best"))
    at, node = fresh(docs, "_place"), fresh(docs, "_node")
    stays = stays.select(F.col("best.place").alias(at), F.col("best.node").alias(node))
    marked = docs.withColumn(at, F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))).withColumn(node, F.xxhash64(F.coalesce("text", F.lit(""))))
    left = marked.join(stays, [at, node], "left_semi").dropDuplicates([at, node])
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
