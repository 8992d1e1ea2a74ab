"""MinHash document fingerprints.

A fingerprint is the vector of minima of ``PERMUTATIONS`` universal hash functions ``(a x + b) mod 2^64`` (a odd, so each
is a permutation of the 64-bit numbers) over the 64-bit hashes of a text's shingles of five words, computed in blocks of
numpy. The upper 32 bits of each minimum are kept. Words are runs of characters other than white space; a text of fewer
than five words is one shingle; a text without words has the fingerprint of the empty shingle, so equal texts always have
equal fingerprints. The likeness of two fingerprints is the share of equal places, which estimates the Jaccard
similarity of the shingle sets.

:func:`similar_pairs` joins signature bands in Spark and verifies the Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameline.llm.common import pieces_of, texts

SHINGLE = 5
PERMUTATIONS = 128
SEED = 20240229
ROWS_PER_BAND = 4
LIKENESS = 0.8
BLOCK = 2048
WORD_CACHE = 300_000

_ODD = np.uint64(0xFF51AFD7ED558CCD)
_ROTATE = np.uint64(32)


class Fingerprinter:
    """Fingerprints of texts; keeps a bounded cache of word hashes."""

    def __init__(self, permutations: int = PERMUTATIONS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.b = rng.integers(0, 1 << 63, permutations, np.uint64)[:, None] * np.uint64(2)
        self._room = np.empty((permutations, BLOCK), np.uint64)
        self._known: dict[str, int] = {}

    def word_hashes(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > WORD_CACHE:
            known.clear()
        return np.array([known[w] if w in known else known.setdefault(w, _word_hash(w)) for w in words], np.uint64)

    @staticmethod
    def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
        """One 64-bit hash for each run of ``size`` words (all words if there are fewer)."""
        if len(hashes) == 0:
            return np.zeros(1, np.uint64)
        size = min(size, len(hashes))
        count = len(hashes) - size + 1
        out = np.zeros(count, np.uint64)
        for i in range(size):
            out = (out ^ (out >> _ROTATE)) * _ODD + hashes[i : i + count]
        return (out ^ (out >> _ROTATE)) * _ODD

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        best = None
        for at in range(0, len(shingles), BLOCK):
            part = shingles[at : at + BLOCK]
            room = self._room[:, : len(part)]
            np.multiply(self.a, part, out=room)
            np.add(room, self.b, out=room)
            low = room.min(axis=1)
            best = low if best is None else np.minimum(best, low)
        return (best >> _ROTATE).astype(np.uint32)

    def of(self, text: str) -> np.ndarray:
        return self.signature(self.shingles(self.word_hashes(text.split())))


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def shown(signature: np.ndarray) -> str:
    """Eight hexadecimal digits for each place."""
    return signature.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` whose last ``floor(n / 2)`` characters are replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _by_descending_id(rows: DataFrame) -> DataFrame:
    """Rows in contiguous runs of descending ``doc_id`` (null last), each run in one partition, followed by the row
    that comes next after the run (``_guest``; after the last run: the first row of all).

    Run edges are quantiles of the ids. The first row of each run is found by one aggregate over the runs (as many rows
    as there are runs, hence broadcast) and sent to the run before it as a guest, so texts are shuffled once and a
    task holds one batch.
    """
    parts = pieces_of(rows.sparkSession)
    place = F.coalesce(-F.col("doc_id"), F.lit(2**63 - 1))
    rows = rows.withColumn("_place", place).withColumn("_tie", F.xxhash64("text"))
    known = rows.filter("doc_id is not null")
    edges = np.array(known.approxQuantile("_place", [i / parts for i in range(1, parts)], 0.001) if parts > 1 else [], float)

    @F.pandas_udf("int")
    def run_of(column: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.unique(edges), column.to_numpy(np.int64).astype(float), side="right"))

    rows = rows.withColumn("_run", run_of("_place"))
    order = F.struct("_place", "_tie")
    first = rows.groupBy("_run").agg(F.min(order).alias("_first"))
    all_runs = Window.orderBy("_run")  # over one row per run
    host = F.coalesce(F.lag("_run").over(all_runs), F.max("_run").over(all_runs.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    first = first.select(F.col("_run"), F.col("_first._place").alias("_place"), F.col("_first._tie").alias("_tie"), host.alias("_host"))
    own = rows.withColumn("_guest", F.lit(0))
    guests = rows.join(F.broadcast(first), ["_run", "_place", "_tie"]).dropDuplicates(["_run"])
    guests = guests.select("doc_id", "text", "_place", "_tie", F.col("_host").alias("_run"), F.lit(1).alias("_guest"))
    return own.unionByName(guests).repartition(parts, "_run").sortWithinPartitions("_run", "_guest", "_place", "_tie")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form (see :func:`edited`), the next document being that with the
    next smaller ``doc_id`` (after the last: the first; null ids come last; equal ids in the order of a hash of the text).

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``. Null text is empty. A single document is its own next one. Other columns are ignored.
    """
    ordered = _by_descending_id(texts(docs)).select("doc_id", "text", "_run", "_guest")

    def run(batches):
        maker = Fingerprinter()
        held = None  # run, id, text, signature of the row before
        for batch in batches:
            out = []
            for doc_id, text, piece, guest in zip(batch["doc_id"].array, batch["text"], batch["_run"], batch["_guest"]):
                signature = maker.of(text)
                if held is not None and held[0] == piece:
                    changed = edited(held[2], text)
                    other = maker.of(changed)
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), shown(held[3]), shown(other), likeness(held[3], other), likeness(held[3], signature)))
                held = None if guest else (piece, doc_id, text, signature)
            yield pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "Int64"})

    return ordered.mapInPandas(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``shingles`` (sorted distinct 64-bit hashes) of every text."""

    def run(batches):
        maker = Fingerprinter()
        for batch in batches:
            sets = [np.unique(maker.shingles(maker.word_hashes(t.split()))) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fingerprint": [shown(maker.signature(s)) for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    return texts(docs).mapInPandas(run, "doc_id long, fingerprint string, shingles array<long>")


def similar_pairs(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """Pairs of classes of equal fingerprints whose signatures share a band and whose shingle sets have a Jaccard
    similarity of at least ``least``: ``a < b`` (smallest ``doc_id`` of each class) and ``jaccard``.

    Texts with the same fingerprint are one class, so that copies do not multiply pairs. Within a band the members of
    a value are joined with the join's skew handling; every pair is verified, and none is capped.
    """
    made = signatures(docs)
    one = made.groupBy("fingerprint").agg(F.min_by(F.struct("doc_id", "shingles"), "doc_id").alias("_one")).select("fingerprint", "_one.doc_id", "_one.shingles")
    width = 8 * ROWS_PER_BAND
    bands = one.select("doc_id", F.expr(f"posexplode(transform(sequence(0, {PERMUTATIONS // ROWS_PER_BAND - 1}), i -> xxhash64(substr(fingerprint, 1 + i * {width}, {width}))))").alias("_band", "_value"))
    other = bands.withColumnRenamed("doc_id", "_b")
    pairs = bands.join(other, (bands["_band"] == other["_band"]) & (bands["_value"] == other["_value"]) & (bands["doc_id"] < other["_b"])).select(bands["doc_id"].alias("a"), F.col("_b").alias("b")).distinct()
    left, right = one.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_s")), one.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_t"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_s", "_t"))
    jaccard = shared / (F.size("_s") + F.size("_t") - shared)
    return both.select("a", "b", jaccard.alias("jaccard")).filter(F.col("jaccard") >= least)
