"""Substring dedup with fixed-block anchors.

A repeat of ``window`` words that starts anywhere in a document contains one of that document's aligned, non-overlapping
blocks of ``(window + 1) // 2`` words (13 words: blocks of 7). So only the blocks are indexed, and every rolling window
of block length of every document probes them; hits are extended to exact repeats.

1. *Probe.* Documents are read in batches; the hashes of blocks and of rolling windows are dealt by hash into as many
   buckets as the corpus needs (``PER_BUCKET`` windows each). Within a batch and bucket they are packed into one row, so
   a passage that a third of all documents share is many small packed entries and no hot row. A bucket streams its rows
   in the order blocks, windows, blocks: after the blocks it knows the smallest document of each block hash, after
   the windows the largest document that probed it; memory holds the distinct block hashes of one bucket. The answer is
   the list of hits: a window meets a block of a smaller document, a block is met by a larger document. Documents are
   dealt into parts of ``PER_PART`` characters; the answers of all buckets to all documents of a part travel packed and
   are put together to one row for each document with hits, however many buckets there are.
2. *Extend.* Documents with hits compute the hashes of the whole windows around them: around a block that was met (as
   reference) and around a window that met one (as candidate). They meet in buckets in the same way; a candidate whose
   whole window starts in a smaller document is a repeat. Overlapping repeats join to maximal exact repeats.
3. *Cut.* The words of the maximal repeats are removed from the text, which is joined to its answers by id.

Hashes have 32 bits plus the bucket in step 1 (a chance hit only costs work in step 2) and 48 bits plus the bucket in
step 2: with ``PER_BUCKET`` entries a chance hit has a probability of about 3e-8 per probe, whatever the corpus is.

Words are runs of characters other than ASCII space and U+0009 to U+000D, unchanged. Null text has no words; a text
shorter than the window keeps all its words. Repeats inside one document, and between rows with one ``doc_id``, are not
removed. A null ``doc_id`` counts as larger than any other. Repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameline.llm.common import ascii_words, pieces_of

WINDOW = 13
PER_BUCKET = 8_000_000
PER_PART = 2_000_000
PACK_AT = 500_000  # hashes after which a batch is packed, for bounded memory
ANSWERS_AT = 1_000_000  # the same for hits
NARROW, WIDE = 4, 6  # bytes of a hash in the two steps
NO_ID = 2**63 - 1

_MIX = np.uint64(0xD6E8FEB86659FD93)
_JOIN = np.uint64(0xFF51AFD7ED558CCD)
_LOW = np.uint64(32)
PACKED = "bucket int, kind int, ids binary, counts binary, hashes binary"
PACKED_ANSWERS = "part int, ids binary, codes binary, counts binary, spots binary"
ANSWERS = "place long, mark long, answers binary"


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ^ (a >> _LOW)) * _JOIN + b


def _rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """One well-mixed 64-bit hash for each run of exactly ``size`` words, joined from runs of 1, 2, 4, ... words."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    count, out, done, runs, width = len(hashes) - size + 1, None, 0, hashes, 1
    while True:
        if size & width:
            part = runs[done : done + count]
            out = part if out is None else _joined(out, part)
            done += width
        if 2 * width > size:
            break
        runs, width = _joined(runs[:-width], runs[width:]), 2 * width
    out = (out ^ (out >> _LOW)) * _MIX
    return out ^ (out >> np.uint64(29))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _LOW) % np.uint64(buckets)).astype(np.int64)


def _packed(hashes: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(data: bytes, width: int) -> np.ndarray:
    cells = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(cells), 8), np.uint8)
    out[:, :width] = cells
    return out.view("<u8").ravel()


class _Packer:
    """Collects (document, hashes) of a batch and packs them by bucket, keeping the order within each document."""

    def __init__(self, buckets: int, width: int):
        self.buckets, self.width = buckets, width
        self._start()

    def _start(self) -> None:
        self.held = 0
        self.ids: list[tuple[int, int]] = []
        self.parts: dict[int, list[np.ndarray]] = {}
        self.owner: dict[int, list[np.ndarray]] = {}

    def add(self, key: tuple[int, int], kinds: dict[int, np.ndarray]) -> None:
        self.ids.append(key)
        for kind, hashes in kinds.items():
            if len(hashes):
                self.held += len(hashes)
                self.parts.setdefault(kind, []).append(hashes)
                self.owner.setdefault(kind, []).append(np.full(len(hashes), len(self.ids) - 1, np.int32))

    def rows(self) -> pd.DataFrame:
        out = []
        ids = np.array(self.ids, np.int64).reshape(-1, 2)
        for kind, parts in self.parts.items():
            hashes, owner = np.concatenate(parts), np.concatenate(self.owner[kind])
            place = _bucket(hashes, self.buckets)
            order = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[order], np.arange(self.buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                mine = order[edges[b] : edges[b + 1]]
                who, counts = np.unique(owner[mine], return_counts=True)
                out.append((b, kind, ids[who].T.tobytes(), counts.astype(np.uint32).tobytes(), _packed(hashes[mine], self.width)))
        self._start()
        return pd.DataFrame(out, columns=["bucket", "kind", "ids", "counts", "hashes"])


class _Smallest:
    """Distinct hashes with the smallest document of each, merged part by part."""

    def __init__(self):
        self.hashes, self.least = None, None
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, hashes: np.ndarray, places: np.ndarray) -> None:
        self._waiting.append((hashes, places))
        self._size += len(hashes)
        if self._size > 2_000_000 + (0 if self.hashes is None else len(self.hashes)):
            self.settle()

    def settle(self) -> None:
        if not self._waiting:
            return
        waiting = self._waiting + ([] if self.hashes is None else [(self.hashes, self.least)])
        hashes, places = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
        order = np.lexsort((places, hashes))
        hashes, places = hashes[order], places[order]
        first = np.append(True, hashes[1:] != hashes[:-1])
        self.hashes, self.least, self._waiting, self._size = hashes[first], places[first], [], 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash: its slot, and whether it is there."""
        self.settle()
        if self.hashes is None or not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return slot, self.hashes[slot] == hashes


def _unpacked(batch: pd.DataFrame, width: int):
    for bucket, kind, ids, counts, hashes in batch[["bucket", "kind", "ids", "counts", "hashes"]].itertuples(index=False, name=None):
        places, marks = np.frombuffer(ids, np.int64).reshape(2, -1)
        counts = np.frombuffer(counts, np.uint32).astype(np.int64)
        yield bucket, kind, places, marks, counts, _wide(hashes, width)


def _runs(counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Indexes of the members of runs of ``counts`` members, run by run in the given order."""
    starts, taken = np.cumsum(counts) - counts, counts[order]
    return np.repeat(starts[order] - (np.cumsum(taken) - taken), taken) + np.arange(taken.sum())


def _part(places: np.ndarray, marks: np.ndarray, parts: int) -> np.ndarray:
    mixed = (places.view(np.uint64) * _MIX) ^ marks.view(np.uint64)
    return ((mixed * _MIX >> _LOW) % np.uint64(parts)).astype(np.int64)


class _Hits:
    """Runs of hits: the document, a code (bucket and kind) and, in ``spots``, which of its hashes there were hit."""

    def __init__(self):
        self._start()

    def _start(self) -> None:
        self.held = 0
        self.runs: list[tuple[np.ndarray, ...]] = []

    def add(self, places, marks, codes, counts, spots) -> None:
        self.held += len(spots)
        self.runs.append((places, marks, codes, counts, spots))

    def add_bits(self, places, marks, counts, bucket, kind, yes) -> None:
        hits, ends = np.flatnonzero(yes), np.cumsum(counts)
        owner = np.searchsorted(ends, hits, side="right")
        spots = (hits - (ends - counts)[owner]).astype(np.uint32)
        who, each = np.unique(owner, return_counts=True)
        self.add(places[who], marks[who], np.full(len(who), 2 * bucket + kind - 1, np.uint32), each.astype(np.uint32), spots)

    def _taken(self):
        places, marks, codes, counts, spots = (np.concatenate(x) for x in zip(*self.runs))
        self._start()
        return places, marks, codes, counts.astype(np.int64), spots

    def by_part(self, parts: int) -> pd.DataFrame:
        out = []
        if self.runs:
            places, marks, codes, counts, spots = self._taken()
            part = _part(places, marks, parts)
            order = np.argsort(part, kind="stable")
            found, edges = np.unique(part[order], return_index=True)
            for p, mine in zip(found.tolist(), np.split(order, edges[1:])):
                ids = np.concatenate([places[mine], marks[mine]])
                out.append((p, ids.tobytes(), codes[mine].tobytes(), counts[mine].astype(np.uint32).tobytes(), spots[_runs(counts, mine)].tobytes()))
        return pd.DataFrame(out, columns=["part", "ids", "codes", "counts", "spots"])

    def settle(self) -> None:
        """Runs by document and code; repeated rows have the same answers, of which one is kept."""
        if not self.runs:
            return
        places, marks, codes, counts, spots = self._taken()
        order = np.lexsort((codes, marks, places))
        same = np.ones(len(order), bool)
        same[0] = False
        for x in (places, marks, codes):
            same[1:] &= x[order][1:] == x[order][:-1]
        order = order[~same]
        self.add(places[order], marks[order], codes[order], counts[order].astype(np.uint32), spots[_runs(counts, order)])

    def by_document(self) -> pd.DataFrame:
        out = []
        self.settle()
        if self.runs:
            places, marks, codes, counts, spots = self._taken()
            first = np.flatnonzero(np.append(True, (places[1:] != places[:-1]) | (marks[1:] != marks[:-1])))
            last = np.append(first[1:], len(places))
            ends = np.append(0, np.cumsum(counts))
            for i, j in zip(first.tolist(), last.tolist()):
                cells = np.concatenate([[j - i], codes[i:j], counts[i:j], spots[ends[i] : ends[j]]])
                out.append((int(places[i]), int(marks[i]), cells.astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["place", "mark", "answers"])


def _meet(width: int, parts: int):
    """Reducer of both meetings: kind 0 references, kind 1 probes, kind 2 references again (if they want an answer)."""

    def run(batches):
        at, known, largest, hits = None, None, None, _Hits()
        for batch in batches:
            for bucket, kind, places, marks, counts, hashes in _unpacked(batch, width):
                if bucket != at:
                    at, known, largest = bucket, _Smallest(), None
                owner = np.repeat(places, counts)
                if kind == 0:
                    known.add(hashes, owner)
                    continue
                slot, there = known.find(hashes)
                if largest is None:
                    largest = np.full(0 if known.hashes is None else len(known.hashes), -1 << 63, np.int64)
                if not there.any():
                    continue
                if kind == 1:
                    np.maximum.at(largest, slot[there], owner[there])
                    yes = there & (known.least[slot] < owner)
                else:
                    yes = there & (largest[slot] > owner)
                hits.add_bits(places, marks, counts, bucket, kind, yes)
                if hits.held > ANSWERS_AT:
                    yield hits.by_part(parts)
        yield hits.by_part(parts)

    return run


def _together(batches):
    """Packed answers, sorted by part, to one row for each document."""
    at, hits = None, _Hits()
    for batch in batches:
        for part, ids, codes, counts, spots in batch[["part", "ids", "codes", "counts", "spots"]].itertuples(index=False, name=None):
            if part != at:
                yield hits.by_document()
                at, limit = part, 4 * ANSWERS_AT
            places, marks = np.frombuffer(ids, np.int64).reshape(2, -1)
            hits.add(places, marks, *(np.frombuffer(x, np.uint32) for x in (codes, counts, spots)))
            if hits.held > limit:
                hits.settle()
                limit = 4 * ANSWERS_AT + 2 * hits.held
    yield hits.by_document()


def _hit_places(hashes: np.ndarray, buckets: int, answers: bytes | None, kind: int) -> np.ndarray:
    """Indexes of ``hashes`` that the answers of this kind name."""
    if answers is None or not len(hashes):
        return np.empty(0, np.int64)
    cells = np.frombuffer(answers, np.uint32)
    n = int(cells[0])
    codes, counts = cells[1 : n + 1], cells[n + 1 : 2 * n + 1].astype(np.int64)
    asked = (codes & 1) == kind - 1
    spots = cells[2 * n + 1 :][np.repeat(asked, counts)].astype(np.int64)
    place = _bucket(hashes, buckets)
    order = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[order], (codes[asked] >> 1).astype(np.int64))
    return np.sort(order[np.repeat(starts, counts[asked]) + spots])


def _around(hits: np.ndarray, before: int, count: int) -> np.ndarray:
    """Indexes i of the ``count`` whole windows with ``hit - before <= i <= hit`` for some hit, ascending."""
    if not len(hits) or count <= 0:
        return np.empty(0, np.int64)
    edge = np.zeros(count + 1, np.int64)
    np.add.at(edge, np.clip(hits - before, 0, count), 1)
    np.add.at(edge, np.clip(hits + 1, 0, count), -1)
    return np.flatnonzero(np.cumsum(edge)[:-1] > 0)


class _Reader:
    """Hashes of one document's words, and its windows in the two meetings."""

    def __init__(self, window: int, buckets: int):
        self.window, self.block, self.buckets = window, (window + 1) // 2, buckets

    def short(self, text: str) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        words = ascii_words(text)
        hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
        rolling = _rolling(hashes, self.block)
        if len(words) < self.window:  # no whole window: nothing to remove, nothing to offer
            rolling = rolling[:0]
        return rolling, rolling[:: self.block], words, hashes

    def whole(self, text: str, answers) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Hashes of the whole windows, indexes of references and of candidates among them, and the words."""
        rolling, blocks, words, hashes = self.short(text)
        full = _rolling(hashes, self.window)
        reach = self.window - self.block
        met = _hit_places(blocks, self.buckets, answers, 2) * self.block
        meets = _hit_places(rolling, self.buckets, answers, 1)
        return full, _around(met, reach, len(full)), _around(meets, reach, len(full)), words


def _tasks(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), place.alias("place"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _met(packed: DataFrame, buckets: int, parts: int, width: int) -> DataFrame:
    """``place``, ``mark`` and ``answers`` of the documents with hits."""
    pieces = pieces_of(packed.sparkSession)
    dealt = packed.repartition(max(1, min(buckets, pieces)), "bucket").sortWithinPartitions("bucket", "kind")
    answers = dealt.mapInPandas(_meet(width, parts), PACKED_ANSWERS)
    return answers.repartition(max(1, min(parts, pieces)), "part").sortWithinPartitions("part").mapInPandas(_together, ANSWERS)


def repeats(docs: DataFrame, window: int = WINDOW, per_bucket: int = PER_BUCKET, per_part: int = PER_PART) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (kept words joined by one space) and ``spans`` (start and end word
    of each maximal repeat) of every document."""
    rows = _tasks(docs)
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / 6 / per_bucket))  # about six characters to a word
    parts = max(1, math.ceil(total / per_part))

    def probe(batches):
        reader = _Reader(window, buckets)
        for batch in batches:
            packer = _Packer(buckets, NARROW)
            for place, mark, text in zip(batch["place"], batch["mark"], batch["text"]):
                rolling, blocks, _, _ = reader.short(text)
                packer.add((place, mark), {0: blocks, 1: rolling, 2: blocks})
                if packer.held > PACK_AT:
                    yield packer.rows()
            yield packer.rows()

    def extend(batches):
        reader = _Reader(window, buckets)
        for batch in batches:
            packer = _Packer(buckets, WIDE)
            for place, mark, text, answers in zip(batch["place"], batch["mark"], batch["text"], batch["answers"]):
                full, reference, candidate, _ = reader.whole(text, answers)
                packer.add((place, mark), {0: full[reference], 1: full[candidate]})
                if packer.held > PACK_AT:
                    yield packer.rows()
            yield packer.rows()

    def cut(batches):
        reader = _Reader(window, buckets)
        for batch in batches:
            out = []
            for doc_id, text, answers, found in zip(batch["doc_id"].array, batch["text"], batch["answers"], batch["found"]):
                starts = np.empty(0, np.int64)
                if found is not None:
                    full, _, candidate, words = reader.whole(text, answers)
                    starts = candidate[_hit_places(full[candidate], buckets, found, 1)]
                else:
                    words = ascii_words(text)
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + window, -1)
                inside = np.cumsum(gone)[:-1] > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
                kept = " ".join([w for w, x in zip(words, inside.tolist()) if not x]) if len(starts) else " ".join(words)
                out.append((doc_id, len(words), int(inside.sum()), kept, turn.reshape(-1, 2).tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept", "spans"]).astype({"doc_id": "Int64"})

    met = _met(rows.select("place", "mark", "text").mapInPandas(probe, PACKED), buckets, parts, NARROW)
    asked = rows.join(met, ["place", "mark"], "left")
    # The same columns as in the last step, so that the shuffle of the texts is used twice.
    with_hits = asked.filter("answers is not null").select("doc_id", "place", "mark", "text", "answers")
    found = _met(with_hits.mapInPandas(extend, PACKED), buckets, parts, WIDE).withColumnRenamed("answers", "found")
    both = asked.join(found, ["place", "mark"], "left")
    return both.select("doc_id", "text", "answers", "found").mapInPandas(cut, "doc_id long, n_words long, n_removed long, kept string, spans array<array<int>>")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT doc_id, r, i, hash(list_slice(words, i, i + 12)) AS h FROM (SELECT doc_id, r, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
), f AS (SELECT h, min(doc_id) AS first_doc FROM g GROUP BY h),
s AS (SELECT r, list(i) AS starts FROM g JOIN f USING (h) WHERE first_doc < doc_id GROUP BY r),
c AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM (SELECT r, unnest(starts) AS i FROM s)) GROUP BY r),
k AS (SELECT w.doc_id, w.words, coalesce(c.gone, []) AS gone FROM w LEFT JOIN c USING (r))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
  sha256(CASE WHEN len(gone) = 0 THEN array_to_string(words, ' ') ELSE coalesce(array_to_string(list_filter(list_transform(words, lambda x, i: CASE WHEN list_contains(gone, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL), ' '), '') END) AS kept_sha256
FROM k
"""
