"""Alignment of the tokens of two tokenizers over the bytes of each text.

A byte-level BPE of the tokenizers library (A) reads a space and the text, a sentencepiece model (B) reads the text and
puts that space in front itself. Both give spans: A the *character* offsets of its encoding, B the spans of its
``SentencePieceText`` message (read with ``return_type="proto"``; the installed version no longer has the immutable
form). These are **coarse cuts**: where a character of several bytes is spread over tokens, A gives each of them the
whole character, and B gives a byte-fallback token before the last an empty span. Such tokens are **refined** with their
decoded bytes: they end as many bytes behind the last certain end as their bytes and those since then are long. At the
end the joined bytes of either side have to be the text.

From two ascending lists of ends all else follows. Ends that both have cut the tokens into *groups*. Between two
neighbouring ends of either list lies exactly one pair of overlapping tokens, a *link*, so the links of a text are as
many as its different ends.

A space behind a character that is no white space is an end in both (both cut in front of it, and neither looks back),
so a text falls into stretches that are aligned apart: what a stretch gives is kept in a bounded store, and the missing
ones of many texts go through both tokenizers in one call.

**Corpus counts.** The links of each text, reduced to different pairs of ids and how often each occurs, are written once
with the other columns. The documents of a pair are counted from that table by Spark (partial sums before the shuffle).
The counts then go back to the texts as sorted arrays of at most ``SHARD`` pairs a broadcast: pairs are dealt by hash
into as many shards as they need, each shard is one pass over the written table, and the sums of the passes are added.
Nothing that grows with the number of documents passes the driver.
"""

from __future__ import annotations

import hashlib
import json
import operator
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from frameline.llm.bpe import byte_letters
from frameline.llm.common import keep, texts
from frameline.llm.pieces import SPACE, read_model

LOW = 20  # bits of a B id in a pair
STORE = 250_000  # stretches of a generation; two are kept
LONGEST_STORED = 48
RUN = 1 << 17  # characters that go through the tokenizers at once
BLOCK = 1 << 21  # characters of texts whose results are held at once
SHARD = 4_000_000  # pairs of a broadcast (17 bytes each)
_ANCHOR = "a"  # a first stretch, so that no run starts with a space of its own
_STRETCH = re.compile(r".+?(?:(?<=\S)(?= )|\Z)", re.DOTALL)
_PIECE = operator.attrgetter("id", "end")
_NOT_REGULAR = re.compile(r"\s ")

Record = tuple[int, int, int, str, bytes]  # tokens of A, of B, groups, groups as text (each with its end mark), pairs of the links


class Aligner:
    """Two tokenizers, given as the JSON text and the model bytes of their files."""

    def __init__(self, a_json: str, b_model: bytes):
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        spec = json.loads(a_json)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("A has to be a byte-level BPE without normaliser and prefix space")
        byte_of = {c: i for i, c in enumerate(byte_letters())}
        names = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max([*names.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        self.a_size = np.array([len(b) for b in self.a_bytes])
        self.a_sure = np.array([_is_text(b) for b in self.a_bytes])  # others hold parts of characters
        self.b = SentencePieceProcessor(model_proto=b_model)
        if self.b.get_piece_size() >> LOW:
            raise ValueError("B has too many pieces")
        self.b_bytes = [bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.b_size = np.array([len(b) for b in self.b_bytes])
        self.b_sure = np.array([not self.b.is_byte(i) for i in range(len(self.b_bytes))])
        # names with what may follow them in the list of groups
        self.a_more, self.a_last = (np.array([f"{i}{mark}" for i in range(len(self.a_bytes))], object) for mark in ",|")
        self.b_more, self.b_last = (np.array([f"{i}{mark}" for i in range(len(self.b_bytes))], object) for mark in ",;")
        self.store: dict[str, Record | None] = {}
        self.older: dict[str, Record | None] = {}

    # one text or run -----------------------------------------------------------------------------------------------

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of A and of B over a space and ``text``; None where the bytes of either are not those."""
        full = " " + text
        raw = full.encode()
        encoding = self.a.encode(full, add_special_tokens=False)
        a_ids = np.array(encoding.ids, np.int64)
        a_ends = _refined(_byte_places(full, raw)[np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 1]], a_ids, self.a_size, self.a_sure)
        pieces = self.b.encode(text, return_type="proto").pieces
        b_read = np.array(list(map(_PIECE, pieces)), np.int64).reshape(-1, 2)
        b_ids = b_read[:, 0]
        b_ends = _refined(b_read[:, 1] + 1, b_ids, self.b_size, self.b_sure)
        if b"".join(map(self.a_bytes.__getitem__, encoding.ids)) != raw or b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) != raw:
            return None
        return a_ids, a_ends, b_ids, b_ends

    def links(self, a_ids, a_ends, b_ids, b_ends) -> tuple[np.ndarray, np.ndarray]:
        """Ends of all links, and their pairs (id of A above the ``LOW`` bits, id of B in them)."""
        at = np.union1d(a_ends, b_ends)
        return at, a_ids[np.searchsorted(a_ends, at)] << LOW | b_ids[np.searchsorted(b_ends, at)]

    def _records(self, run: list[str]) -> list[Record | None]:
        """Records of stretches (their first space left out) that are tokenized together."""
        got = self.ends(" ".join([_ANCHOR, *run]))
        if got is None:
            return [None] if len(run) == 1 else [r for stretch in run for r in self._records([stretch])]
        a_ids, a_ends, b_ids, b_ends = got
        at, pairs = self.links(*got)
        cut = np.intersect1d(a_ends, b_ends, assume_unique=True)
        stops = np.cumsum([len(s.encode()) + 1 for s in [_ANCHOR, *run]])
        cuts, links = np.searchsorted(cut, stops, "right").tolist(), np.searchsorted(at, stops, "right").tolist()
        a_to, b_to = np.searchsorted(a_ends, stops, "right").tolist(), np.searchsorted(b_ends, stops, "right").tolist()
        names = np.concatenate([
            np.where(np.isin(a_ends, cut, assume_unique=True), self.a_last[a_ids], self.a_more[a_ids]),
            np.where(np.isin(b_ends, cut, assume_unique=True), self.b_last[b_ids], self.b_more[b_ids]),
        ])
        group = np.concatenate([np.searchsorted(cut, a_ends) * 2, np.searchsorted(cut, b_ends) * 2 + 1])  # A's tokens of a group come first
        names, raw, out = names[np.argsort(group, kind="stable")].tolist(), pairs.tobytes(), []
        for i in range(1, len(stops)):
            a, b, first, last = a_to[i - 1], b_to[i - 1], a_to[i], b_to[i]
            out.append((first - a, last - b, cuts[i] - cuts[i - 1], "".join(names[a + b : first + last]), raw[links[i - 1] * 8 : links[i] * 8]))
        return out

    # many texts ----------------------------------------------------------------------------------------------------

    def records(self, wanted: Iterable[str]) -> dict[str, Record | None]:
        """The record of each stretch, from the store or tokenized in runs of bounded size."""
        out: dict[str, Record | None] = {}
        run, size = [], 0

        def finish():
            for stretch, record in zip(run, self._records(run)):
                out[stretch] = record
                if len(stretch) <= LONGEST_STORED:
                    self._put(stretch, record)

        for stretch in wanted:
            record = self.store.get(stretch)
            if record is None:
                record = self.older.get(stretch)
                if record is not None:
                    self._put(stretch, record)
            if record is not None:
                out[stretch] = record
                continue
            run.append(stretch)
            size += len(stretch) + 1
            if size >= RUN or not stretch or stretch[-1].isspace():  # A looks beyond white space: nothing may follow
                finish()
                run, size = [], 0
        if run:
            finish()
        return out

    def _put(self, stretch: str, record: Record | None) -> None:
        if len(self.store) >= STORE:
            self.store, self.older = {}, self.store
        self.store[stretch] = record

    @staticmethod
    def stretches(text: str) -> list[str] | None:
        """Stretches without their first space; None for a text without tokens for certain."""
        if not text or SPACE in text:  # B reads that character as a space
            return None
        full = " " + text
        if _NOT_REGULAR.search(full):
            return [s[1:] for s in _STRETCH.findall(full)]
        return text.split(" ")

    def align(self, block: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """Tokens of A and B, groups, digest of the groups, and the pairs of all links, for each text."""
        cut = [self.stretches(text or "") for text in block]
        known = self.records(set().union(*[c for c in cut if c is not None]))
        for stretches in cut:
            got = [known[s] for s in stretches] if stretches is not None else [None]
            if None in got:
                yield 0, 0, 0, "", np.zeros(0, np.int64)
                continue
            a, b, groups, listed, links = zip(*got)
            yield sum(a), sum(b), sum(groups), hashlib.sha256("".join(listed)[:-1].encode()).hexdigest(), np.frombuffer(b"".join(links), np.int64)


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def _byte_places(text: str, raw: bytes) -> np.ndarray:
    """The byte at which each character starts, and the end."""
    if len(raw) == len(text):
        return np.arange(len(raw) + 1)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))]).astype(np.int64)


def _refined(coarse: np.ndarray, ids: np.ndarray, size: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Coarse ends, where a token is whole text; elsewhere decoded bytes behind the last certain end."""
    whole = sure[ids]
    if whole.all():
        return coarse
    run = np.cumsum(size[ids])
    last = np.maximum.accumulate(np.where(whole, np.arange(len(ids)), -1))
    return np.where(last < 0, run, coarse[last] + run - run[last])


@lru_cache(maxsize=1)
def _loaded(a_json: str, b_model: bytes) -> Aligner:
    return Aligner(a_json, b_model)


def _blocks(column: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``BLOCK`` characters each (a longer text is one of its own)."""
    first = size = 0
    for i, text in enumerate(column):
        size += len(text or "")
        if size >= BLOCK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(column):
        yield first, len(column)


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, times array<int>"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One written row per text: token and group counts, digest of the groups, and its different pairs with their times.

    ``row`` numbers the written rows. Texts without tokens (null, empty, or bytes that differ) have zeros, an empty
    digest and empty lists. Other columns are ignored.
    """
    with open(a_path, encoding="utf-8") as f:
        files = docs.sparkSession.sparkContext.broadcast((f.read(), read_model(b_path)))
    shape = ALIGNED.removeprefix("row long, ")

    def run(batches):
        aligner = _loaded(*files.value)
        for batch in batches:
            text = batch.column("text").to_pylist()
            for first, last in _blocks(text):
                rows = list(aligner.align(text[first:last]))
                found = [np.unique(r[4], return_counts=True) for r in rows]
                stops = np.concatenate([[0], np.cumsum([len(p) for p, _ in found])]).astype(np.int32)
                columns = [
                    batch.column("doc_id").slice(first, last - first),
                    *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                    pa.array([len(r[4]) for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.string()),
                    pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate([p for p, _ in found]))),
                    pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate([t for _, t in found]).astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    done = texts(docs).mapInArrow(run, shape)
    return keep(done.select(F.monotonically_increasing_id().alias("row"), "*"), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it linked) and ``best`` (no pair of the same A id is in more); written."""
    counted = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    same_a = Window.partitionBy(F.shiftright("pair", LOW))  # at most as many rows as B has pieces
    return keep(counted.select("pair", "n", (F.col("n") == F.max("n").over(same_a)).alias("best")), "pairs")


BASE = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _scored(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``BASE`` with ``n_best`` and ``count_sum`` of the links whose pairs are in ``counts`` (about ``SHARD`` at most)."""
    table = counts.orderBy("pair").toArrow()
    known = rows.sparkSession.sparkContext.broadcast((table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy(zero_copy_only=False)))

    def run(batches):
        pair, n, best = known.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            wanted = lists.flatten().to_numpy()
            stops = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            sums = [np.zeros(batch.num_rows, np.int64)] * 2
            if len(pair):
                place = np.minimum(np.searchsorted(pair, wanted), len(pair) - 1)
                held = (pair[place] == wanted) * times
                sums = [np.diff(np.concatenate([[0], np.cumsum(held * what[place])])[stops]) for what in (best, n)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, BASE), *map(pa.array, sums)], [*BASE, "n_best", "count_sum"])

    return rows.select(*BASE, "pairs", "times").mapInArrow(run, ALIGNED[: ALIGNED.index(", pairs")] + ", n_best long, count_sum long")


def align_tokens(docs: DataFrame, a_path: str, b_path: str, shard: int = SHARD) -> DataFrame:
    """Per text: tokens of both sides, groups, links, links that are a best pair of their A id, and the sum of counts.

    A document is a row: repeated rows count each, a null id stays null. Ties for the highest count are all best.
    Texts without tokens (null, empty, bytes that differ from a space and the text) have zeros and ``groups_sha256`` ''.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = aligned(docs, a_path, b_path)
    counts = pair_counts(rows)
    shards = max(1, -(-counts.count() // shard))
    if shards == 1:
        scored = _scored(rows, counts)
    else:
        mine = F.pmod(F.xxhash64("pair"), F.lit(shards))
        parts = [keep(_scored(rows, counts.filter(mine == s)), f"scored-{s}") for s in range(shards)]
        together = parts[0]
        for part in parts[1:]:
            together = together.unionByName(part)
        scored = together.groupBy(*BASE).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
