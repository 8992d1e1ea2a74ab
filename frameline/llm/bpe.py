"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine.

**Lookahead.** Merging in rank order, what is appended to a word can change the boundaries before it only through a
chain of merges: each one spans the place where the two readings part (the front) and moves it to the start of its left
token, and each has a higher rank than the one before. :meth:`Merges.lookahead` follows these chains through the whole
merge list once and returns the largest number of symbols a front can move. A token that ends at least that many
symbols before the end of what has been read is therefore final. :meth:`Merges.stream` reads a word symbol by symbol,
keeps at most ``BLOCK`` plus lookahead symbols, emits the final tokens and goes on from the last of their ends, which
is a boundary no merge crosses. The argument needs a merge list in which a pair comes after the merges that made its
parts; any other list is refused.

**Decoding.** :class:`TextMachine` takes one token at a time, holds the bytes of an unfinished character (three at
most) and gives out text as soon as it is complete. Bytes that are no UTF-8 become U+FFFD.

Normalising and cutting a text into words need the Unicode tables of the tokenizers library (those of Python are newer),
so both are asked of the library's normalizer and pre-tokenizer; merging and decoding are done here.

The model file is read once on the driver and shipped to the tasks (a few MB, whatever the corpus is).
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from frameline.llm.common import split_space, texts

BLOCK = 64
SLAB = 1 << 16
# Fixed value: the word pattern of the tokenizer, narrowed to lower-case ASCII.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
CACHE = 80_000  # pieces of a generation; two are kept
SEEN = 1 << 22
LONGEST_CACHED = 64


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where it is printable Latin-1, else the next free letter from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Merges:
    """Ranks of the merge list, applied to symbols (strings)."""

    def __init__(self, pairs: Iterable[tuple[str, str]], block: int = BLOCK):
        self.rank: dict[tuple[str, str], int] = {}
        made: set[str] = set()
        parts: set[str] = set()
        for pair in pairs:
            whole = "".join(pair)
            if whole in parts:
                raise ValueError(f"the merge list uses {whole!r} before it makes it")
            made.add(whole)
            parts.update(pair)
            self.rank[pair] = len(self.rank)
        self.block = block
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """Largest number of symbols over which appended text can move a boundary."""
        size: dict[str, int] = {}
        moved: dict[str, int] = {}  # by the token that stands at the front: how far the front has moved so far
        for left, right in self.rank:  # in order of rank
            far = moved.get(right, 0) + size.get(left, 1)
            size[left + right] = size.get(left, 1) + size.get(right, 1)
            moved[left + right] = max(moved.get(left + right, 0), far, moved.get(left, 0))
            moved[left] = max(moved.get(left, 0), far)
        return max(moved.values(), default=0) + 1  # the last symbol of a word also differs from the same one inside

    def apply(self, symbols: list[str]) -> list[str]:
        """All merges in order of rank, each from left to right."""
        rank, never, parts = self.rank, len(self.rank), list(symbols)
        waiting = [rank.get(p, never) for p in zip(parts, parts[1:])]
        while waiting:
            first = min(waiting)
            if first == never:
                break
            i = waiting.index(first)
            parts[i] += parts.pop(i + 1)
            del waiting[i]
            if i < len(waiting):
                waiting[i] = rank.get((parts[i], parts[i + 1]), never)
            if i:
                waiting[i - 1] = rank.get((parts[i - 1], parts[i]), never)
        return parts

    def stream(self, symbols: Iterable[str], length: dict[str, int] | None = None) -> Iterator[str]:
        """Tokens of one word, each given out once nothing that follows can change it."""
        held: list[str] = []
        for symbol in symbols:
            held.append(symbol)
            if len(held) < self.block + self.lookahead + 1:
                continue
            at = 0
            for token in self.apply(held[:-1]):
                end = at + self.symbols_of(token, length)
                if end > len(held) - 1 - self.lookahead:
                    break
                yield token
                at = end
            held = held[at:]
        yield from self.apply(held)

    @staticmethod
    def symbols_of(token: str, length: dict[str, int] | None) -> int:
        return length[token] if length else len(token)


class TextMachine:
    """Incremental byte-to-text state machine: feed the bytes of one token at a time."""

    def __init__(self):
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, piece: bytes) -> str:
        return self._state.decode(piece)

    def finish(self) -> str:
        return self._state.decode(b"", True)


class WordBpe:
    """A word-end BPE tokenizer (NFC, white space dropped, lower case) given as the JSON text of its file."""

    def __init__(self, model: str, block: int = BLOCK):
        spec = json.loads(model)
        self.end = spec["model"]["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(spec["model"]["vocab"])
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.names = {i: t for t, i in {**self.ids, **self.special}.items()}
        self.merges = Merges(tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.merges.block = block
        library = Tokenizer.from_str(model)
        self.normalise, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.length = {t: len(t.removesuffix(self.end)) for t in self.ids}
        self.name_bytes = {i: t.encode() for i, t in self.names.items()}
        self.numbers = {i: str(i) for i in self.names}
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.seen = bytearray(SEEN)  # a piece is kept from its second time on, by hash
        self.window = self.merges.block + self.merges.lookahead

    def _words(self, piece: str) -> list[str]:
        """Words of a piece in byte letters. Below U+0250 Python's tables and the library's agree (a test compares them)."""
        if piece.isascii() and piece.isprintable():
            return _ASCII_WORDS.findall(piece.lower())
        if max(piece) < "\u0250" and piece.isalpha() and "\u0130" not in piece:
            return ["".join([self.letters[b] for b in unicodedata.normalize("NFC", piece).lower().encode()])]
        return [word for word, _ in self.cut(self.normalise(piece))]

    def _tokens(self, word: str) -> Iterable[str]:
        if len(word) <= self.window:
            return self.merges.apply([*word[:-1], word[-1] + self.end])
        return self.merges.stream(itertools.chain(itertools.islice(word, len(word) - 1), [word[-1] + self.end]), self.length)

    def encode_piece(self, piece: str) -> Iterator[int]:
        """Ids of a text without white space, in order, as soon as they are stable."""
        for part in self.marks.split(piece) if "<|" in piece and self.marks else [piece]:
            if part in self.special:
                yield self.special[part]
            elif part:
                for word in self._words(part):
                    for token in self._tokens(word):
                        yield self.ids[token]

    def encode(self, text: str) -> Iterator[int]:
        for slab in slabs(text):
            for piece in split_space(slab):
                yield from self.encode_piece(piece)

    def token_bytes(self, token_id: int) -> tuple[bytes, bool]:
        """Bytes of a token, and whether it ends a word."""
        name = self.names[token_id]
        if token_id in self.special.values():
            return name.encode(), True
        ends = name.endswith(self.end)
        return bytes(self.byte_of[c] for c in name.removesuffix(self.end)), ends

    def decode_text(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text: bytes joined, one space after each word but the last."""
        machine, waiting = TextMachine(), ""
        for i in ids:
            piece, ends = self.token_bytes(i)
            yield waiting + machine.feed(piece)
            waiting = " " if ends else ""
        yield machine.finish()

    def decode_tokens(self, ids: Iterable[int]) -> Iterator[str]:
        """The form of a tokenizer file without a decoder: the names of the tokens with one space between them.

        Names are made of the letters of bytes, so the machine gets the UTF-8 of each name."""
        machine, gap = TextMachine(), b""
        for i in ids:
            yield machine.feed(gap + self.name_bytes[i])
            gap = b" "
        yield machine.finish()

    def piece_forms(self, piece: str) -> tuple[str, str]:
        """Decimal ids and decoded tokens of one piece, each joined by a space."""
        got = self.known.get(piece)
        if got is None:
            if piece[-1] in ".," and piece[:-1].isalpha():  # letters and marks are words of their own
                word, mark = self.piece_forms(piece[:-1]), self.piece_forms(piece[-1])
                return f"{word[0]} {mark[0]}", f"{word[1]} {mark[1]}"
            got = self.older.get(piece)
            if got is None:
                ids = list(self.encode_piece(piece))
                got = " ".join([self.numbers[i] for i in ids]), "".join(self.decode_tokens(ids))
            slot = hash(piece) & (SEEN - 1)
            if not self.seen[slot]:
                self.seen[slot] = 1
            elif len(piece) <= LONGEST_CACHED:
                if len(self.known) >= CACHE:
                    self.known, self.older, self.seen = {}, self.known, bytearray(SEEN)
                self.known[piece] = got
        return got

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded text, fed slab by slab."""
        ids, plain, count = hashlib.sha256(), hashlib.sha256(), 0
        for slab in slabs(text):
            forms = [f for f in map(self.piece_forms, split_space(slab)) if f[0]]
            if not forms:
                continue
            gap = " " if count else ""
            listed = " ".join([f[0] for f in forms])
            ids.update((gap + listed).encode())
            plain.update((gap + " ".join([f[1] for f in forms])).encode())
            count += listed.count(" ") + 1
        return count, ids.hexdigest(), plain.hexdigest()


def slabs(text: str, size: int = SLAB) -> Iterator[str]:
    """``text`` cut behind white space into parts of about ``size`` characters (one longer piece stays whole)."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end


_GAP = re.compile("[\t-\r   ]")


@lru_cache(maxsize=2)
def _loaded(model: str) -> WordBpe:
    return WordBpe(model)


def encode_decode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every text (null: empty, which has no token).

    One narrow pass: nothing is shuffled, and a task holds one batch of texts and a bounded cache of short pieces.
    Repeated rows give repeated rows; other columns are ignored; an empty table gives no rows.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    shape = StructType([StructField(key, LongType()), StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches):
        bpe = _loaded(model.value)
        for batch in batches:
            got = [bpe.digest(t) for t in batch["text"]]
            yield pd.DataFrame({key: batch[key], "n_tokens": [g[0] for g in got], "ids_sha256": [g[1] for g in got], "decoded_sha256": [g[2] for g in got]})

    return texts(docs, key).mapInPandas(run, shape)


def encode_ids(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every text, for writing token shards."""
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("array<int>")
    def ids(column: pd.Series) -> pd.Series:
        bpe = _loaded(model.value)
        return column.map(lambda t: list(bpe.encode(t)))

    return texts(docs).select("doc_id", ids("text").alias("ids"))
