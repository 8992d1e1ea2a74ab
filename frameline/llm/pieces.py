"""Exact merge-type SentencePiece encoding by backtracking, and decoding as a state machine.

A sentencepiece BPE model starts from single characters and joins, best score first and leftmost first among equal
scores, any two neighbours whose joined text is a piece. That process never has to be run over a text:

* A piece can only occur in a result if its own text encodes to itself. Others are left out of the matcher.
* A split of a text is *the* result if and only if each two neighbours of it, merged anew on their own, stay these two:
  the first merge across an end of a token would also be the first one in the two tokens alone. Up to there, each of the
  two is merged as when it stands alone, so the merges of a token are recorded once and two records are run side by side.

:meth:`PieceBpe.tokens` finds that split. An Aho-Corasick automaton gives the longest piece at every place; it is taken
if it is compatible with the token before it (:meth:`PieceBpe.compatible` merges both anew, with a bounded memory of
answers), otherwise the next shorter piece with the same beginning is tried, and where none is left the last token is
given back. A place from which no way leads on is kept in a bitfield and never tried again: the tokens before a place
are unique, so neither way to it nor way on from it has to be looked at twice.

No piece of a supported model has a space inside or behind other characters, so a text falls into *stretches* (spaces
and what follows up to the next space) that are encoded apart, and longer stretches are cut between any two characters
that stand side by side in no piece. Memory is bounded by a slab of text, a bounded store of short stretches, and the
longest run that cannot be cut.

Supported are BPE models with byte fallback, the identity normaliser, a space in front of the text and white space kept;
others are refused. The model file is read once on the driver and shipped to the tasks (0.5 MB, whatever the corpus is).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from frameline.llm.common import texts

SPACE = "▁"  # fixed value: how a space is written inside pieces
BAD = "�"  # fixed value: stands for a byte that is no text
SLAB = 1 << 16
STORE = 250_000  # stretches of a generation; two are kept
PAIRS = 200_000  # answers of a generation
LONGEST_STORED = 48
NEVER = 1 << 30


class PieceBpe:
    """Pieces of a sentencepiece BPE model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        rules, kind = spec.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        known = {kind.NORMAL, kind.BYTE, kind.CONTROL, kind.UNKNOWN}
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or not spec.trainer_spec.byte_fallback or {p.type for p in spec.pieces} - known:
            raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces) or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser with a space in front and white space kept")
        library = SentencePieceProcessor(model_proto=model)
        self.names = [p.piece for p in spec.pieces]
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i, p in enumerate(spec.pieces) if p.type == kind.CONTROL}
        self.unknown = library.unk_id()
        self.unknown_text = spec.trainer_spec.unk_surface
        places = {score: n for n, score in enumerate(sorted({p.score for p in spec.pieces}, reverse=True))}
        self.rank = {p.piece: places[p.score] for p in spec.pieces if p.type == kind.NORMAL}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece has a space behind other characters")
        self.side_by_side = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        own = [piece for piece in self.ids if self.merged(piece) == [piece]]
        self.matcher = ahocorasick.Automaton()
        for piece in own:
            self.matcher.add_word(piece, piece)
        self.matcher.make_automaton()
        whole = set(own)
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in whole), p[0] if len(p) > 1 else None) for p in own}
        self.inside = {i: p.replace(SPACE, " ") for p, i in self.ids.items()}  # text of a piece that is not the first
        self.records: dict[str, list[tuple[int, str, str]]] = {}  # one for each piece at most
        self.answers: dict[tuple[str, str], bool] = {}
        self.older_answers: dict[tuple[str, str], bool] = {}
        self.forms: dict[str, tuple[int, str, str]] = {}
        self.older_forms: dict[str, tuple[int, str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: best score first, leftmost first among equals."""
        return self._merge(text, [])

    def _merge(self, text: str, record: list[tuple[int, str, str]]) -> list[str]:
        rank, parts = self.rank, list(text)
        waiting = [rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while waiting:
            best = min(waiting)
            if best == NEVER:
                break
            i = waiting.index(best)
            record.append((best, parts[0], parts[-1]))
            parts[i] += parts.pop(i + 1)
            del waiting[i]
            if i < len(waiting):
                waiting[i] = rank.get(parts[i] + parts[i + 1], NEVER)
            if i:
                waiting[i - 1] = rank.get(parts[i - 1] + parts[i], NEVER)
        return parts

    def _record(self, token: str) -> list[tuple[int, str, str]]:
        """The merges of a token in order: rank, and the first and last part before the merge; then its end."""
        record = self.records.get(token)
        if record is None:
            self._merge(token, record := [])
            record.append((NEVER, token, token))
            if token in self.ids:
                self.records[token] = record
        return record

    def _stay(self, left: str, right: str) -> bool:
        """Merges two tokens anew, side by side, until one merge spans them or none is left."""
        rank, ours, theirs, i, j = self.rank, self._record(left), self._record(right), 0, 0
        while True:
            here, _, last = ours[i]
            there, first, _ = theirs[j]
            across = rank.get(last + first, NEVER)
            if across < here and across <= there:  # among equals the leftmost
                return False
            if here == there == NEVER:
                return True
            if here <= there:
                i += 1
            else:
                j += 1

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens side by side stay as they are when their text is merged anew."""
        pair = (left, right)
        known = self.older_answers.get(pair)
        if known is None:
            known = self._stay(left, right)
        if len(self.answers) >= PAIRS:
            self.answers, self.older_answers = {}, self.answers
        self.answers[pair] = known
        return known

    def tokens(self, text: str) -> list[str]:
        """The pieces of a stretch (spaces written as in pieces); a character outside the vocabulary stands for itself."""
        size = len(text)
        longest: list[str] = list(text)
        for end, piece in self.matcher.iter(text):
            longest[end + 1 - len(piece)] = piece
        answers, shorter = self.answers, self.shorter
        failed = bytearray((size >> 3) + 1)
        taken: list[str] = []
        at, token, before = 0, longest[0] if size else "", None
        while at < size:
            end = at + len(token)
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = True if before is None else answers.get((before, token))
                if self.compatible(before, token) if fits is None else fits:
                    taken.append(token)
                    before, at = token, end
                    if at < size:
                        token = longest[at]
                    continue
            less = shorter.get(token)
            if less is None:
                failed[at >> 3] |= 1 << (at & 7)
                token = taken.pop()
                before = taken[-1] if taken else None
                at -= len(token)
            else:
                token = less
        return taken

    def token_ids(self, token: str) -> list[int]:
        """The id of a piece, or those of the UTF-8 bytes of a character without a piece."""
        i = self.ids.get(token)
        return [i] if i is not None else [self.byte_ids[b] for b in token.encode()]

    def stretches(self, text: str) -> Iterator[list[str]]:
        """Lists of stretches, a slab at a time. The first space of each is left out, others are written as in pieces."""
        text, at = text.replace(SPACE, " "), 0
        while at < len(text):
            end = self._slab_end(text, at)
            words = text[at + (at > 0) : end].split(" ")
            yield words if "" not in words else self._joined(words)
            at = end

    @staticmethod
    def _slab_end(text: str, at: int) -> int:
        """The next place behind a slab where a space follows something else, or the end."""
        end = at + SLAB
        while end < len(text):
            end = text.find(" ", end)
            if end < 0:
                break
            if text[end - 1] != " ":
                return end
            end += 1
        return len(text)

    @staticmethod
    def _joined(words: list[str]) -> list[str]:
        """Stretches of words, an empty one for each further space."""
        out, spaces = [], ""
        for word in words:
            if word:
                out.append(spaces + word)
                spaces = ""
            else:
                spaces += SPACE
        return out + [spaces[1:]] if spaces else out

    def _inseparable(self, stretch: str) -> Iterator[str]:
        """Parts of a long stretch, cut between characters that no piece has side by side."""
        first = 0
        for i in range(1, len(stretch)):
            if stretch[i - 1 : i + 1] not in self.side_by_side:
                yield stretch[first:i]
                first = i
        yield stretch[first:]

    def stretch_ids(self, stretch: str) -> list[int]:
        full = SPACE + stretch
        tokens = self.tokens(full) if len(full) <= LONGEST_STORED else [t for part in self._inseparable(full) for t in self.tokens(part)]
        try:
            return [self.ids[t] for t in tokens]
        except KeyError:  # characters outside the vocabulary
            return [i for t in tokens for i in self.token_ids(t)]

    def encode(self, text: str) -> Iterator[int]:
        for slab in self.stretches(text):
            for stretch in slab:
                yield from self.stretch_ids(stretch)

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        machine = PieceMachine(self)
        for i in ids:
            yield machine.feed(i)
        yield machine.finish()

    def decode_inside(self, ids: list[int]) -> str:
        """Text of ids that are not the first of their text."""
        try:
            return "".join([self.inside[i] for i in ids])
        except KeyError:  # bytes
            machine = PieceMachine(self, inside=True)
            return "".join([*map(machine.feed, ids), machine.finish()])

    def form(self, stretch: str) -> tuple[int, str, str]:
        """Number of ids, decimal ids joined by commas, and decoded text of one stretch inside a text."""
        got = self.older_forms.get(stretch)
        if got is None:
            ids = self.stretch_ids(stretch)
            got = len(ids), ",".join(map(str, ids)), self.decode_inside(ids)
        if len(stretch) <= LONGEST_STORED:
            if len(self.forms) >= STORE:
                self.forms, self.older_forms = {}, self.forms
            self.forms[stretch] = got
        return got

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the joined ids and of the decoded text, fed slab by slab."""
        ids, plain, count = hashlib.sha256(), hashlib.sha256(), 0
        for slab in self.stretches(text):
            known, form = self.forms.get, self.form
            numbers, listed, decoded = zip(*[known(w) or form(w) for w in slab])
            joined = "".join(decoded)
            plain.update((joined if count else joined[1:]).encode())  # a stretch starts with a space, the first is none of the text
            ids.update((("," if count else "") + ",".join(listed)).encode())
            count += sum(numbers)
        return count, ids.hexdigest(), plain.hexdigest()


class PieceMachine:
    """Incremental decoding: feed one id at a time; bytes of an unfinished character (three at most) are held."""

    def __init__(self, model: PieceBpe, inside: bool = False):
        self.model, self.inside, self.held = model, inside, b""

    def feed(self, token_id: int) -> str:
        byte = self.model.byte_of.get(token_id)
        if byte is not None:
            self.held += bytes([byte])
            out = self._whole(False)
        else:
            out = self._whole(True)
            if out:
                self.inside = True
            if token_id == self.model.unknown:
                out += self.model.unknown_text
            elif token_id not in self.model.silent:
                name = self.model.names[token_id]
                if not self.inside and name.startswith(SPACE):
                    name, self.inside = name[1:], True
                out += name.replace(SPACE, " ")
        if out:
            self.inside = True
        return out

    def finish(self) -> str:
        return self._whole(True)

    def _whole(self, last: bool) -> str:
        """Finished characters of the held bytes; each byte that can belong to none becomes a mark."""
        out = ""
        while self.held:
            first = self.held[0]
            need = 1 if first < 0x80 else 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 0
            part = self.held[: need or 1]
            if need and len(part) < need and not last and all(0x80 <= b < 0xC0 for b in part[1:]):
                break
            try:
                out += part.decode()
            except UnicodeDecodeError:
                part = part[:1]
                out += BAD
            self.held = self.held[len(part) :]
        return out


@lru_cache(maxsize=2)
def loaded(model: bytes) -> PieceBpe:
    return PieceBpe(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every text (null: empty, which has no token).

    One narrow pass: nothing is shuffled, and a task holds one batch of texts and bounded stores. Repeated rows give
    repeated rows, a null key stays null; other columns are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    shape = StructType([StructField(key, LongType()), StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches):
        bpe = loaded(model.value)
        for batch in batches:
            got = [bpe.digest(t) for t in batch["text"]]
            yield pd.DataFrame({key: batch[key].astype("Int64"), "n_tokens": [g[0] for g in got], "ids_sha256": [g[1] for g in got], "decoded_sha256": [g[2] for g in got]})

    return texts(docs, key).mapInPandas(run, shape)


def encode_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int, empty for a null or empty text) of every row, for writing token shards."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    @F.pandas_udf("array<int>")
    def ids(column: pd.Series) -> pd.Series:
        bpe = loaded(model.value)
        return column.map(lambda t: list(bpe.encode(t)))

    return texts(docs).select("doc_id", ids("text").alias("ids"))


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ``ids`` (null: empty text)."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        bpe = loaded(model.value)
        return column.map(lambda ids: "".join(bpe.decode(map(int, ids))))

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), text(F.coalesce("ids", F.array().cast("array<int>"))).alias("text"))
