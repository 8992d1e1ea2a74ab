"""SentencePiece encoding by backtracking against the library."""

import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from frameline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "B", "é", "ß", " ", "  ", "\n", "▁", "\x00", "<s>", "<0x41>", "中", "国", "😀", "ing", "the", "1", "23", "...", "\t", "    ", "ｂ", "﻿", "ation", "==", "//"]


def docs(spark, *rows):
    """Rows with columns of other operators' names beside them."""
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, ids_sha256 string, n_tokens int")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceBpe(pieces.read_model(PATH))


def test_encoding_equals_the_library(library, model):
    r = random.Random(7)
    for _ in range(2500):
        text = "".join(r.choice(BITS) for _ in range(r.randint(0, 40)))
        ids = library.encode(text)
        assert list(model.encode(text)) == ids, text
        assert "".join(model.decode(ids)) == library.decode(ids)
        want = len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert model.digest(text) == want


def test_letters_without_spaces_need_backtracking(library, model):
    r, given_back = random.Random(2), 0
    for _ in range(1500):
        text = "".join(r.choice(["en", "ation", "lich", "the", "s", "ment", "er", "in", "g", "t"]) for _ in range(r.randint(1, 30)))
        assert list(model.encode(text)) == library.encode(text)
        longest = ["▁" + text][0]
        greedy, at = [], 0
        while at < len(longest):
            end = next(e for e in range(len(longest), at, -1) if longest[at:e] in model.ids)
            greedy.append(longest[at:end])
            at = end
        given_back += greedy != model.tokens(longest)
    assert given_back > 700  # taking the longest piece everywhere would be wrong


def test_compatibility_is_merging_anew(model):
    r, names = random.Random(3), [n for n in model.ids if len(n) < 9]
    yes = 0
    for _ in range(20000):
        left, right = r.choice(names), r.choice(names)
        stay = model.merged(left + right) == [left, right]
        assert model.compatible(left, right) == stay, (left, right)
        yes += stay
    assert 0 < yes < 20000


def test_ends_that_failed_are_not_tried_again():
    """A tiny vocabulary in which nearly every longest piece is wrong; work stays in proportion to the text."""
    spec = sentencepiece_model_pb2.ModelProto()
    kind = spec.SentencePiece
    spec.trainer_spec.model_type, spec.trainer_spec.byte_fallback = spec.trainer_spec.BPE, True
    spec.normalizer_spec.name, spec.normalizer_spec.remove_extra_whitespaces = "identity", False
    for name, of in [("<unk>", kind.UNKNOWN), ("<s>", kind.CONTROL), ("</s>", kind.CONTROL)] + [(f"<0x{b:02X}>", kind.BYTE) for b in range(256)]:
        spec.pieces.add(piece=name, score=0, type=of)
    for n, name in enumerate(["ab", "ba", "aa", "bab", "abab", "aab", "▁a", "babab", "a", "b", "▁"]):
        spec.pieces.add(piece=name, score=-n - 1, type=kind.NORMAL)
    raw = spec.SerializeToString()
    library, model = SentencePieceProcessor(model_proto=raw), pieces.PieceBpe(raw)
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice("ab b") for _ in range(r.randint(0, 40)))
        assert list(model.encode(text)) == library.encode(text), text
    long = "".join(r.choice("ab") for _ in range(200_000))
    assert list(model.encode(long)) == library.encode(long)
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.PieceBpe(spec.SerializeToString())


def test_decoding_any_ids_equals_the_library(library, model):
    r = random.Random(5)
    for _ in range(5000):
        ids = [r.choice([r.randrange(3), r.randrange(3, 259), r.randrange(131, 259), r.randrange(32000), 259, 28705]) for _ in range(r.randint(0, 9))]
        assert "".join(model.decode(ids)) == library.decode(ids), ids


def test_bytes_of_a_character_are_held(model):
    machine = pieces.PieceMachine(model)
    got = [machine.feed(model.byte_ids[b]) for b in "😀!".encode()]
    assert got == ["", "", "", "😀", "!"]


def test_slabs_and_long_runs(library, model, monkeypatch):
    r = random.Random(6)
    texts = ["".join(r.choice(BITS) for _ in range(4000)), " " * 3000, "x" * 3000, "中国" * 2000, ("word  " * 900), " lead", "trail "]
    want = [library.encode(t) for t in texts]
    assert [list(model.encode(t)) for t in texts] == want
    monkeypatch.setattr(pieces, "SLAB", 37)
    monkeypatch.setattr(pieces, "LONGEST_STORED", 5)
    assert [list(model.encode(t)) for t in texts] == want


def test_stores_are_bounded(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "STORE", 50)
    monkeypatch.setattr(pieces, "PAIRS", 50)
    small, r = pieces.PieceBpe(pieces.read_model(PATH)), random.Random(8)
    for _ in range(40):
        text = " ".join(f"w{r.randrange(10**6)}" for _ in range(100))
        assert small.digest(text) == model.digest(text)
        assert max(len(small.forms), len(small.older_forms), len(small.answers)) <= 50


def test_rows(spark, library):
    texts = [(1, "Hello world."), (1, "Hello world."), (2, None), (3, ""), (None, "x" * 500), (4, "word " * 30000), (5, " ")]
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.encode_decode(docs(spark, *texts), PATH).collect())
    want = []
    for i, t in texts:
        ids = library.encode(t or "")
        want.append((i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    assert pieces.encode_decode(docs(spark).limit(0), PATH).count() == 0
    encoded = pieces.encode_ids(docs(spark, *texts), PATH)
    back = sorted((r.doc_id or 0, r.text) for r in pieces.decode_ids(encoded, PATH).collect())
    assert back == sorted((i or 0, t or "") for i, t in texts)
