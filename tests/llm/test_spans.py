"""Token alignment against whole-text tokenizing and a plain sweep over the bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from frameline.llm import bpe, pieces, spans

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "B", "é", "ß", " ", "  ", "\n", " \n ", "\x00", "<s>", "<|endoftext|>", "<0x41>", "中", "国", "😀", "ing", " the", "1", "23", "...", "\t", "\x1c ", "ｂ ", "　", "\xa0", "'s", "’ll"]


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, pairs string")


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as f:
        return spans.Aligner(f.read(), pieces.read_model(B))


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        letters = {c: i for i, c in enumerate(bpe.byte_letters())}
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items() if t != "<|endoftext|>"}

    def tokens(self, text):
        a = [(i, self.a_bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()) for i in self.b.encode(text) for n in [self.b.id_to_piece(i)]]
        want = (" " + text).encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return [], []
        return a, b

    @staticmethod
    def ranges(tokens):
        at, out = 0, []
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def rows(self, texts):
        done, held = [], Counter()
        for doc_id, text in texts:
            a, b = map(self.ranges, self.tokens(text or ""))
            links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
            held.update(set(links))
            groups, one, two = [], [], []
            ends = {e for _, _, e in a} & {e for _, _, e in b}
            for e in sorted(ends):
                one, two = [x for x in a if x[2] <= e], [x for x in b if x[2] <= e]
                a, b = a[len(one) :], b[len(two) :]
                groups.append(",".join(str(x[0]) for x in one) + "|" + ",".join(str(x[0]) for x in two))
            n = [sum(g.split("|")[k].count(",") + 1 for g in groups) for k in (0, 1)]
            done.append((doc_id, *n, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        top = defaultdict(int)
        for (x, _), n in held.items():
            top[x] = max(top[x], n)
        return [(d, na, nb, ng, len(ls), sum(held[p] == top[p[0]] for p in ls), sum(held[p] for p in ls), h) for d, na, nb, ng, ls, h in done]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def mixed(r, n):
    return "".join(r.choice(BITS) for _ in range(r.randint(0, n)))


def test_refined_ends_are_those_of_the_decoded_bytes(aligner, plain):
    r = random.Random(1)
    for _ in range(1500):
        text = "".join(r.choice(BITS) for _ in range(r.randint(1, 30)))
        got = aligner.ends(text)
        a, b = plain.tokens(text)
        if not a:
            assert got is None
            continue
        assert [(i, e) for i, _, e in plain.ranges(a)] == list(zip(got[0].tolist(), got[1].tolist())), text
        assert [(i, e) for i, _, e in plain.ranges(b)] == list(zip(got[2].tolist(), got[3].tolist())), text


def test_stretches_together_equal_the_whole_text(aligner, plain):
    r = random.Random(2)
    texts = [(i, mixed(r, 60)) for i in range(600)] + [(-1, "a▁b"), (-2, ""), (-3, " "), (-4, "   x  "), (-5, "word " * 400)]
    want = plain.rows(texts)
    got = list(aligner.align([t for _, t in texts]))
    assert [(d, na, nb, ng, len(links), h) for (d, _), (na, nb, ng, h, links) in zip(texts, got)] == [(w[0], w[1], w[2], w[3], w[4], w[7]) for w in want]


def test_special_strings_are_plain_text(aligner):
    assert 50256 not in aligner.ends("a <|endoftext|> b")[0].tolist()


def test_text_with_the_space_mark_has_no_tokens(aligner):
    assert aligner.ends("a▁b") is None
    assert [x[:4] for x in aligner.align(["a▁b", None, ""])] == [(0, 0, 0, "")] * 3


def test_rows_equal_brute_force(spark, plain):
    r = random.Random(3)
    texts = [(i, mixed(r, 80)) for i in range(120)] + [(7, "the same"), (7, "the same"), (None, "the same"), (8, None), (9, ""), (10, "a▁b"), (11, "the cat sat " * 500)]
    want = sorted(plain.rows(texts), key=str)
    for shard in (spans.SHARD, 150):  # one broadcast, and many
        got = sorted((tuple(x) for x in spans.align_tokens(docs(spark, *texts), A, B, shard).collect()), key=str)
        assert got == want
    assert spans.align_tokens(docs(spark).limit(0), A, B).count() == 0
    assert [x.n_links for x in spans.align_tokens(docs(spark, (1, None)), A, B).collect()] == [0]


def test_stores_and_runs_are_bounded(aligner, monkeypatch):
    r = random.Random(4)
    texts = [" ".join(f"w{r.randrange(10**5)}" for _ in range(60)) for _ in range(30)]
    want = [(x[:4], x[4].tolist()) for x in aligner.align(texts)]
    for name, value in (("STORE", 40), ("RUN", 50), ("LONGEST_STORED", 5)):
        monkeypatch.setattr(spans, name, value)
    aligner.store, aligner.older = {}, {}
    assert [(x[:4], x[4].tolist()) for x in aligner.align(texts)] == want
    assert max(len(aligner.store), len(aligner.older)) <= 40
