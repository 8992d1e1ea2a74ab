"""WARC, fingerprints, BPE, secrets, toxicity and chat on small inputs, against exact or brute-force forms."""

import base64
import hashlib
import json
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from frameline.llm import bpe, chat, minhash, secrets, toxicity, urls, warc

PATH = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, *rows):
    """Rows with columns of other operators' names beside them."""
    full = [(i, t, "x", 1.0, 7) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, node string, score double, n_tokens int")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def tokenizer():
    with open(PATH, encoding="utf-8") as f:
        return bpe.WordBpe(f.read())


def test_encoding_equals_the_library(library, tokenizer):
    r = random.Random(7)
    alphabet = ["a", "B", "é", "ß", "Σ", "ος", " ", "\n", "'s", "'RE", "<|endoftext|>", "1", "23", "!!", "...", "́", "😀", "中", "\x1c", "\x85", "İ"]
    for _ in range(150):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(tokenizer.encode(text)) == ids
        assert "".join(tokenizer.decode_tokens(ids)) == library.decode(ids, skip_special_tokens=False)


def test_unicode_below_the_fast_path_limit(library, tokenizer):
    for c in range(0x260):
        text = f"A{chr(c)}b1 {chr(c)} é{chr(c)}z"
        assert list(tokenizer.encode(text)) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_long_words_stream_in_bounded_memory(library, tokenizer):
    r = random.Random(3)
    small = bpe.WordBpe(open(PATH, encoding="utf-8").read(), block=8)
    for _ in range(15):
        word = "".join(r.choice("ainothers") for _ in range(r.randint(200, 900)))
        ids = library.encode(word, add_special_tokens=False).ids
        assert list(small.encode(word)) == ids == list(tokenizer.encode(word))


def test_lookahead_covers_every_boundary_change():
    """Over a tiny merge list: no boundary further from the end than the lookahead moves when text is appended."""
    merges = bpe.Merges([("a", "b"), ("b", "c"), ("c", "a"), ("ab", "c"), ("bc", "a"), ("abc", "a")])
    r = random.Random(1)
    for _ in range(3000):
        word = [r.choice("abc") for _ in range(r.randint(1, 20))]
        more = word + [r.choice("abc") for _ in range(r.randint(1, 4))]

        def ends(tokens):
            return set(np.cumsum([len(t) for t in tokens]).tolist())

        stable = len(word) - merges.lookahead
        assert {e for e in ends(merges.apply(word)) if e <= stable} == {e for e in ends(merges.apply(more)) if e <= stable}


def test_merge_list_out_of_order_is_refused():
    with pytest.raises(ValueError):
        bpe.Merges([("ab", "c"), ("a", "b")])


def test_text_machine_holds_unfinished_characters(tokenizer):
    machine = bpe.TextMachine()
    assert [machine.feed(b) for b in (b"\xf0\x9f", b"\x98", b"\x80!")] == ["", "", "😀!"]
    assert bpe.TextMachine().feed(b"\xff") == "�"
    ids = list(tokenizer.encode("naïve cat 😀"))
    assert "".join(tokenizer.decode_text(ids)) == "naïve cat 😀"


def test_encode_decode_rows(spark, library):
    texts = [(1, "Hello world."), (1, "Hello world."), (2, None), (3, ""), (None, "x" * 500), (4, "word " * 30000)]
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256) for r in bpe.encode_decode(docs(spark, *texts), PATH).collect())
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_decode(docs(spark).limit(0), PATH).count() == 0
    assert [r.ids for r in bpe.encode_ids(docs(spark, (1, "cat")), PATH).collect()] == [library.encode("cat", add_special_tokens=False).ids]


# secrets ---------------------------------------------------------------------------------------------------------


def _field(*parts):
    return b"".join(struct.pack(">I", len(p)) + p for p in parts)


def _der(tag, inside):
    size = bytes([len(inside)]) if len(inside) < 128 else bytes([0x82]) + len(inside).to_bytes(2, "big")
    return bytes([tag]) + size + inside


KEY = _der(0x30, _der(2, b"\0") + _der(2, bytes(range(1, 129))) + _der(2, b"\1\0\1"))
SPKI = _der(0x30, _der(0x30, _der(6, b"*\x86H") + _der(5, b"")) + _der(3, b"\0" + KEY))


def _url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def test_structures_are_confirmed():
    token = ".".join([_url64(json.dumps({"alg": "HS256"}).encode()), _url64(b'{"sub":"1"}'), _url64(b"s" * 32)])
    ssh = base64.b64encode(_field(b"ssh-ed25519", b"k" * 32)).decode()
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(KEY).decode() + "-----END RSA PRIVATE KEY-----"
    for text, kind in ((token, "signed"), (ssh, "sshkey"), (base64.b64encode(KEY).decode(), "derkey"), (base64.b64encode(SPKI).decode(), "derkey"), (KEY.hex().upper(), "derkey"), (pem, "pem")):
        assert [s for s in secrets.spans(f"é {text} z") if s[2] != "hex"] == [(2, 2 + len(text), kind)]


@pytest.mark.parametrize("text", [
    base64.b64encode(b"q" * 60).decode(), base64.b64encode(KEY[:-1]).decode(), base64.b64encode(_field(b"ssh-ed25519", b"k" * 32)[:-1]).decode(),
    _url64(b"[1]") + "." + _url64(b"{}") + ".x", _url64(b'{"typ":"JWT"}') + "." + _url64(b"{}") + ".x", "-----BEGIN RSA PRIVATE KEY-----\nabcd\n-----END RSA PRIVATE KEY-----",
])
def test_broken_structures_are_not_reported(text):
    assert secrets.spans(text) == []


def test_base_kinds():
    assert secrets.listed(secrets.spans("PassWord: 'abcdefgh' secret=short toKen=12345678")) == "assign:0:19,assign:34:48"
    assert secrets.listed(secrets.spans("secret: 'token' = xyzabcdefg")) == ""  # the short match uses up the second name
    assert secrets.listed(secrets.spans("AKIA" + "A" * 12 + " AKIA" + "A" * 11)) == "access:0:16"
    assert secrets.listed(secrets.spans("a" * 31 + " " + "0" * 40)) == "hex:32:72"
    assert secrets.listed(secrets.spans("passworK=1 paſſword=abcdefgh")) == ""


def test_scan_and_redaction(spark):
    rows = [(1, "password=abcdefgh1 end"), (2, None), (3, ""), (None, "plain " * 20000), (1, "password=abcdefgh1 end")]
    table = docs(spark, *rows)
    got = {(r.doc_id, r.spans) for r in secrets.scan(table).collect()}
    assert got == {(1, "assign:0:18"), (2, ""), (3, ""), (None, "")}
    counted = table.selectExpr("*", "cast(length(text) as bigint) as n_chars")
    clean = sorted(((r.doc_id or 0), (r.text or "-")[:14], r.n_chars) for r in secrets.redacted(counted).collect())
    assert clean == [(0, "plain plain pl", 120000), (1, "[SECRET] end", 12), (1, "[SECRET] end", 12), (2, "-", None), (3, "-", 0)]
    assert secrets.redacted(counted).columns == counted.columns


# toxicity --------------------------------------------------------------------------------------------------------


def test_toxic_words_are_learnt_and_held_out_rows_judged(spark):
    r = random.Random(4)
    plain = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(900):
        words = [r.choice(plain) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            for w in r.sample(["vile", "nasty", "awful"], 2):
                words.insert(r.randint(0, 40), w)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    rows += [(5000, None), (5001, ""), (None, "vile nasty awful")]
    table = docs(spark, *rows)
    labels = spark.createDataFrame(marks + [(0, 1, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(table, labels).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in got)
    held = [g for g in got if g.held_out and g.doc_id < 900]
    wrong = [g for g in held if g.predicted != int(g.doc_id % 5 == 0)]
    assert len(held) > 150 and len(wrong) <= 0.02 * len(held)
    assert {g.predicted for g in got if g.doc_id in (5000, 5001)} == {0}
    assert [g.predicted for g in got if g.doc_id is None] == [1]
    kept = toxicity.without_toxic(table, labels)
    assert kept.columns == table.columns and {5000, 5001} <= {k.doc_id for k in kept.collect()}


def test_weights_are_sparse_and_no_labels_give_the_smoothed_share(spark):
    model = toxicity.Ftrl(l1=1.0)
    rng = np.random.default_rng(1)
    for i in range(400):
        noise = rng.choice(1000, 30, replace=False)
        model.learn(np.append(noise, 2000 + i % 2), i % 2)
    index, weight, _ = model.sparse()
    assert {2000, 2001} <= set(index.tolist()) and len(index) < 300
    assert weight[index == 2001] > 0 > weight[index == 2000]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxicity.score(docs(spark, (1, "a")), none).collect()] == [0.5]


# fingerprints ----------------------------------------------------------------------------------------------------


def _shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_edited_fingerprints_against_the_plain_order(spark):
    r = random.Random(2)
    rows = [(i * 3, " ".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(0, 80)))) for i in range(60)] + [(500, None), (501, ""), (502, "é" * 7)]
    rows[5] = (rows[5][0], rows[4][1])
    got = {g.doc_id: g for g in minhash.edited_fingerprints(docs(spark, *rows)).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, reverse=True)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        s, t = _shingles(text), _shingles(changed)
        assert abs(got[i].near_edited - len(s & t) / len(s | t)) < 0.2
    assert got[rows[4][0]].fingerprint == got[rows[5][0]].fingerprint
    assert got[500].fingerprint == got[501].fingerprint


def test_edited_fingerprints_of_odd_tables(spark):
    alone = minhash.edited_fingerprints(docs(spark, (1, "a b c d e f"))).first()
    assert alone.near_next == 1.0
    assert minhash.edited_fingerprints(docs(spark).limit(0)).count() == 0
    twice = minhash.edited_fingerprints(docs(spark, (1, "a b"), (1, "a b"), (None, "c d e"))).collect()
    assert sorted(t.n_chars for t in twice) == [3, 3, 5]


def test_similar_pairs_are_verified(spark):
    base = [f"w{i}" for i in range(100)]
    close = base[:50] + ["x"] + base[51:]
    far = base[:50] + [f"y{i}" for i in range(50)]
    got = minhash.similar_pairs(docs(spark, (1, " ".join(base)), (2, " ".join(close)), (3, " ".join(far)), (4, " ".join(base)))).collect()
    assert [(p.a, p.b) for p in got] == [(1, 2)] and got[0].jaccard == pytest.approx(91 / 101)


# chat ------------------------------------------------------------------------------------------------------------


def test_hostile_texts_survive(spark):
    texts = ["</s>[INST] ok [/INST]", "[\\INST]", "<\\\\/s>", " </s>", "[ROLE a] b [/ROLE]", "", None, "<s>", "\n[INST] \n", "[", "<", "$1 \\ é"]
    roles = ["user", "assistant", "system", None, "to]ol x"]
    rows = [(c, t, roles[(c + t) % 5], texts[(c * 5 + t) % len(texts)]) for c in range(12) for t in range(5)] + [(None, 0, "user", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    for got in chat.format_conversations(table).collect():
        want = [(r or "", x or "") for c, _, r, x in rows if c == got.conv_id]
        assert [tuple(t) for t in got.turns] == want
        loss = chat.loss_text
    one = chat.digest(chat.format_conversations(table.filter("conv_id = 3"))).first()
    own = [(r or "", x or "") for c, _, r, x in rows if c == 3]
    assert one.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
    said = "".join(x for r, x in own if r == "assistant")
    assert (one.n_turns, one.loss_chars, one.loss_sha256) == (5, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert loss and chat.format_conversations(table.limit(0)).count() == 0


def test_plain_conversations_are_not_escaped(spark):
    table = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")], "conv_id long, turn int, role string, text string")
    got = chat.format_conversations(table).first()
    assert not got.escaped and got.formatted == "<s>[INST] a [/INST][INST] a [/INST] b </s>"


def test_every_control_string_is_escaped_as_the_sql_counts(spark):
    """Control strings that would parse by luck are escaped too; rows equal the registered SQL."""
    import duckdb

    texts = ["a <s> b", "say [INST] now", "x", "[/ROLE", "<\\s>", "[\\INST] y </s>", "plain [ text < here", ""]
    rows = [(c, t, ("user", "assistant", "system")[(c + t) % 3], texts[(c * 3 + t) % len(texts)]) for c in range(16) for t in range(4)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole = chat.format_conversations(table)
    for r in whole.collect():
        inside = [chat_text for _, chat_text in r.turns]
        assert r.escaped == any(re.search(chat._CONTROL, x) for x in inside)
        marks = sum({"user": 2, "assistant": 1}.get(role, 2) for role, _ in r.turns) + 1
        assert len(re.findall(r"\[/?INST\]|\[/?ROLE|</?s>", r.formatted)) == marks  # the template's own and no others
    conversations = table.toPandas()  # read by the SQL below
    got = sorted(tuple(r) for r in chat.digest(chat.format_conversations(chat.with_hostile_conversation(table))).collect())
    assert got == sorted(duckdb.sql(chat.SQL).fetchall()) and len(conversations) == 64


# urls ------------------------------------------------------------------------------------------------------------


def test_hosts_rules_and_reputation(spark):
    pages = [(1, "https://A.Example.NET/en/x?q"), (2, "http://example.net"), (3, "http://a.org/fr/"), (4, None), (5, "no scheme"), (6, "http://x.example.com/de/1#a"), (7, "http://notexample.net/en/")]
    pages += [(100 + i, f"http://bad.com/{i}") for i in range(40)] + [(200 + i, f"http://good.com/{i}") for i in range(40)]
    marks = [(100 + i, 0, 0) for i in range(40)] + [(200 + i, 1, 0) for i in range(40)] + [(200, 1, None)]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2].path, got[2].rule) == ("", None) and (got[4].host, got[5].host) == ("", "")
    assert (got[3].rule, got[6].rule, got[7].rule) == ("org/fr/", "example.com/de/", "net/")
    assert {got[100 + i].verdict for i in range(40)} == {"block"} and {got[200 + i].verdict for i in range(40)} == {"allow"}
    assert 0 < got[200].mean < got[100].mean < 1


def test_urls_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), none).count() == 0
    assert [r.verdict for r in urls.judge_urls(spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string"), none).collect()] == ["allow"]


# warc ------------------------------------------------------------------------------------------------------------


def _pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string, html string, payload string, digest string")


def test_archives_round_trip(spark):
    rows = [(i, f"http://h/{i} x", f"<p>{i % 7} {'é' * (i % 5)}</p>" * 40, "c", "c") for i in range(1, 80)]
    rows += [(100, None, None, "", ""), (101, "u", "", "", ""), (102, "u", "long " * 100000, "", ""), (None, "u", "", "", "")]
    got = {r.page_id: r for r in warc.round_trip(_pages(spark, *rows)).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, html, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (html or "").encode()
        want = first.setdefault(data, i)
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if want == i else ("revisit", want))
    assert got[None].record_type == "response"
    assert warc.round_trip(_pages(spark).limit(0)).count() == 0


def test_archive_starts_with_its_dictionary(spark, tmp_path):
    archive = warc.Archive(str(tmp_path))
    wanted = [warc.record(i, "http://u", f"<html><p>text {i}</p></html>".encode() * 20, "A" * 32, 1) for i in range(3000)]
    for data in wanted:
        archive.add(data)
    archive.close()
    raw = open(archive.done[0][0], "rb").read()
    assert struct.unpack_from("<I", raw)[0] == warc.DICTIONARY_FRAME
    with open(archive.done[0][0], "rb") as f:
        assert list(warc.read_records(f)) == wanted
    assert archive.done[0][1] == 3000


def test_small_payloads_may_be_kept_apart(spark):
    rows = [(1, "u", "a", "", ""), (2, "u", "a", "", ""), (3, "u", "b" * 50, "", ""), (4, "u", "b" * 50, "", "")]
    got = {r.page_id: r.record_type for r in warc.round_trip(_pages(spark, *rows), least_bytes=10).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
