"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from frameline.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def counts(rows, shortest, fewest, every):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= fewest}


def plain(rows, shortest=5, fewest=3, every=0):
    n = counts(rows, shortest, fewest, every)
    form, out = {}, []
    for w in n:
        others = [x for x in n if near(w, x)]
        top = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = top if top is not None and n[top] >= 2 * n[w] else None
        out.append([w, form[w], None, n[w], len(others), n[form[w]] if form[w] else None])
    for row in out:
        row[2] = row[0]
        while form[row[2]]:
            row[2] = form[row[2]]
    return sorted(map(tuple, out), key=str)


def got(spark, rows, **options):
    return sorted((tuple(r) for r in spelling.variants(docs(spark, *rows), **options).collect()), key=str)


@pytest.mark.parametrize("every", [0, 7])
def test_equals_all_pairs(spark, every):
    r = random.Random(every)
    stems = ["".join(r.choice("abeé") for _ in range(r.randint(3, 8))) for _ in range(60)] + ["straße", "Überzug", "naïveté"]
    rows = []
    for i in range(150):
        words = []
        for _ in range(r.randint(0, 60)):
            w = list(r.choice(stems))
            if r.random() < 0.4:
                at = r.randrange(len(w))
                w[at : at + r.randint(0, 1)] = r.choice(["", "a", "E", "ß", "×"])
            words.append("".join(w).upper() if r.random() < 0.1 else "".join(w))
        rows.append((i if i % 10 else None, " -1,\n".join(words)))
    want = plain(rows, every=every)
    assert got(spark, rows, every=every) == want
    assert sum(x[1] is not None for x in want) > 30 and max(x[4] for x in want) > 3


def test_chain_of_forms_ends_at_one_root(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc", "bbbcc", "bbccc"]
    rows = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k)))]
    result = got(spark, rows)
    assert result == plain(rows)
    assert {r[2] for r in result} == {"bbccc"}


def test_ties_take_the_smallest(spark):
    rows = [(1, "worda " * 3 + "wordé " * 6 + "wordc " * 6 + "word " * 9)]
    result = {r[0]: r for r in got(spark, rows)}
    assert result["worda"] == ("worda", "wordc", "wordc", 3, 2, 6)
    assert result["wordc"][1] is None and result["wordc"][4] == 2  # a tie in counts is not twice the count


def test_each_pair_is_given_once(spark):
    r = random.Random(4)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(5, 7))) for _ in range(500)})
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = [(x.a, x.b) for x in spelling.near_pairs(table).collect()]
    want = {(a, b) for a in words for b in words if near(a, b) and (len(a), a) < (len(b), b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 500


def test_nulls_empty_long_and_repeated(spark):
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "hello " * 40000), (5, "hellos hellos"), (5, "hellos hellos"), (None, "Hello")]
    assert got(spark, rows) == plain(rows) == sorted([("hello", None, "hello", 40001, 1, None), ("hellos", "hello", "hello", 4, 1, 40001)], key=str)
    assert got(spark, []) == []
    assert got(spark, [(1, "once")]) == []
