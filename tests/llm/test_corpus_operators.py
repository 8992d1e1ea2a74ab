"""Near-duplicates, substring dedup, benchmark search and the pipeline against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from frameline.llm import bpe, decontaminate, omh, secrets, substrings, toxicity
from frameline.llm.queries import TOKENIZER


def docs(spark, *rows):
    full = [(i, t, "x", b"y", 7) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, label string, node binary, key long")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1]


def words(r, n, of=4000):
    return [f"w{r.randrange(of)}" for _ in range(n)]


def edit(r, text, n):
    text = list(text)
    for _ in range(n):
        at = r.randrange(len(text))
        kind = r.random()
        if kind < 0.4:
            text[at] = f"e{r.randrange(10**6)}"
        elif kind < 0.7:
            text.insert(at, f"e{r.randrange(10**6)}")
        else:
            del text[at]
    return text


def test_banded_distance_equals_the_full_table():
    r = random.Random(5)
    for _ in range(1500):
        a = [r.choice("abcdef") for _ in range(r.randint(0, 25))]
        b = edit(r, a, r.randint(0, 6)) if len(a) > 8 else [r.choice("abcdef") for _ in range(r.randint(0, 25))]
        k, d = r.randint(0, 9), distance(a, b)
        assert omh.banded_distance(a, b, k) == (d if d <= k else None)


def test_classes_equal_brute_force(spark):
    r = random.Random(11)
    rows = []
    for g in range(25):
        base = words(r, r.randint(60, 200))
        rows += [base] + [edit(r, base, r.randint(1, len(base) // 20)) for _ in range(g % 6)]
    crowd = words(r, 100)
    rows += [edit(r, crowd, 1 + i % 3) for i in range(40)]  # more than a small bucket
    passage = words(r, 60)
    rows += [words(r, 60) + passage + words(r, 60) for _ in range(40)]  # share a passage, are not alike
    table = [(i, " ".join(t)) for i, t in enumerate(rows)]
    table += [(1000, table[3][1]), (1001, table[3][1]), (1002, None), (1003, ""), (None, "lonely words here"), (1004, "a")]
    got = {d.doc_id: d.class_id for d in omh.near_classes(docs(spark, *table)).collect()}
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            most = max(len(rows[i]), len(rows[j])) // 5
            if abs(len(rows[i]) - len(rows[j])) <= most and len(set(rows[i]) & set(rows[j])) > 20 and omh.alike(" ".join(rows[i]), " ".join(rows[j])):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert [got[i] for i in range(len(rows))] == [root(i) for i in range(len(rows))]
    assert got[1000] == got[1001] == got[3] and got[1002] == got[1003] == 1002 and got[None] is None and got[1004] == 1004


def test_links_of_large_buckets_are_all_found(spark):
    """Texts with one passage, among them groups that are alike: any way through the buckets gives the classes of all their pairs."""
    r = random.Random(3)
    passage = words(r, 70)
    rows = []
    for g in range(60):
        base = words(r, 20) + passage + words(r, 20)
        rows += [base] + [edit(r, base, 10) for _ in range(g % 4)]
    table = docs(spark, *[(i, " ".join(t)) for i, t in enumerate(rows)])
    seats = omh.buckets(omh.sketches(omh.nodes(table))).select("key", "node").collect()
    node = {x.doc_id: x.node for x in omh.nodes(table).collect()}
    at = {n: i for i, n in node.items()}
    by_key = {}
    for x in seats:
        by_key.setdefault(x.key, []).append(at[x.node])
    assert max(map(len, by_key.values())) > 60
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in {(i, j) for held in by_key.values() for i in held for j in held if i < j}:
        if omh.alike(" ".join(rows[i]), " ".join(rows[j])):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    want = {i: root(i) for i in range(len(rows))}
    for small in (0, omh.SMALL):
        assert {x.doc_id: x.class_id for x in omh.near_classes(table, small).collect()} == want


def test_pairs_of_a_shared_passage_do_not_grow_with_the_square(spark):
    made = {}
    for n in (50, 100, 200):
        r = random.Random(n)
        passage = words(r, 300)
        rows = [words(r, 90, 10**6) + passage + words(r, 90, 10**6) for _ in range(n)]
        texts = omh.nodes(docs(spark, *[(i, " ".join(t)) for i, t in enumerate(rows)]))
        seated = omh.buckets(omh.sketches(texts)).withColumn("label", F.col("node"))
        made[n] = omh.hub_pairs(seated, True).count(), omh.prefix_pairs(seated, texts).count()
    assert all(stars <= n and rest <= n for n, (stars, rest) in made.items())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_of_large_buckets_meet_no_join(spark):
    """Words are counted by a window: prefixes join by node alone, and hold the rarest words that two texts have."""
    r = random.Random(8)
    passage = words(r, 40)
    table = docs(spark, *[(i, " ".join(words(r, 8, 10**6) + passage + ["own", "pair"][: i % 2 + 1])) for i in range(12)])
    texts = omh.nodes(table)
    seated = omh.buckets(omh.sketches(texts)).withColumn("label", F.col("node"))
    found = omh.prefixes(seated, texts, 2)
    joins = re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join \[(\w+)#", plan(found))
    assert joins and "word" not in joins
    nodes = {x.node: len(x.text.split()) for x in texts.collect()}
    rows = found.collect()
    assert {x.node for x in rows} == {x.node for x in seated.filter("n > 2").select("node").distinct().collect()}
    for x in rows:  # eight words of its own come first and are left out
        assert x.len == nodes[x.node] and len(x.list) == x.len // 5 + 1 - 8 and x.left == x.len - 8 - x.list.index(x.word)


def test_components_of_chains_stars_and_copies(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(159, 160), (7, 7), (300, 200), (200, 300), (-5, 400)]
    names = {i: r.getrandbits(62) - 2**61 for e in edges for i in e}
    got = omh.components(spark.createDataFrame([(names[a], names[b]) for a, b in edges * 2], "a long, b long")).collect()
    groups = [range(41), range(100, 161), (200, 300), (-5, 400)]
    assert sorted((x.node, x.label) for x in got) == sorted((names[i], min(names[j] for j in g)) for g in groups for i in g)
    step = omh._stars(spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long"))
    assert "Join" not in plan(step) and step.count() <= 2 * len(edges)


def test_texts_of_no_bucket_stay_out_of_the_shuffle(spark):
    r = random.Random(6)
    rows = omh.nodes(docs(spark, *[(i, " ".join(words(r, 12))) for i in range(3000)]))
    asked = rows.filter("doc_id < 100").select("node")
    may_be = omh._marked(asked)
    assert rows.filter("doc_id < 100").filter(may_be("node")).count() == 100
    assert rows.filter(may_be("node")).count() < 130
    assert "BroadcastHashJoin" not in plan(omh.verified(spark.createDataFrame([(1, 2)], "a long, b long"), rows))


def test_one_row_of_each_class_stays(spark):
    base = " ".join(f"w{i}" for i in range(50))
    table = docs(spark, (5, base), (3, base + " x"), (3, base + " x"), (9, None), (8, ""), (None, "q r s"), (None, "q r s"), (2, "b"))
    left = omh.one_of_each(table)
    assert left.columns == table.columns
    assert sorted((x.doc_id or 0, x.text) for x in left.collect()) == [(0, "q r s"), (2, "b"), (3, base + " x"), (8, "")]
    assert omh.one_of_each(table.limit(0)).count() == 0


# substrings ------------------------------------------------------------------------------------------------------


def removed_by_hand(rows, window=13):
    split = [(i, [w for w in re.split("[ \t-\r]+", t or "") if w]) for i, t in rows]
    first = {}
    for i, ws in split:
        for k in range(len(ws) - window + 1):
            key, place = tuple(ws[k : k + window]), 2**63 - 1 if i is None else i
            first[key] = min(first.get(key, place), place)
    out = []
    for i, ws in split:
        gone = set()
        for k in range(len(ws) - window + 1):
            if first[tuple(ws[k : k + window])] < (2**63 - 1 if i is None else i):
                gone |= set(range(k, k + window))
        out.append((i or 0, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("per_bucket", [8_000_000, 300])
def test_repeats_equal_brute_force(spark, per_bucket):
    r = random.Random(8)
    shared = [words(r, n) for n in (12, 13, 14, 20, 40)]
    rows = []
    for i in range(70):
        text = []
        for _ in range(r.randint(0, 4)):
            text += words(r, r.randint(0, 30)) + (r.choice(shared) if r.random() < 0.7 else r.choice(["a", "b"]).split() * r.randint(1, 20))
        rows.append((r.randrange(60), " ".join(text)))
    rows += [(100, rows[0][1]), (100, rows[1][1]), (101, None), (102, ""), (103, "a\x1cb c d " * 9), (104, "a\x1cb c d " * 9), (None, rows[2][1]), (105, " ".join(words(r, 8000)))]
    got = substrings.repeats(docs(spark, *rows).repartition(5), per_bucket=per_bucket).collect()
    assert sorted((g.doc_id or 0, g.n_words, g.n_removed, g.kept) for g in got) == removed_by_hand(rows)
    for g in got:
        assert sum(b - a for a, b in g.spans) == g.n_removed and all(b - a >= 13 for a, b in g.spans)


def test_answers_are_rows_by_part_and_not_by_document_and_bucket(spark):
    r = random.Random(21)
    passage = words(r, 200)
    rows = [(i, " ".join(words(r, 30) + passage)) for i in range(300)]
    table, made = docs(spark, *rows), {}
    for buckets in (1, 64):
        reader, packer = substrings._Reader(13, buckets), substrings._Packer(buckets, substrings.NARROW)
        for i, text in rows:
            rolling, blocks, _, _ = reader.short(text)
            packer.add((i, i), {0: blocks, 1: rolling, 2: blocks})
        packed = spark.createDataFrame(packer.rows(), substrings.PACKED).repartition(1).sortWithinPartitions("bucket", "kind")
        answers = packed.mapInPandas(substrings._meet(substrings.NARROW, 3), substrings.PACKED_ANSWERS)
        made[buckets] = answers.count()
        assert substrings._met(packed, buckets, 3, substrings.NARROW).count() == len(rows)
    assert made == {1: 3, 64: 3}
    twice = substrings.repeats(table.unionByName(table), per_bucket=300, per_part=500)
    assert sorted((g.doc_id, g.n_words, g.n_removed, g.kept) for g in twice.collect()) == removed_by_hand(rows + rows)


def test_no_documents_no_repeats(spark):
    assert substrings.repeats(docs(spark).limit(0)).count() == 0


# benchmark -------------------------------------------------------------------------------------------------------


ITEMS = [
    (1, "Which river crosses the old town of Marn near the stone bridge? The long river Tarn."),
    (2, "Name the metal that melts in a warm hand at noon in July. Gallium."),
    (3, "Alone"), (4, None), (5, ""), (2, "Name the metal that melts in a warm hand at noon in July. Gallium."),
]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("score", F.lit("x"))


@pytest.mark.parametrize("shard", [64_000_000, 40])
def test_items_are_found_anywhere_in_long_texts(spark, shard):
    r = random.Random(6)
    rows = []
    for i in range(40):
        before = words(r, r.randint(0, 300))
        rows.append((i, " ".join(before + (ITEMS[i % 2][1].upper().split() if i % 4 < 2 else []) + words(r, 50))))
    rows += [(100, None), (101, ""), (None, ITEMS[0][1]), (102, "we were alone there"), (103, ITEMS[0][1].split("?")[0]), (0, rows[0][1])]
    got = decontaminate.contaminated(docs(spark, *rows), items(spark), shard_chars=shard).collect()
    want = [(i, i % 2 + 1) for i in range(40) if i % 4 < 2] + [(-1, 1), (102, 3), (0, 1)]
    assert sorted((-1 if g.doc_id is None else g.doc_id, g.item_id) for g in got) == sorted(want)
    clean = decontaminate.without_benchmark(docs(spark, *rows), items(spark))
    assert {c.doc_id for c in clean.collect()} == {i for i, _ in rows} - {0, None, 102} - {i for i in range(40) if i % 4 < 2}


def test_wand_returns_all_above_the_threshold():
    r = random.Random(3)
    n = 120
    lists = []
    for _ in range(40):
        held = sorted(r.sample(range(n), r.randint(1, 90)))
        scores = [r.random() for _ in held]
        tops = [max(scores[i : i + decontaminate.POSTINGS_PER_BLOCK]) for i in range(0, len(scores), decontaminate.POSTINGS_PER_BLOCK)]
        lists.append((held, scores, tops, max(scores)))
    index = decontaminate.Index([], 1, postings=lists)
    for _ in range(200):
        asked, least = sorted(r.sample(range(40), r.randint(1, 30))), r.choice([0.5, 2.0, 5.0, 9.0])
        total = {}
        for t in asked:
            for d, s in zip(*lists[t][:2]):
                total[d] = total.get(d, 0) + s
        assert dict(decontaminate.wand(index, asked, least)) == pytest.approx({d: s for d, s in total.items() if s >= least})


def test_no_items_nothing_found(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs(spark, (1, "a b")), none).count() == 0
    assert decontaminate.without_benchmark(docs(spark, (1, "a b")), none).count() == 1


# pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_equals_its_steps_by_hand(spark, tmp_path):
    """Every stage over a small corpus, each decision taken again by plain code from the stage's own input."""
    folder = "/root/testdata/sf0.001"
    own = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [(b.item_id, b.text) for b in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    at, columns = own, own.columns
    for name, stage in corpus_pipeline.STAGES:
        before = at.collect()
        out = stage(spark, at, folder)
        after = out.collect()
        if name == "toxicity":
            score = {x.doc_id: x.score for x in toxicity.score(at, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
            assert {x.doc_id for x in after} == {i for i, s in score.items() if s < toxicity.THRESHOLD}
        elif name == "near_duplicates":
            kept = {x.doc_id: x.text for x in after}
            for x in before:
                if x.doc_id not in kept:
                    assert any(i < x.doc_id and (t == x.text or omh.alike(t, x.text)) for i, t in kept.items())
            texts = list(kept.values())
            assert not any(omh.alike(s, t) for i, s in enumerate(texts) for t in texts[:i])
        elif name == "benchmark":
            flat = {i: " ".join(re.findall(r"\w+", t.lower())) for i, t in bench if t}
            holds = {x.doc_id for x in before if any(f and f in " ".join(re.findall(r"\w+", x.text.lower())) for f in flat.values())}
            assert {x.doc_id for x in after} == {x.doc_id for x in before} - holds
        elif name == "secrets":
            assert {(x.doc_id, x.text, x.n_chars) for x in after} == {(x.doc_id, secrets.redact(x.text), len(secrets.redact(x.text))) for x in before}
        else:
            model = bpe.WordBpe(open(TOKENIZER, encoding="utf-8").read())
            for x, y in zip(sorted(before, key=lambda x: x.doc_id), sorted(after, key=lambda x: x.doc_id)):
                ids = list(model.encode(x.text))
                assert (y.doc_id, y.n_tokens, y.ids_sha256) == (x.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            break
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, after))


def test_stages_leave_columns_of_any_name(spark):
    """Columns that are called like the helpers of a stage come out as they went in."""
    names = ("_toxicity", "_clean", "_place", "_node", "_Clean_")
    rows = [(i, f"some words of text number {i} that nobody minds", 45, *[f"{n}{i}" for n in names]) for i in range(6)]
    rows += [(6, rows[0][1], 45, *["copy"] * 5), (7, "password = hunter2hunter2 and more", 34, *["s"] * 5), (None, None, None, *[None] * 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, " + ", ".join(f"`{n}` string" for n in names))
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")
    given = {r.doc_id: tuple(r)[3:] for r in table.collect()}
    for stage in (lambda d: toxicity.without_toxic(d, marks), omh.one_of_each, secrets.redacted):
        out = stage(table)
        assert out.columns == table.columns and out.dtypes == table.dtypes
        found = out.collect()
        assert found and all(tuple(r)[3:] == given[r.doc_id] for r in found)
    assert "hunter2" not in "".join(r.text or "" for r in secrets.redacted(table).collect())
