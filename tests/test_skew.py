"""The skew-proof building blocks against brute force, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from frameline.functions.sizing import int_div
from frameline.operators.skew import expand_range, hot_keys, ranked_in_group, salted_join, small_enough, with_neighbours


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    hot = [("hot", n) for n in rng.sample(range(5000), 900)]
    return hot + [(f"k{rng.randrange(40)}", n) for n in rng.sample(range(5000), 300)] + [(None, 5), (None, 900)]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, rows, how, threshold, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    big = spark.createDataFrame(rows, "k string, n int")
    small = spark.sql("SELECT * FROM VALUES ('hot', 1), ('k1', 2), ('k2', 3) AS t(k, v)")
    plain, salted = big.join(small, "k", how), salted_join(big, small, ["k"], how)
    assert ("_salt" in salted._jdf.queryExecution().analyzed().toString()) == (threshold == "-1")
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_only_the_hot_key_is_salted(spark, request):
    """One key with a third of the rows among a million others: the sketch names it alone and only it is repeated."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    big = spark.range(1_500_000, numPartitions=4).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 1 THEN NULL ELSE 'c' || id END AS k", "id")
    assert [r._key for r in hot_keys(big, ["k"]).collect()] == ["hot"]
    assert hot_keys(big.filter("k <> 'hot'"), ["k"]).count() == 0 and hot_keys(big.limit(0), ["k"]).count() == 0
    pairs = big.selectExpr("k", "CASE WHEN k = 'hot' THEN 7 ELSE id END AS j")
    assert [r._key for r in hot_keys(pairs, ["k", "j"]).collect()] == ["hot\x1f7"]
    known = spark.createDataFrame([("hot", 7), ("c4", 4), ("c4", 5)], "k string, j long")
    assert salted_join(pairs, known, ["k", "j"], "left_semi").count() == 500_001
    small = spark.range(200_000).selectExpr("'c' || id AS k").union(spark.createDataFrame([("hot",), (None,)], "k string"))
    joined = salted_join(big, small, ["k"], "left_anti")
    assert joined.count() == big.join(small, "k", "left_anti").count()
    whole = salted_join(big, small, ["k"])
    assert whole.count() == big.join(small, "k").count() and whole.columns == ["k", "id"]


def test_small_sides_are_measured(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    rows = spark.range(100).selectExpr("repeat('x', 84) AS k", "array('ab') AS a")  # 100 bytes a row, and the array
    for threshold, fits in (("10k", False), ("13KB", True), ("20000", True), ("-1", False), ("1m", True)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert small_enough(rows) == fits
    assert small_enough(rows.limit(0))


def test_salted_join_refuses_to_repeat_the_right_side(spark, rows):
    big = spark.createDataFrame(rows, "k string, n int")
    with pytest.raises(ValueError):
        salted_join(big, big, ["k"], "full")


@pytest.mark.parametrize("hot_rows", [0, 100, 10**6])
def test_rank_and_neighbours(spark, rows, hot_rows):
    df = spark.createDataFrame(rows, "k string, n int").withColumn("n", F.col("n").cast("long"))
    chunk = int_div(F.col("n"), 64)
    ranked = {(r.k, r.n): r["rank"] for r in ranked_in_group(df, ["k"], ["n"], chunk, hot_rows=hot_rows).collect()}
    linked = {(r.k, r.n): (r.prev and r.prev.n, r.next and r.next.n) for r in with_neighbours(df, ["k"], ["n"], chunk, ["n"], hot_rows).collect()}
    assert len(ranked) == len(linked) == len(set(rows))
    for k in {k for k, _ in rows}:
        numbers = sorted(n for key, n in rows if key == k)
        for i, n in enumerate(numbers):
            assert ranked[(k, n)] == i + 1
            assert linked[(k, n)] == (numbers[i - 1] if i else None, numbers[i + 1] if i + 1 < len(numbers) else None)


def test_large_groups_are_not_shuffled_whole(spark, request):
    """The table of large groups is broadcast, so no task gets all rows of a group to learn that it is large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(1000).selectExpr("id * 3 % 1000 AS n", "IF(id < 0, 'cold', 'hot') AS k")
    ranked = ranked_in_group(df, ["k"], ["n"], int_div(F.col("n"), 100), hot_rows=100)
    plan = ranked._jdf.queryExecution().executedPlan().toString().splitlines()
    assert {r.n: r["rank"] for r in ranked.collect()} == {n: n + 1 for n in range(1000)}
    assert any("BroadcastHashJoin [coalesce(k#" in line for line in plan)
    assert not any("Exchange hashpartitioning(coalesce(k#" in line and "_chunk" not in line for line in plan)


def test_semi_and_anti_join_share_their_shuffles(spark, request):
    """The sketch, the semi join and the anti join of one aggregated table shuffle it once; null keys match nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = spark.range(4000).selectExpr("CASE WHEN id % 7 > 0 THEN id % 100 END AS k", "id % 5000 AS n").groupBy("n").agg(F.max("k").alias("k"), F.max("n").alias("m"))
    known = spark.createDataFrame([(i,) for i in (*range(30), None)], "k long")
    both = salted_join(big, known.filter("k < 10 OR k IS NULL"), ["k"], "left_semi").unionByName(salted_join(big, known, ["k"], "left_anti"))
    got = both.collect()
    assert len(got) == len({r.n for r in got}) and {r.k for r in got} == {None, *range(10), *range(30, 100)} and both.columns == ["k", "n", "m"]
    assert sum(r.k is None for r in got) == sum(n % 7 == 0 for n in range(4000)) and all(r.m == r.n for r in got)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.enabled", "true"))
    again = salted_join(big, known.filter("k < 10 OR k IS NULL"), ["k"], "left_semi").unionByName(salted_join(big, known, ["k"], "left_anti"))
    plan = again._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("- Exchange hashpartitioning(n#" in line for line in plan) == 1
    assert any("ReusedExchange" in line and "Exchange hashpartitioning(_place#" in line for line in plan)


def test_rank_without_group(spark):
    df = spark.range(1000).withColumn("n", F.col("id") * 3 % 1000)
    got = {r.n: r["rank"] for r in ranked_in_group(df, [], ["n"], int_div(F.col("n"), 100)).collect()}
    assert got == {n: n + 1 for n in range(1000)}


def test_expand_range_long_short_and_empty(spark):
    df = spark.createDataFrame([("a", 10_000), ("b", 1), ("c", 0), ("d", 4096)], "k string, total long")
    got = expand_range(df, F.lit(1), F.col("total"), "n", ["k"]).groupBy("k").agg(F.count("n"), F.min("n"), F.max("n"), F.count_distinct("n"))
    assert {tuple(r) for r in got.collect()} == {("a", 10_000, 1, 10_000, 10_000), ("b", 1, 1, 1, 1), ("d", 4096, 1, 4096, 4096)}


def test_no_salt_replaces_a_plan_without_pairs(spark, rows, request):
    """Large sides are shuffled by key and salt, never compared pair by pair."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = spark.createDataFrame(rows, "k string, n int")
    plan = salted_join(big, big.select("k").distinct(), ["k"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
