import random

import pytest
from pyspark.sql import functions as F

from arrears_mart.operators import unique
from arrears_mart.operators.lookups import lookup_join, measured_bytes


def rows(seed, n=400):
    rng = random.Random(seed)
    # One key holds a third of the rows, and many rows are copies of each other.
    key = lambda: "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
    return [(key(), rng.choice([None, 1, 2, 3]), rng.choice("ab"), rng.choice([None, "z1", "z2"])) for _ in range(n)]


def frame(spark, data, parts=6):
    return spark.createDataFrame(data, "k string, o int, c string, z string").repartition(parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_row_does_not_depend_on_row_order(spark, seed):
    data = rows(seed)
    best = {}
    low = (False, 0)
    for k, o, c, z in data:
        rank = tuple((v is not None, v) if v is not None else low[:1] + (type(v or "")(),) for v in (o,)) + (c, (z is not None, z or ""))
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, o, c, z))
    expected = sorted(row for _, row in best.values())
    for parts in (1, 7):
        random.Random(seed + parts).shuffle(data)
        found = unique.latest_per_key(frame(spark, data, parts), ["k"], ["o"])
        assert sorted(map(tuple, found.collect())) == expected


def test_arrival_order_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 5, "late"), ("a", 1, 2, "early"), ("a", 0, 1, "old")], "k string, o int, n int, v string")
    assert unique.latest_per_key(df, ["k"], ["o"], ["v"], "n").first().v == "early"
    assert unique.first_per_key(df, ["k"], ["v"], "n").first().v == "old"


@pytest.mark.parametrize("copies_per_task", [100_000, 10, 1])
def test_discarded_rows_are_all_rows_but_the_kept_ones(spark, monkeypatch, copies_per_task):
    monkeypatch.setattr(unique, "_COPIES_PER_TASK", copies_per_task)
    data = rows(3)
    df = frame(spark, data)
    kept = unique.latest_per_key(df, ["k"], ["o"])
    expected = [(k, c, z) for k, _, c, z in data]
    for row in kept.collect():
        expected.remove((row.k, row.c, row.z))
    by_text = lambda r: tuple(map(str, r))
    for found in (unique.discarded_rows(df, kept, ["k", "c", "z"]), unique.rows_not_latest(df, ["k"], ["k", "c", "z"], ["o"])):
        assert sorted(map(tuple, found.collect()), key=by_text) == sorted(expected, key=by_text)


def test_discarded_rows_read_their_table_once(spark, tmp_path):
    frame(spark, rows(3)).write.parquet(str(tmp_path / "t"))
    found = unique.rows_not_latest(spark.read.parquet(str(tmp_path / "t")), ["k"], ["k", "c", "z"], ["o"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 1


def test_copies_of_a_hot_row_are_spread(spark, monkeypatch):
    monkeypatch.setattr(unique, "_COPIES_PER_TASK", 100)
    df = spark.createDataFrame([("hot", 10_000), ("cold", 3)], "k string, n bigint")
    repeated = unique.repeat_rows(df, "n")
    assert {r.k: r["count"] for r in repeated.groupBy("k").count().collect()} == {"hot": 10_000, "cold": 3}
    tasks = repeated.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1


def test_lookup_is_the_same_broadcast_or_salted(spark):
    left = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 != 0, F.concat(F.lit("z"), F.col("id") % 7)).alias("z"),
        F.col("id"),
    )
    lookup = spark.createDataFrame([("hot", 1), ("z1", 2), ("z2", 3), (None, 4)], "z string, v int")
    small, large = (lookup_join(left, lookup, "z", "id", limit) for limit in (10**6, 0))
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert small.count() == 500
    assert measured_bytes(lookup) == 3 + 2 + 2 + 4 + 8 * 8


def test_unread_lookup_join_is_dropped(spark):
    left = spark.range(10).select(F.col("id").cast("string").alias("k"))
    right = unique.first_per_key(frame(spark, rows(4)), ["k"])
    plan = left.join(right, "k", "left").select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
