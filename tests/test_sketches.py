from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from agoralens.operators import sketches


def exact(keys, n):
    return sorted(Counter(k for k in keys if k is not None).items(), key=lambda x: (-x[1], x[0]))[:n]


def keys_of(kind):
    rng = np.random.default_rng(1)
    if kind == "skewed":
        return [f"k{int(x):05}" for x in rng.zipf(1.4, 30_000) if x < 40_000]
    if kind == "one key":
        return ["hot"] * 5000 + [None] * 500
    if kind == "all alike":
        return [f"k{i % 6000:05}" for i in range(30_000)]  # no counter can tell them apart
    return [f"k{int(i):02}" for i in rng.integers(0, 30, 3000)]


@pytest.mark.parametrize("counters", [40, 300])
@pytest.mark.parametrize("kind", ["skewed", "one key", "all alike", "few"])
def test_most_frequent_is_exact(spark, kind, counters):
    keys = keys_of(kind)
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(6)
    got = [tuple(r) for r in sketches.most_frequent(df, "key", 10, counters).collect()]
    assert got == exact(keys, 10)


def test_numbers_stay_numbers(spark):
    df = spark.range(2000).selectExpr("id % 700 AS k")
    assert [tuple(r) for r in sketches.most_frequent(df, "k", 3).collect()] == [(0, 3), (1, 3), (2, 3)]
    assert sketches.most_frequent(df.limit(0), "k", 3).count() == 0


def test_candidates_are_counted_without_the_others(spark):
    keys = keys_of("skewed")
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(6)
    plan = sketches.most_frequent(df, "key", 10, 300)._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    whole = sketches.most_frequent(spark.createDataFrame([(k,) for k in keys_of("all alike")], "key string"), "key", 10, 40)
    assert "LeftSemi" not in whole._jdf.queryExecution().toString()


def test_bounds_hold_every_count(spark):
    keys = keys_of("skewed")
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(6)
    rows = {r["key"]: r for r in sketches.key_bounds(df, "key", 100).collect()}
    error, count = rows.pop(None)["error"], Counter(keys)
    assert 0 < error and len(rows) <= 600
    for k, n in count.items():
        low = rows[k]["low"] if k in rows else 0
        assert low <= n <= low + error


def test_counters_take_the_same_off_all():
    counts, off = sketches.reduced(Counter({"a": 9, "b": 4, "c": 4, "d": 1}), 2)
    assert (dict(counts), off) == ({"a": 5}, 4)
    assert sketches.reduced(Counter("ab"), 2) == (Counter("ab"), 0)


def test_stored_sketches_join(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("day"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("u"), F.col("id") % 20_000)).alias("user")
    )
    sketches.distinct_sketches(df, "day", "user").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    whole = df.select(F.count_distinct("user")).first()[0]
    assert abs(sketches.distinct_estimate(stored).first()[0] - whole) <= 0.05 * whole
    exact_by = {r["day"]: r["n"] for r in df.groupBy("day").agg(F.count_distinct("user").alias("n")).collect()}
    for r in sketches.distinct_estimate(stored, "day").collect():
        assert abs(r["distinct"] - exact_by[r["day"]]) <= 0.05 * exact_by[r["day"]]
