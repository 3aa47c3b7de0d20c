import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agoralens.operators import profile, quantiles
from agoralens.operators.clean import clean_tables
from agoralens.operators.quantiles import ACCURACY, exact_quantiles


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_counts_leave_nulls_out_and_break_ties_by_value(spark):
    df = frame(spark, [("b",), ("a",), (None,), ("b",), ("a",), ("c",)], "type string")
    assert [tuple(r) for r in profile.value_counts(df, "type").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    shares = [r["percent"] for r in profile.value_shares(df, "type").collect()]
    assert shares == pytest.approx([40, 40, 20])
    one = profile.imbalance(df, "type").first()
    assert (one["most_common"], one["least_common"], one["ratio"]) == ("a", "c", 2.0)


def test_nulls_and_duplicates_match_pandas(spark):
    rows = [("1", "x"), ("1", "x"), (None, ""), (None, ""), ("2", None), ("2", ""), ("1:1", "x")]
    df = frame(spark, rows, "id string, text string")
    pdf = pd.DataFrame(rows, columns=["id", "text"])
    assert profile.duplicate_rows(df).first()[0] == pdf.duplicated().sum()
    assert profile.duplicate_keys(df, "id").first()[0] == pdf["id"].duplicated().sum()
    assert {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()} == {"id": 2, "text": 1, None: 3}
    assert profile.distinct_count(df, "id").first()[0] == pdf["id"].nunique()
    assert profile.distinct_values(df, "id").count() == len(pdf["id"].unique())


def test_tables_without_rows(spark):
    df = frame(spark, [], "id string, text string, topic_id string, n int, s double")
    assert profile.duplicate_rows(df).first()[0] == 0
    assert profile.value_counts(df, "id").count() == 0
    assert profile.describe(df, "n", "s").filter("count = 0").count() == 2
    assert profile.histogram(df, "n", 5).agg({"count": "sum"}).first()[0] == 0


def test_key_consistency_treats_null_as_a_value(spark):
    t = frame(spark, [("a",), ("b",), (None,)], "topic_id string")
    o = frame(spark, [("a",), ("c",), (None,), ("a",)], "topic_id string")
    c = frame(spark, [("a",)], "topic_id string")
    got = {r["check"]: r["value"] for r in profile.key_consistency(t, o, c).collect()}
    assert got == {
        "topics": 3,
        "opinions": 3,
        "conclusions": 1,
        "orphaned_opinions": 1,
        "topics_without_opinions": 1,
    }


@pytest.mark.parametrize(
    "values, bins",
    [
        (list(range(101)), 10),
        ([0.1 * i for i in range(31)], 30),
        ([3.0, 3.0, 3.0], 7),
        ([1.5], 4),
        ([0.15, 0.3, 0.45, 0.6, 0.15000000000000002], 3),
        ([-2, 5, 5, 9, 1000], 50),
    ],
)
def test_histogram_matches_numpy(spark, values, bins):
    df = frame(spark, [(float(v),) for v in values] + [(None,)], "v double")
    rows = profile.histogram(df, "v", bins).collect()
    counts, edges = np.histogram(values, bins)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["lower"] for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r["upper"] for r in rows] == pytest.approx(edges[1:].tolist())


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"n": rng.integers(0, 50, 500), "s": rng.normal(size=500)})
    df = spark.createDataFrame(pdf)
    for r in profile.describe(df, "n", "s").collect():
        d = pdf[r["column"]].describe()
        got = [r[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(d.tolist())


@pytest.mark.parametrize("kind", ["even", "one value holds a third", "few values"])
def test_exact_quantiles_beyond_the_small_group_size(spark, kind):
    rng = np.random.default_rng(2)
    v = rng.normal(size=ACCURACY * 4 + 7)
    if kind == "one value holds a third":
        v[: len(v) // 3] = 0.25
    if kind == "few values":
        v = np.round(v, 1)
    flag = rng.random(len(v)) < 0.9
    df = spark.createDataFrame(pd.DataFrame({"v": v, "flag": flag}))
    shares = (0.0, 0.25, 0.5, 0.75, 1.0)
    for r in exact_quantiles(df, "v", shares, "flag").collect():
        assert r["quantile"] == pytest.approx(np.quantile(v[flag == r["flag"]], r["share"]), abs=1e-12)


def test_cleaning_keeps_long_opinions_of_long_topics(spark):
    topics = frame(
        spark,
        [("1", "a", "long enough", "t"), ("2", "b", "short", "t"), ("3", None, "no topic id", "t"), ("4", "d", None, "t")],
        "id string, topic_id string, text string, type string",
    )
    opinions = frame(
        spark,
        [
            (1, "a", "1234567890"),
            (2, "a", "123456789"),
            (3, "b", "long enough"),
            (4, None, "long enough"),
            (5, "zz", "long enough"),
            (6, "a", None),
        ],
        "opinion_id int, topic_id string, text string",
    )
    conclusions = frame(spark, [("a", "x", "c")], "topic_id string, text string, type string")
    clean = clean_tables(topics, conclusions, opinions)
    assert sorted(r["id"] for r in clean.topics.collect()) == ["1", "3"]
    assert sorted(r["opinion_id"] for r in clean.opinions.collect()) == [1, 4]
    assert clean.conclusions.first()["text_length"] == 1


def test_pivot_keeps_the_order_of_the_largest_topics(spark):
    rows = [("a", "x")] * 2 + [("b", "x"), ("b", "y"), ("b", "y"), ("c", "y"), (None, "x"), ("c", None)]
    df = frame(spark, rows, "topic_id string, type string")
    got = [tuple(r) for r in profile.top_type_by_topic(df, ("x", "y"), 2).collect()]
    assert got == [("b", 1, 2, 3), ("a", 2, 0, 2)]


def test_duplicates_keep_microseconds_and_fold_zeros_and_nan(spark):
    sql = """SELECT * FROM VALUES
      (timestamp'2024-01-01 00:00:00.000001', 0.0D, array(0.0D), x'00'),
      (timestamp'2024-01-01 00:00:00.000002', 0.0D, array(0.0D), x'00'),
      (timestamp'2024-01-01 00:00:00.000001', -0.0D, array(-0.0D), x'00'),
      (timestamp'2024-01-01 00:00:00.000001', double('nan'), array(double('nan')), x'00'),
      (timestamp'2024-01-01 00:00:00.000001', double('nan'), array(double('nan')), x'00'),
      (timestamp'2024-01-01 00:00:00.000001', double('nan'), array(double('nan')), x'01'),
      (null, null, null, null), (null, null, null, null) AS t(at, x, xs, b)"""
    df = spark.sql(sql)
    assert profile.duplicate_rows(df).first()[0] == df.count() - df.distinct().count() == 3
    ntz = df.selectExpr("cast(at AS timestamp_ntz) AS at", "struct(x, at) AS s")
    assert profile.duplicate_rows(ntz).first()[0] == ntz.count() - ntz.distinct().count()


@pytest.mark.parametrize("listed", [3, 50])
def test_quantiles_of_several_columns_take_many_passes(spark, monkeypatch, listed):
    """Brackets that must be narrowed again and again, with ties, infinities and nulls."""
    monkeypatch.setattr(quantiles, "LISTED", listed)
    rng = np.random.default_rng(3)
    n = 30_000
    x = rng.normal(size=n) ** 3
    y = np.where(rng.random(n) < 0.5, 7.0, rng.integers(0, 1000, n).astype(float))
    z = np.where(rng.random(n) < 0.001, np.inf, rng.random(n))
    flag = rng.integers(0, 3, n)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "z": z, "flag": flag}))
    df = df.withColumns({"y": F.when(F.col("x") > -1, F.col("y")), "nothing": F.lit(None).cast("int")})
    passes = []
    scan = quantiles._pass
    monkeypatch.setattr(quantiles, "_pass", lambda *a: passes.append(1) or scan(*a))
    shares = (0.0, 0.001, 0.25, 0.5, 0.77, 1.0)
    found, _ = quantiles.selected_quantiles(df, ("x", "y", "z", "nothing"), shares, "flag")
    assert len(found) == 3 * 3 * 6 and 2 <= len(passes) <= 8
    for (g, c, s), q in found.items():
        v = {"x": x, "y": y, "z": z}[c][(flag == g) & ((x > -1) | (c != "y"))]
        v = np.sort(v)
        at = s * (len(v) - 1)
        a, b = v[int(np.floor(at))], v[int(np.ceil(at))]
        assert q == pytest.approx(a if a == b else a + (b - a) * (at - np.floor(at)), abs=1e-12), (g, c, s)


def test_quantiles_without_a_window(spark, monkeypatch):
    df = spark.range(40_000).selectExpr("id * 7 % 1000 AS v", "id % 2 = 0 AS flag")
    plans = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda d: plans.append(d._jdf.queryExecution().toString()) or collect(d))
    assert len(exact_quantiles(df, "v", (0.5,), "flag").collect()) == 2
    assert len(plans) >= 3 and not any("Window" in p or "Sort " in p.split("Physical Plan")[-1] for p in plans)
