import pytest
from pyspark.sql import functions as F

from agoralens import schemas
from agoralens.operators.encode import TfIdfEncoder
from agoralens.sources import tables
from agoralens.sources.vector_buckets import merge_buckets, read_buckets
from agoralens.sources.vector_table import merge_vectors, vector_table, write_vectors

ROWS = [
    ("1", "007ACE74B050", 'It says, "not easy",\nto tell', "Position"),
    ("2", "12E5", "plain  ", "Position"),
    ("3", None, "émoji 😀, comma", None),
]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_come_back_as_they_were_written(spark, tmp_path, fmt):
    df = spark.createDataFrame(ROWS, schemas.TOPICS)
    tables.write_table(df, f"{tmp_path}/topics.{fmt}")
    back = tables.load_topics(spark, str(tmp_path), fmt=fmt)
    assert back.schema == schemas.TOPICS
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_all_tables_by_name(spark, tmp_path):
    for name, (schema, clean) in tables.TABLES.items():
        for s, suffix in ((schema, ""), (clean, "_clean")):
            tables.write_table(spark.createDataFrame([], s), f"{tmp_path}/{name}{suffix}.parquet")
    got = tables.load_all(spark, str(tmp_path))
    assert got._fields == ("topics", "conclusions", "opinions")
    assert got.opinions.schema == schemas.OPINIONS and got.conclusions.schema == schemas.CONCLUSIONS
    assert tables.load_all(spark, str(tmp_path), clean=True).topics.schema == schemas.TOPICS_CLEAN


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="effectiveness"):
        tables.conform(spark.createDataFrame([], schemas.TOPICS).withColumn("opinion_id", F.lit("")), schemas.OPINIONS)


def test_csv_needs_a_schema(spark):
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.csv")


def test_spread_leaves_large_tables_alone(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert tables.spread_small(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    spark.range(1000).repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{path}s")
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")
        df = spark.read.parquet(f"{path}s")
        assert tables.spread_small(df) is df
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_vectors_with_payload_and_merge(spark, tmp_path):
    topics = spark.createDataFrame([("1", "a", "cats"), ("2", "a", "dogs")], "id string, topic_id string, text string")
    extra = spark.createDataFrame([("2", {"topic_text": "changed", "lang": "en"})], "point_id string, extra map<string,string>")
    encoder = TfIdfEncoder.fit(topics, dim=64)
    path = str(tmp_path / "v")
    write_vectors(vector_table(topics, encoder, extra), path)
    got = {r["point_id"]: r for r in spark.read.parquet(path).collect()}
    assert got["1"]["payload"] == {"topic_id": "a", "topic_text": "cats"}
    assert got["2"]["payload"] == {"topic_id": "a", "topic_text": "changed", "lang": "en"}
    new = spark.createDataFrame([("2", "b", "birds"), ("3", "c", "cows")], "id string, topic_id string, text string")
    twice = vector_table(new.union(new.filter("id = '3'").selectExpr("id", "topic_id", "'bees'")), encoder)
    merged = merge_vectors(twice, path)
    got = {r["point_id"]: r["topic_text"] for r in spark.read.parquet(merged).collect()}
    assert got == {"1": "cats", "2": "birds", "3": "cows"} and spark.read.parquet(merged).count() == 3
    assert spark.read.parquet(path).count() == 2
    write_vectors(vector_table(new, encoder), path)
    assert spark.read.parquet(path).count() == 2


def points_of(spark, rows):
    ddl = "point_id string, topic_id string, topic_text string, vector array<double>, payload map<string,string>"
    return spark.createDataFrame([(p, "t", text, [1.0, 2.0], {"k": text}) for p, text in rows], ddl)


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_merge_writes_only_the_buckets_it_changes(spark, tmp_path):
    path = str(tmp_path / "v")
    assert merge_buckets(points_of(spark, [(f"p{i}", "old") for i in range(400)]), path, buckets=16) == 1
    before = files(tmp_path / "v" / "data")
    assert len(before) == 16
    assert merge_buckets(points_of(spark, [("p7", "new"), ("p7", "newer"), ("q", "added")]), path) == 2
    after = files(tmp_path / "v" / "data")
    assert before.items() <= after.items() and 1 <= len(after) - len(before) <= 2
    got = {r["point_id"]: r for r in read_buckets(spark, path).collect()}
    assert len(got) == 401 and (got["p7"]["topic_text"], got["q"]["topic_text"], got["p8"]["topic_text"]) == ("newer", "added", "old")
    assert got["p7"]["payload"] == {"k": "newer"} and got["p7"]["vector"] == [1.0, 2.0]
    asked = spark.createDataFrame([("p7",), ("q",), ("none",)], "point_id string")
    assert sorted(r["point_id"] for r in read_buckets(spark, path, asked).collect()) == ["p7", "q"]
    assert merge_buckets(points_of(spark, []), path) == 2


def test_a_broken_merge_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "v")
    merge_buckets(points_of(spark, [(f"p{i}", "old") for i in range(40)]), path, buckets=4)
    fails = F.udf(lambda text: 1 / 0, "string")
    broken = points_of(spark, [(f"p{i}", "new") for i in range(40)]).withColumn("topic_text", fails("topic_text"))
    with pytest.raises(Exception, match="division by zero"):
        merge_buckets(broken, path)
    # Data without a manifest row is not read either.
    points_of(spark, [("p1", "stray")]).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/data/stray")
    rows = read_buckets(spark, path).collect()
    assert len(rows) == 40 and {r["topic_text"] for r in rows} == {"old"}
    with pytest.raises(ValueError, match="no vector table"):
        read_buckets(spark, str(tmp_path / "nothing"))
