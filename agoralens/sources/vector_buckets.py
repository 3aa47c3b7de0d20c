"""The vector table in hash buckets: a merge writes the buckets that it changes and no others.

``<path>/data`` holds folders of buckets, ``<path>/manifest`` rows of (version, bucket, folder); the row
with the highest version says where a bucket is. A merge first writes the new state of its buckets
into a folder of its own. Then one appended manifest file puts all of them in force at once, so a
merge that breaks off leaves the table as it was. One writer at a time.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens.sources.vector_table import upsert

BUCKETS = 256
MANIFEST = "version long, bucket int, folder string, buckets int"


def _manifest(spark: SparkSession, path: str):
    """Version and number of buckets of the table, and the folder of each bucket that has rows."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
        found = rows.groupBy("bucket").agg(
            F.max("version").alias("version"), F.max_by("folder", "version").alias("folder"), F.max("buckets").alias("n")
        )
        found = found.collect()  # one row for each bucket
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    version = max((r["version"] for r in found), default=0)
    return version, max((r["n"] for r in found), default=0), {r["bucket"]: r["folder"] for r in found}


def _read(spark, path, folders, schema):
    paths = [f"{path}/data/{folder}/bucket={b}" for b, folder in sorted(folders.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _schema(spark, path, folders):
    folder = next(iter(folders.values()))
    return T.StructType([f for f in spark.read.parquet(f"{path}/data/{folder}").schema if f.name != "bucket"])


def read_buckets(spark: SparkSession, path: str, points: DataFrame | None = None) -> DataFrame:
    """The rows of the table; with ``points``, only those of its ``point_id`` values, from their buckets."""
    path = path.rstrip("/")
    _, count, folders = _manifest(spark, path)
    if not folders:
        raise ValueError(f"no vector table at {path}")
    schema = _schema(spark, path, folders)
    if points is None:
        return _read(spark, path, folders, schema)
    asked = points.select("point_id").distinct()
    wanted = {r["b"] for r in asked.select(_bucket(count).alias("b")).distinct().collect()}
    return _read(spark, path, {b: f for b, f in folders.items() if b in wanted}, schema).join(asked, "point_id", "left_semi")


def _bucket(count):
    return F.pmod(F.xxhash64("point_id"), F.lit(count)).cast("int")


def merge_buckets(df: DataFrame, path: str, buckets=BUCKETS) -> int:
    """Put the points of ``df`` into the table at ``path``, in place of those of the same id.

    The first merge makes the table and its number of buckets. Returns the new version.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version, count, folders = _manifest(spark, path)
    count = count or buckets
    touched = {r["b"] for r in df.select(_bucket(count).alias("b")).distinct().collect()}  # ``count`` at most
    if not touched:
        return version
    schema = _schema(spark, path, folders) if folders else df.schema
    before = _read(spark, path, {b: f for b, f in folders.items() if b in touched}, schema)
    merged = upsert(before, df.select(schema.names)).withColumn("bucket", _bucket(count))
    folder = uuid.uuid4().hex
    merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/data/{folder}")
    rows = [(version + 1, b, folder, count) for b in sorted(touched)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version + 1
