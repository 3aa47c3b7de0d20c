"""The table of topic vectors that opinions are matched against.

Columns: ``point_id`` (unique), ``topic_id`` (may repeat), ``topic_text``, ``vector``,
``payload`` (a map of texts).
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ("point_id", "topic_id", "topic_text", "vector", "payload")


def vector_table(
    topics: DataFrame,
    encode,
    metadata: DataFrame | None = None,
    id_col="id",
) -> DataFrame:
    """Encode topic texts into the vector table.

    ``encode(df, text_col)`` adds a unit ``vector``. ``metadata`` has ``point_id`` and a map
    ``extra``; its entries win over the base fields, and topics without metadata keep the
    base fields alone.
    """
    base = topics.select(
        F.col(id_col).cast("string").alias("point_id"),
        F.col("topic_id").cast("string").alias("topic_id"),
        F.col("text").alias("topic_text"),
    )
    fields = F.create_map(F.lit("topic_id"), F.col("topic_id"), F.lit("topic_text"), F.col("topic_text"))
    if metadata is None:
        base = base.withColumn("payload", fields)
    else:
        extra = F.coalesce(F.col("extra"), F.create_map().cast("map<string,string>"))
        merged = F.map_concat(
            F.map_filter(fields, lambda k, _: ~F.map_contains_key(extra, k)), extra
        )
        base = base.join(metadata.select("point_id", "extra"), "point_id", "left").withColumn(
            "payload", merged
        )
    return encode(base, "topic_text").select(*COLUMNS)


def upsert(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    """The stored points with the arriving ones put in or replaced, by ``point_id``.

    Of arriving rows with one id, the one with the last text in order is taken.
    """
    columns = arriving.columns
    last = F.max_by(F.struct(*columns), F.col("topic_text")).alias("p")
    fresh = arriving.groupBy("point_id").agg(last).select("p.*")
    kept = stored.join(fresh.select("point_id"), "point_id", "left_anti")
    return kept.select(columns).unionByName(fresh)


def write_vectors(df: DataFrame, path: str) -> None:
    """Write the vector table."""
    df.write.mode("overwrite").parquet(path)


def merge_vectors(df: DataFrame, path: str) -> str:
    """Merge points into the table at ``path``: the path of a new version beside it.

    The old version stays as it is, so a merge that breaks off harms nothing. The table is
    written once.
    """
    version = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    upsert(df.sparkSession.read.parquet(path), df).write.parquet(version)
    return version
