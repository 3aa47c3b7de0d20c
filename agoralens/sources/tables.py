"""Readers and writers of the input, intermediate and result tables."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens import schemas

CSV_OPTIONS = {
    "header": True,
    "multiLine": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

TABLES = {
    "topics": (schemas.TOPICS, schemas.TOPICS_CLEAN),
    "opinions": (schemas.OPINIONS, schemas.OPINIONS_CLEAN),
    "conclusions": (schemas.CONCLUSIONS, schemas.CONCLUSIONS_CLEAN),
}


class Tables(NamedTuple):
    topics: DataFrame
    conclusions: DataFrame
    opinions: DataFrame


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table in CSV or Parquet, told apart by the path.

    Quoted CSV fields may hold line breaks, so one CSV file is one task: give big tables as
    many files, or as Parquet. With a schema, columns are picked by name and cast.
    """
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV table needs an explicit schema")
        return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    df = spark.read.parquet(path)
    return df if schema is None else conform(df, schema)


def spread_small(df: DataFrame) -> DataFrame:
    """A table of fewer splits than cores, such as one file of one row group, dealt out to all cores.

    Rows do not change. A table with as many splits as cores is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order and types; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _table_path(folder: str, name: str, clean: bool, fmt: str) -> str:
    return f"{folder.rstrip('/')}/{name}{'_clean' if clean else ''}.{fmt}"


def _load(spark, folder, name, clean, fmt):
    schema = TABLES[name][1 if clean else 0]
    return read_table(spark, _table_path(folder, name, clean, fmt), schema)


def load_topics(spark, folder, clean=False, fmt="parquet") -> DataFrame:
    return _load(spark, folder, "topics", clean, fmt)


def load_opinions(spark, folder, clean=False, fmt="parquet") -> DataFrame:
    return _load(spark, folder, "opinions", clean, fmt)


def load_conclusions(spark, folder, clean=False, fmt="parquet") -> DataFrame:
    return _load(spark, folder, "conclusions", clean, fmt)


def load_all(spark, folder, clean=False, fmt="parquet") -> Tables:
    """All three tables, by name: topics, conclusions, opinions."""
    return Tables(
        topics=load_topics(spark, folder, clean, fmt),
        conclusions=load_conclusions(spark, folder, clean, fmt),
        opinions=load_opinions(spark, folder, clean, fmt),
    )


def write_table(df: DataFrame, path: str, mode="overwrite", partition_by=()) -> None:
    """Write a table as CSV or Parquet, told apart by the path.

    ``partition_by`` is for columns of few values (a day, a position), not for topic ids.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path.rstrip("/").endswith(".csv"):
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
        writer.options(**options).csv(path)
    else:
        writer.parquet(path)


def write_clean_tables(tables: Tables, folder: str, fmt="parquet") -> None:
    for name, df in tables._asdict().items():
        write_table(df, _table_path(folder, name, True, fmt))
