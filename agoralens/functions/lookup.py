"""Look-ups into small derived tables without a join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_map(df: DataFrame, key: str, value) -> Column:
    """A map column from a table with one row per class, read as a scalar subquery.

    Only for keys whose number is fixed by the task (class labels, histogram bins,
    correct / incorrect), never for ids. Rows of a hot class then meet their value where
    they lie, without a shuffle on the class.
    """
    pairs = F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v") if isinstance(value, str) else value.alias("v")))
    return df.agg(F.map_from_entries(pairs).alias("m")).scalar()


def one_row(df: DataFrame, *aggregates: Column) -> Column:
    """A struct of whole-table aggregates, read as a scalar subquery."""
    return df.agg(*aggregates).select(F.struct("*").alias("s")).scalar()
