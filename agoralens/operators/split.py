"""Exact stratified split that repeats on every run."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.lookup import one_row_map


def stratified_split(
    df: DataFrame,
    label: str,
    id_col="opinion_id",
    share=fv.SPLIT_SHARE,
    seed=fv.SPLIT_SEED,
) -> DataFrame:
    """Adds ``is_validation``: true for the ``round(share * n)`` smallest hashes of each class.

    No class is sorted as a whole. Hashes are counted by their first four digits, which
    tells in which of the 65536 ranges a class reaches its quota. Only that range is ranked,
    and the hash found there is the limit of the class. Rows then compare themselves with
    the limit where they lie, so texts are not shuffled. Rows without a label are left out.
    """
    rows = df.filter(F.col(label).isNotNull())
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    hashes = rows.select(F.col(label).alias("y"), digest.alias("h"))
    ranges = hashes.groupBy("y", F.substring("h", 1, 4).alias("r")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("y")
    upto = ranges.select(
        "y",
        "r",
        F.sum("n").over(w.orderBy("r")).alias("upto"),
        "n",
        F.round(F.sum("n").over(w) * share).cast("long").alias("quota"),
    )
    cut = upto.filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
    at = one_row_map(
        cut, "y", F.struct("r", (F.col("quota") - (F.col("upto") - F.col("n"))).alias("rank"))
    )
    near = hashes.withColumn("c", at[F.col("y")]).filter(F.substring("h", 1, 4) == F.col("c.r"))
    ranked = near.withColumn("rn", F.row_number().over(w.orderBy("h"))).filter(F.col("rn") == F.col("c.rank"))
    limit = one_row_map(ranked, "y", "h")
    # A class whose quota is 0 has no limit and gives no validation rows.
    return rows.withColumn("_limit", limit[F.col(label)]).withColumn(
        "is_validation", F.coalesce(digest <= F.col("_limit"), F.lit(False))
    ).drop("_limit")
