"""Small mergeable summaries: the most frequent keys without a shuffle of all keys, distinct counts.

Frequent keys: each task keeps a bounded number of counters (Misra-Gries). A key's counters sum to its
count less an error that is known, the sum of what the tasks took off; a key without a counter has a
count of that error at most. The keys that can be among the n most frequent are then counted exactly.
The result stands if the n-th count is above the error; else all keys are counted.

Distinct values: HyperLogLog sketches, stored by day or any other key and joined later.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = 4096  # of a task
LG_CONFIG = 12  # 4096 registers: a relative standard error of about 1.6 %
ERROR = "key string, low long, error long"


def reduced(counts, counters):
    """The counters that are left and the error, after the same amount is taken off all of them."""
    if len(counts) <= counters:
        return counts, 0
    off = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - counters - 1)[len(counts) - counters - 1])
    return Counter({k: n - off for k, n in counts.items() if n > off}), off


def _counters(counters):
    def run(batches):
        counts, error = Counter(), 0
        for batch in batches:
            found = pc.value_counts(batch.column("key"))
            counts.update(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist())))
            counts, off = reduced(counts, counters)
            error += off
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*keys, None], pa.string()),
                pa.array([*map(counts.get, keys), 0], pa.int64()),
                pa.array([0] * len(keys) + [error], pa.int64()),
            ],
            names=["key", "low", "error"],
        )

    return run


def key_bounds(df: DataFrame, key: str, counters=COUNTERS) -> DataFrame:
    """``(key, low, error)``: the counted part of each key that a task kept; the null key has the error."""
    keys = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"))
    found = keys.mapInArrow(_counters(counters), ERROR)
    return found.groupBy("key").agg(F.sum("low").alias("low"), F.sum("error").alias("error"))


def most_frequent(df: DataFrame, key: str, n: int, counters=COUNTERS) -> DataFrame:
    """The n keys with the most rows and their exact ``count``; ties go to the smaller key.

    Null keys are left out. Only counters and candidates are shuffled. Where the counters cannot
    tell that no other key is as frequent, as with many keys of like counts, all keys are counted.
    """
    bounds = key_bounds(df, key, counters)
    error = bounds.filter("key is null").select(F.coalesce(F.max("error"), F.lit(0)).alias("e")).first()["e"]
    leading = bounds.filter("key is not null").orderBy(F.desc("low"), "key")
    top = leading.limit(n).collect()
    least = top[-1]["low"] if len(top) == n else 0
    # A candidate's count is its low end plus the error at most.
    candidates = leading.filter(F.col("low") + error >= least).limit(counters + 1).collect()
    counts = df.filter(F.col(key).isNotNull())
    proven = error == 0 and len(candidates) <= counters
    if len(top) == n and len(candidates) <= counters and least > error:
        proven = True  # the n-th exact count is no less, and keys without a counter stay below it
    if proven:
        names = df.sparkSession.createDataFrame([(r["key"],) for r in candidates], "_key string")
        counts = counts.join(F.broadcast(names), F.col(key).cast("string") == F.col("_key"), "left_semi")
    counts = counts.groupBy(key).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), key).limit(n)


def distinct_sketches(df: DataFrame, by: str, column: str, lg_config=LG_CONFIG) -> DataFrame:
    """One sketch of the non-null values of ``column`` for each ``by``: a table to store and to join later."""
    return df.groupBy(by).agg(F.hll_sketch_agg(column, lg_config).alias("sketch"))


def distinct_estimate(sketches: DataFrame, by: str | None = None) -> DataFrame:
    """The estimated number of distinct values of all joined sketches, or for each ``by``."""
    grouped = sketches.groupBy(by) if by else sketches.groupBy()
    return grouped.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
