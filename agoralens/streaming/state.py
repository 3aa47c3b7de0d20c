"""Running totals by key, kept in the state store and read from there.

A stream of scored opinions is summed by key in the tasks first, so a hot topic sends a few rows for
each batch. A keyed processor adds them to one value for each key and gives the new totals of the
keys that a batch touched; the sink writes these rows and no others. The totals of all keys, or of
asked ones, are read from the checkpoint's state store, so no table of the whole state is written.
"""

import contextlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from agoralens.functions.text import normal_label
from agoralens.operators.analysis import fold_counts, position_counts

TOTALS = "count long, confidence_sum double, confidence_count long"
SUMS = ("count", "confidence_sum", "confidence_count")
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads the keys it changes, not the files of the store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def running_counts(scored: DataFrame) -> DataFrame:
    """Counts per topic and position of a bounded frame of scored opinions."""
    return position_counts(
        scored.select(
            F.col("matched_topic_id"),
            F.col("predicted_position").alias("predicted_type"),
            F.col("position_confidence").cast("double").alias("type_confidence"),
        )
    )


def by_topic(scored: DataFrame) -> DataFrame:
    """The keys and the confidence of each scored opinion with a topic."""
    rows = scored.filter(F.col("matched_topic_id").isNotNull())
    return rows.select(
        F.col("matched_topic_id").alias("topic_id"),
        normal_label(F.col("predicted_position")).alias("position"),
        F.col("position_confidence").cast("double").alias("confidence"),
    )


def by_day(scored: DataFrame) -> DataFrame:
    """The day of the event time and the position of each scored opinion."""
    return scored.filter(F.col("event_time").isNotNull()).select(
        F.date_trunc("day", "event_time").alias("day"),
        F.col("predicted_position").alias("position"),
        F.col("position_confidence").cast("double").alias("confidence"),
    )


def summed_by_task(rows: DataFrame, keys) -> DataFrame:
    """Keys with the sums of each Arrow batch of a task: what a batch of a stream sends to its state."""

    def run(batches):
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate(
                [([], "count_all"), ("confidence", "sum"), ("confidence", "count")]
            )
            sums = sums.select([*keys, "count_all", "confidence_sum", "confidence_count"]).combine_chunks()
            yield from sums.rename_columns([*keys, *SUMS]).to_batches()

    kinds = [rows.schema[k] for k in keys]
    return rows.select(*keys, "confidence").mapInArrow(run, T.StructType([*kinds, *T.StructType.fromDDL(TOTALS)]))


class RunningTotals(StatefulProcessor):
    """One value for each key: rows, confidence sum and confidence count."""

    def __init__(self, keys, ttl_ms=None):
        self.keys, self.ttl_ms = keys, ttl_ms

    def init(self, handle):
        self.totals = handle.getValueState("totals", TOTALS, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        count, total, known = self.totals.get() if self.totals.exists() else (0, 0.0, 0)
        for part in rows:
            count += int(part["count"].sum())
            total += float(part["confidence_sum"].sum())
            known += int(part["confidence_count"].sum())
        self.totals.update((count, total, known))
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, **dict(zip(SUMS, ([count], [total], [known])))})


def running_totals(rows: DataFrame, keys, ttl_ms: int | None = None) -> DataFrame:
    """The current totals of every key that a batch of the stream touches.

    ``rows`` holds the keys and ``confidence``. With ``ttl_ms`` a key that has not been touched for
    that long is forgotten; its next row starts anew.
    """
    sums = summed_by_task(rows, keys)
    return sums.groupBy(*keys).transformWithStateInPandas(
        RunningTotals(tuple(keys), ttl_ms), sums.schema, "Update", "ProcessingTime" if ttl_ms else "None"
    )


@contextlib.contextmanager
def keyed_state(spark: SparkSession):
    """The session with the state store that keyed processors need, for starting a query."""
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_changes(path: str):
    """A ``foreachBatch`` sink: the changed rows of a batch in a folder of its own.

    A batch that runs again overwrites its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def keep_totals(stream: DataFrame, path: str, checkpoint: str, available_now=False, ttl_ms: int | None = None):
    """Start the query that keeps the totals and writes what each batch changes.

    Totals with a ``ttl_ms`` (tell it here too) look at the clock for ever, so they need a query that
    stays on.
    """
    if available_now and ttl_ms:
        raise ValueError("a query whose keys are forgotten by the clock never ends by itself")
    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_changes(path))
    )
    with keyed_state(stream.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored_state(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None = None) -> DataFrame:
    """The keys and values of a state variable after the last finished batch, or after ``batch_id``."""
    operators = spark.read.format("state-metadata").load(checkpoint)
    # One row for each stateful operator of the query.
    found = [
        r["operatorId"]
        for r in operators.collect()
        if r["operatorName"].startswith("transformWithState") and f'"{variable}"' in (r["operatorProperties"] or "")
    ]
    if not found:
        raise ValueError(f"the checkpoint has no state {variable}")
    reader = spark.read.format("statestore").option("operatorId", found[0]).option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "value.*")


def current_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The totals of every key."""
    return stored_state(spark, checkpoint, "totals", batch_id)


def topic_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The running position map, total and mean confidence of each topic."""
    return fold_counts(current_totals(spark, checkpoint))


def asked_topics(spark: SparkSession, checkpoint: str, asked: DataFrame, topics=None, conclusions=None) -> DataFrame:
    """The state of each asked ``topic_id``, with text and conclusion where these tables are given.

    An id that no opinion has reached yet has total 0 and null maps. Asked ids are joined before
    the counts are folded, so only their rows are.
    """
    ids = asked.select("topic_id").filter("topic_id is not null").distinct()
    folded = fold_counts(current_totals(spark, checkpoint).join(ids, "topic_id", "left_semi"))
    out = ids.join(folded, "topic_id", "left").withColumn("total_opinions", F.coalesce("total_opinions", F.lit(0)))
    if topics is not None:
        text = topics.groupBy("topic_id").agg(F.min("text").alias("topic_text"))
        out = out.join(text, "topic_id", "left")
    if conclusions is not None:
        said = conclusions.groupBy("topic_id").agg(
            F.min_by("generated_conclusion", F.struct("topic_text", "generated_conclusion")).alias("conclusion")
        )
        out = out.join(said, "topic_id", "left")
    return out
