"""Submitted opinions: scored row by row as they arrive, with totals per batch.

A batch here is either what one trigger of the stream reads (``submit``) or what a user submitted as
one (``submitted_totals``), however many triggers its rows are spread over.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from agoralens.functions.text import is_blank
from agoralens.operators.match import match_topics
from agoralens.streaming.state import keyed_state


def event_time(submissions: DataFrame) -> DataFrame:
    """Adds ``event_time`` from the ``timestamp`` in milliseconds."""
    return submissions.withColumn("event_time", F.timestamp_millis("timestamp"))


def without_repeats(submissions: DataFrame, delay="1 hour") -> DataFrame:
    """One row per ``opinion_id`` as long as repeats arrive within the delay."""
    return submissions.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["opinion_id"])


def score_submissions(
    submissions: DataFrame, encode, topics: DataFrame, classify, **options
) -> DataFrame:
    """Match and classify each submission of a bounded frame, such as one batch of a stream.

    ``encode(df, text)`` adds ``vector``. ``classify(df)`` adds ``predicted_type`` and
    ``type_confidence``. The match takes the plan that fits the size of the topics.
    """
    classified = classify(encode(submissions, "text"))
    keep = [c for c in ("text", "user_id", "event_time") if c in classified.columns]
    matched = match_topics(
        classified,
        topics,
        keep=(*keep, "predicted_type", "type_confidence"),
        **options,
    )
    message = (
        F.when(F.coalesce(is_blank("text"), F.lit(True)), "empty text")
        .when(F.col("matched_topic_id").isNull(), "no topic matched")
        .when(F.col("predicted_type").isNull(), "no position predicted")
    )
    return matched.select(
        "opinion_id",
        *[c for c in keep if c != "text"],
        "matched_topic_id",
        F.col("similarity_score").cast("float").alias("topic_similarity"),
        F.col("predicted_type").alias("predicted_position"),
        F.col("type_confidence").cast("float").alias("position_confidence"),
        F.when(message.isNull(), "ok").otherwise("failed").alias("status"),
        F.coalesce(message, F.lit("")).alias("message"),
    )


def batch_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total_processed"),
        F.count_if(F.col("status") == "ok").alias("successful"),
        F.count_if(F.col("status") != "ok").alias("failed"),
    )


def write_batches(score, results_path: str, totals_path: str):
    """A ``foreachBatch`` sink: results and totals of a batch in folders of their own.

    ``score`` makes the results of a batch. It gets a bounded frame, so topics of any size can
    be matched. A batch that runs again overwrites its own folders, so nothing is counted
    twice. The totals are read back from the written results, so a batch is scored once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{results_path}/batch_id={batch_id}"
        score(batch).write.mode("overwrite").parquet(folder)
        written = batch.sparkSession.read.parquet(folder)
        batch_totals(written).coalesce(1).write.mode("overwrite").parquet(
            f"{totals_path}/batch_id={batch_id}"
        )

    return write


def submit(arriving: DataFrame, score, results_path, totals_path, checkpoint, available_now=False):
    """Start the query that scores submissions and writes them with their batch totals."""
    writer = arriving.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        write_batches(score, results_path, totals_path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


SUBMITTED = "submitted_batch string, total_processed long, successful long, failed long, complete boolean"


class SubmittedBatch(StatefulProcessor):
    """Counts the results of one submitted batch until all have come or its time is over."""

    def __init__(self, limit_ms, forget_ms):
        self.limit_ms, self.forget_ms = limit_ms, forget_ms

    def init(self, handle):
        self.handle = handle
        self.batch = handle.getValueState("batch", "seen long, successful long, expected long, deadline long, closed boolean")

    def _close(self, key, complete):
        seen, successful, expected, deadline, _ = self.batch.get()
        total = max(seen, expected)
        self.batch.update((seen, successful, expected, deadline, True))
        return pd.DataFrame(
            {
                "submitted_batch": [key[0]],
                "total_processed": [total],
                "successful": [successful],
                "failed": [total - successful],  # what never came in time has failed
                "complete": [complete],
            }
        )

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        parts = list(rows)  # a submitted batch is one message of a user
        if self.batch.exists():
            seen, successful, expected, deadline, closed = self.batch.get()
            if closed:
                return
        else:
            seen, successful, expected = 0, 0, 0
            deadline = int(min(p["at"].min() for p in parts)) + self.limit_ms
            self.handle.registerTimer(max(deadline, timerValues.getCurrentWatermarkInMs() + 1))
        for part in parts:
            in_time = part["at"] <= deadline
            seen += int(part["n"][in_time].sum())
            successful += int(part["successful"][in_time].sum())
            expected = max(expected, int(part["expected"].max()))
        self.batch.update((seen, successful, expected, deadline, False))
        if 0 < expected <= seen:
            yield self._close(key, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        if not self.batch.exists():
            return
        if self.batch.get()[4]:
            self.batch.clear()
            return
        self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.forget_ms)
        yield self._close(key, False)


def submitted_totals(results: DataFrame, limit="1 hour", delay="10 minutes", forget="1 day") -> DataFrame:
    """One row for each submitted batch: total, successful and failed results, and whether all came.

    ``results`` is a stream with ``submitted_batch``, ``batch_size`` (null if not told), ``status``
    and ``event_time``. A batch closes when as many results as its size have come, or, by event
    time, ``limit`` after its first one; results without an event time by then count as failed, and
    ones of a later time change nothing. Rows without a batch or a time take no part. A closed
    batch is forgotten after ``forget``.
    """
    limit_ms, forget_ms = (int(pd.Timedelta(x).total_seconds() * 1000) for x in (limit, forget))
    rows = results.filter("submitted_batch is not null and event_time is not null")
    rows = rows.withWatermark("event_time", delay).select(
        F.col("submitted_batch").cast("string").alias("submitted_batch"),
        "event_time",
        F.lit(1).cast("long").alias("n"),
        (F.col("status") == "ok").cast("long").alias("successful"),
        F.coalesce(F.col("batch_size").cast("long"), F.lit(0).cast("long")).alias("expected"),
        F.unix_millis("event_time").alias("at"),
    )
    return rows.groupBy("submitted_batch").transformWithStateInPandas(
        SubmittedBatch(limit_ms, forget_ms), SUBMITTED, "Append", "EventTime"
    )


def keep_submitted(totals: DataFrame, path: str, checkpoint: str, available_now=False):
    """Start the query that writes the totals of each submitted batch once, as Parquet."""
    writer = totals.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    with keyed_state(totals.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
