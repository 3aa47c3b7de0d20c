"""Queries: the same steps on file streams."""

from pyspark.sql import functions as F

from agoralens.operators.encode import TfIdfEncoder
from agoralens.plans.inputs import CLASSIFIED_SQL, DIM, opinions, rule_classify, stream, table
from agoralens.plans.match_queries import TEXT_HITS_SQL, text_topics
from agoralens.plans.registry import query
from agoralens.session import fresh_path, settled
from agoralens.streaming import state, submissions

STREAM_RESULTS_SQL = f"""{CLASSIFIED_SQL}, {TEXT_HITS_SQL.replace('hits AS', 'topic_hits AS')},
results AS (
  SELECT c.opinion_id::VARCHAR AS opinion_id, h.topic_id AS matched_topic_id, predicted_type AS predicted_position,
    score::FLOAT AS topic_similarity, type_confidence::FLOAT AS position_confidence,
    CASE WHEN h.topic_id IS NULL THEN 'failed' ELSE 'ok' END AS status
  FROM classified c LEFT JOIN (SELECT * FROM topic_hits WHERE rank = 1) h ON h.doc_id = c.opinion_id)"""


def _submit_all(spark, sf_dir):
    """All documents submitted as a stream, scored, and written with totals per batch."""
    encoder = TfIdfEncoder.fit(opinions(spark, sf_dir), dim=DIM)
    arriving = stream(spark, sf_dir, "documents").select(F.col("doc_id").alias("opinion_id"), "text")
    known = settled(text_topics(spark, sf_dir, encoder), "stream-topics")

    def score(batch):
        return submissions.score_submissions(batch, encoder, known, rule_classify, dim=DIM)

    folder = fresh_path(spark, "submissions")
    run = submissions.submit(
        arriving, score, f"{folder}/results", f"{folder}/totals", f"{folder}/checkpoint", available_now=True
    )
    run.awaitTermination()
    return folder


@query(
    "stream_results",
    f"""WITH {STREAM_RESULTS_SQL} SELECT * FROM results""",
)
def stream_results(spark, sf_dir):
    rows = spark.read.parquet(f"{_submit_all(spark, sf_dir)}/results")
    return rows.select(
        "opinion_id",
        "matched_topic_id",
        "predicted_position",
        "topic_similarity",
        "position_confidence",
        "status",
    )


@query(
    "stream_batch_totals",
    f"""WITH {STREAM_RESULTS_SQL}
SELECT count(*) AS total_processed, count(*) FILTER (status = 'ok') AS successful,
  count(*) FILTER (status = 'failed') AS failed FROM results""",
)
def stream_batch_totals(spark, sf_dir):
    totals = spark.read.parquet(f"{_submit_all(spark, sf_dir)}/totals")
    return totals.agg(*[F.sum(c).alias(c) for c in ("total_processed", "successful", "failed")])


def _event_stream(spark, sf_dir):
    """Events as scored submissions: the user is the topic, the event type the position."""
    return stream(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("opinion_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id").cast("string").alias("matched_topic_id"),
        F.col("event_type").alias("predicted_position"),
        F.col("value").alias("position_confidence"),
    )


def _kept(spark, rows, keys):
    """The checkpoint of a stream whose totals by key are kept, after all its rows."""
    folder = fresh_path(spark, "totals")
    totals = state.running_totals(rows, keys)
    state.keep_totals(totals, f"{folder}/changes", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return f"{folder}/checkpoint"


def _topic_checkpoint(spark, sf_dir):
    """Every event arrives twice and counts once."""
    twice = _event_stream(spark, sf_dir).union(_event_stream(spark, sf_dir))
    unique = submissions.without_repeats(twice, "40 days")
    return _kept(spark, state.by_topic(unique), ("topic_id", "position"))


@query(
    "stream_topic_state",
    """WITH t AS (SELECT user_id, count(*) AS total, avg(value) AS conf FROM events GROUP BY user_id)
SELECT user_id::VARCHAR AS topic_id, event_type AS "position", count(*) AS count, total AS total_opinions,
  round(conf, 9) AS avg_confidence FROM events JOIN t USING (user_id) GROUP BY user_id, event_type, total, conf""",
)
def stream_topic_state(spark, sf_dir):
    """The running position map of each topic after all events, as rows."""
    rows = state.topic_state(spark, _topic_checkpoint(spark, sf_dir))
    return rows.select(
        "topic_id",
        F.explode("position_distribution").alias("position", "count"),
        "total_opinions",
        F.round("avg_confidence", 9).alias("avg_confidence"),
    )


@query(
    "stream_topic_lookup",
    """WITH t AS (SELECT user_id, count(*) AS total, avg(value) AS conf, count(DISTINCT event_type) AS n,
  sum((event_type = 'click')::INTEGER)::BIGINT AS clicks FROM events GROUP BY user_id)
SELECT c_custkey::VARCHAR AS topic_id, coalesce(total, 0) AS total_opinions, coalesce(n, 0)::INTEGER AS positions,
  coalesce(clicks, 0) AS clicks, round(conf, 9) AS avg_confidence
FROM (SELECT DISTINCT c_custkey FROM customer) LEFT JOIN t ON user_id = c_custkey""",
)
def stream_topic_lookup(spark, sf_dir):
    """Every customer key as an asked topic, known or not, answered from the state store."""
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("topic_id"))
    found = state.asked_topics(spark, _topic_checkpoint(spark, sf_dir), asked)
    counts = F.col("position_distribution")
    return found.select(
        "topic_id",
        "total_opinions",
        F.coalesce(F.cardinality(counts), F.lit(0)).alias("positions"),
        F.coalesce(F.try_element_at(counts, F.lit("click")), F.lit(0)).alias("clicks"),
        F.round("avg_confidence", 9).alias("avg_confidence"),
    )


@query(
    "stream_daily",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS "position", count(*) AS count FROM events GROUP BY ALL""",
)
def stream_daily(spark, sf_dir):
    checkpoint = _kept(spark, state.by_day(_event_stream(spark, sf_dir)), ("day", "position"))
    rows = state.current_totals(spark, checkpoint)
    return rows.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "position", "count")


@query(
    "stream_submitted_totals",
    """WITH timed AS (
  SELECT *, ts <= min(ts) OVER (PARTITION BY user_id) + INTERVAL 20 DAY AS in_time FROM events),
sums AS (
  SELECT user_id, count(*) + (user_id % 3 = 0)::INTEGER AS size, count(*) FILTER (in_time) AS seen,
    count(*) FILTER (in_time AND event_type <> 'error') AS successful FROM timed GROUP BY user_id)
SELECT user_id::VARCHAR AS submitted_batch, size::BIGINT AS total_processed, successful,
  size::BIGINT - successful AS failed, seen >= size AS complete FROM sums""",
)
def stream_submitted_totals(spark, sf_dir):
    """Users as submitted batches of 20 days whose errors failed; of every third one a result never comes."""
    late = (F.col("matched_topic_id").cast("long") % 3 == 0).cast("long")
    events = _event_stream(spark, sf_dir)
    counts = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("submitted_batch")).count()
    results = events.select(
        F.col("matched_topic_id").alias("submitted_batch"),
        F.when(F.col("predicted_position") == "error", "failed").otherwise("ok").alias("status"),
        "event_time",
        late.alias("late"),
    )
    results = results.join(counts, "submitted_batch").withColumn("batch_size", F.col("count") + F.col("late"))
    folder = fresh_path(spark, "submitted")
    totals = submissions.submitted_totals(results, limit="20 days", delay="1 minute")
    submissions.keep_submitted(totals, f"{folder}/totals", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(submissions.SUBMITTED).parquet(f"{folder}/totals")
