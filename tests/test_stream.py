import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from agoralens.operators.analysis import fold_counts
from agoralens.operators.encode import TfIdfEncoder
from agoralens.plans.inputs import rule_classify
from agoralens.schemas import SUBMITTED_OPINION
from agoralens.streaming import state, submissions

DAY = 86_400_000


def write_file(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def read_files(spark, folder, schema):
    """One input file per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture(scope="module")
def topics(spark):
    docs = spark.createDataFrame([("the school",), ("the phone",), ("other words",)], "text string")
    encoder = TfIdfEncoder.fit(docs, dim=256)
    rows = [("1", "school", "school"), ("2", "phone", "phone")]
    return encoder, encoder(spark.createDataFrame(rows, "point_id string, topic_id string, text string"))


BATCHES = [
    [("a", "the school and the phone", "u1", 0), ("b", "the phone", "u2", DAY), ("c", "  ", "u1", DAY)],
    [("d", None, "u3", 2 * DAY), ("a", "the school and the phone", "u1", DAY // 2), ("e", "the school", "u2", 2 * DAY)],
]


def test_stream_gives_the_batch_result_and_totals_per_batch(spark, topics, tmp_path):
    encoder, vectors = topics
    source = str(tmp_path / "in")
    for rows in BATCHES:
        write_file(spark, source, rows, SUBMITTED_OPINION)

    def score(df, **options):
        timed = submissions.event_time(df)
        return submissions.score_submissions(timed, encoder, vectors, rule_classify, dim=256, **options)

    paths = [str(tmp_path / n) for n in ("results", "totals", "checkpoint")]
    arriving = read_files(spark, source, SUBMITTED_OPINION)
    # Topics beyond the broadcast bound take another plan and give the same rows.
    in_blocks = partial(score, broadcast_bytes=64)
    submissions.submit(arriving, in_blocks, *paths, available_now=True).awaitTermination()
    got = spark.read.parquet(paths[0]).drop("batch_id")
    expected = score(spark.read.schema(SUBMITTED_OPINION).parquet(source))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    totals = spark.read.parquet(paths[1])
    assert totals.count() == 2
    sums = totals.agg(F.sum("total_processed"), F.sum("successful"), F.sum("failed")).first()
    assert tuple(sums) == (6, 4, 2)
    rows = {r["opinion_id"]: r for r in got.collect()}
    assert rows["b"]["matched_topic_id"] == "phone" and rows["b"]["status"] == "ok"
    assert (rows["d"]["status"], rows["d"]["message"]) == ("failed", "empty text")


def test_a_batch_that_runs_again_is_not_counted_twice(spark, tmp_path):
    df = spark.createDataFrame([("a", "ok"), ("b", "failed")], "opinion_id string, status string")
    sink = submissions.write_batches(lambda batch: batch, str(tmp_path / "r"), str(tmp_path / "t"))
    for _ in range(2):
        sink(df, 7)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2
    assert tuple(spark.read.parquet(str(tmp_path / "t")).first()) == (2, 1, 1, 7)


SCORED = "opinion_id string, event_time timestamp, matched_topic_id string, predicted_position string, position_confidence double"


def scored_rows(day, ids, topic="t", position="claim"):
    at = dt.datetime(2024, 1, 1 + day, 12)
    return [(i, at, topic, position, 0.5) for i in ids]


FILES = [
    scored_rows(0, "abc") + scored_rows(0, "d", "u", "Rebuttal "),
    scored_rows(1, "aef", position="evidence"),
    scored_rows(2, "gh") + scored_rows(2, "d", "u"),
]


def run_state(spark, tmp_path, rows_of, keys):
    """The folders of the changes and of the checkpoint after all files."""
    source = str(tmp_path / "in")
    for rows in FILES:
        write_file(spark, source, rows, SCORED)
    paths = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    totals = state.running_totals(rows_of(read_files(spark, source, SCORED)), keys)
    state.keep_totals(totals, *paths, available_now=True).awaitTermination()
    return paths


def test_running_state_drops_repeats_and_equals_the_batch_fold(spark, tmp_path):
    def rows_of(stream):
        return state.by_topic(submissions.without_repeats(stream, "10 days"))

    changes, checkpoint = run_state(spark, tmp_path, rows_of, ("topic_id", "position"))
    got = {r["topic_id"]: r for r in state.topic_state(spark, checkpoint).collect()}
    batch = spark.createDataFrame([r for f in FILES for r in f], SCORED)
    first = batch.groupBy("opinion_id").agg(F.min_by(F.struct(*batch.columns[1:]), "event_time").alias("s"))
    once = first.select("opinion_id", "s.*")
    expected = {r["topic_id"]: r for r in fold_counts(state.running_counts(once)).collect()}
    assert got == expected
    assert got["u"]["position_distribution"] == {"rebuttal": 1}
    assert got["t"]["total_opinions"] == 7
    # A batch writes the keys it touches: the last row of each key is its state.
    written = [(r["batch_id"], r["topic_id"], r["position"], r["count"]) for r in spark.read.parquet(changes).collect()]
    assert sorted(written) == [(0, "t", "claim", 3), (0, "u", "rebuttal", 1), (1, "t", "evidence", 2), (2, "t", "claim", 5)]


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    source = str(tmp_path / "in")
    write_file(spark, source, [r for k in range(200) for r in scored_rows(0, [f"o{k}"], f"t{k}")], SCORED)
    write_file(spark, source, scored_rows(1, ["x", "y"], "t7") + scored_rows(1, ["z"], "t8", None), SCORED)
    totals = state.running_totals(state.by_topic(read_files(spark, source, SCORED)), ("topic_id", "position"))
    paths = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    state.keep_totals(totals, *paths, available_now=True).awaitTermination()
    sizes = {r["batch_id"]: r["count"] for r in spark.read.parquet(paths[0]).groupBy("batch_id").count().collect()}
    assert sizes == {0: 200, 1: 2}
    now = {(r["topic_id"], r["position"]): r["count"] for r in state.current_totals(spark, paths[1]).collect()}
    assert len(now) == 201 and now[("t7", "claim")] == 3 and now[("t8", None)] == 1
    before = state.current_totals(spark, paths[1], batch_id=0).filter("topic_id = 't7'").first()
    assert before["count"] == 1


def test_asked_topics_are_read_from_the_state(spark, tmp_path):
    _, checkpoint = run_state(spark, tmp_path, state.by_topic, ("topic_id", "position"))
    asked = spark.createDataFrame([("u",), ("t",), ("t",), ("nobody",), (None,)], "topic_id string")
    topics = spark.createDataFrame([("t", "the text"), ("t", "a text"), ("u", None)], "topic_id string, text string")
    said = spark.createDataFrame([("t", "x", "so it is")], "topic_id string, topic_text string, generated_conclusion string")
    got = {r["topic_id"]: r for r in state.asked_topics(spark, checkpoint, asked, topics, said).collect()}
    assert sorted(got) == ["nobody", "t", "u"]
    assert (got["t"]["total_opinions"], got["t"]["topic_text"], got["t"]["conclusion"]) == (8, "a text", "so it is")
    assert got["u"]["position_distribution"] == {"rebuttal": 1, "claim": 1}
    assert (got["nobody"]["total_opinions"], got["nobody"]["position_distribution"]) == (0, None)
    with pytest.raises(ValueError, match="no state"):
        state.stored_state(spark, checkpoint, "other")


def test_daily_counts(spark, tmp_path):
    _, checkpoint = run_state(spark, tmp_path, state.by_day, ("day", "position"))
    got = {(r["day"].day, r["position"]): r["count"] for r in state.current_totals(spark, checkpoint).collect()}
    assert got == {(1, "claim"): 3, (1, "Rebuttal "): 1, (2, "evidence"): 3, (3, "claim"): 3}


def test_forgotten_keys_need_a_query_that_stays_on(spark, tmp_path):
    source = str(tmp_path / "in")
    write_file(spark, source, FILES[0], SCORED)
    totals = state.running_totals(state.by_topic(read_files(spark, source, SCORED)), ("topic_id", "position"), ttl_ms=DAY)
    paths = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    with pytest.raises(ValueError, match="never ends"):
        state.keep_totals(totals, *paths, available_now=True, ttl_ms=DAY)
    run = state.keep_totals(totals, *paths, ttl_ms=DAY)
    try:
        for _ in range(60):
            run.awaitTermination(1)
            if (tmp_path / "rows" / "batch_id=0" / "_SUCCESS").exists():
                break
    finally:
        run.stop()
    got = {tuple(r)[:3] for r in spark.read.parquet(f"{paths[0]}/batch_id=0").collect()}
    assert got == {("t", "claim", 3), ("u", "rebuttal", 1)}


RESULT = "submitted_batch string, batch_size int, status string, event_time timestamp"


def results(minute, batch, size, *statuses):
    at = dt.datetime(2024, 1, 1, 12) + dt.timedelta(minutes=minute)
    return [(batch, size, status, at) for status in statuses]


def test_totals_of_submitted_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    files = [
        results(0, "split", 4, "ok", "ok") + results(0, "late", 3, "ok", "ok") + results(1, "once", 2, "ok", "failed"),
        results(5, "split", 4, "failed") + results(5, "open", None, "ok") + results(5, None, 1, "ok"),
        results(8, "split", 4, "ok") + results(300, "far", 9, "ok"),
        results(301, "late", 3, "ok") + results(301, "far", 9, "failed"),
        results(302, "late", 3, "ok"),
    ]
    for rows in files:
        write_file(spark, source, rows, RESULT)
    totals = submissions.submitted_totals(read_files(spark, source, RESULT), limit="30 minutes", delay="1 minute")
    path = str(tmp_path / "totals")
    submissions.keep_submitted(totals, path, str(tmp_path / "c"), available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    # One row each; the one that is late has failed, and "far" is still open.
    assert got == [("late", 3, 2, 1, False), ("once", 2, 1, 1, True), ("open", 1, 1, 0, False), ("split", 4, 3, 1, True)]
