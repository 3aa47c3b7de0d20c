import numpy as np
import pytest
from pyspark.sql import functions as F

from agoralens.operators import match, match_reports
from agoralens.operators.encode import TfIdfEncoder, model_encoder

PLANS = {
    "broadcast": {},
    "blocked": {"topic_rows": 7, "opinion_rows": 5},
    "cells": {"topic_rows": 7, "opinion_rows": 5, "n_cells": 4},
}


def opinions_of(spark, vectors):
    rows = [(f"o{i:03}", None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "opinion_id string, vector array<double>")


def topics_of(spark, vectors, ids=None):
    rows = [
        (f"p{i:03}", ids[i] if ids else f"t{i:03}", None if v is None else [float(x) for x in v])
        for i, v in enumerate(vectors)
    ]
    return spark.createDataFrame(rows, "point_id string, topic_id string, vector array<double>")


def brute_force(opinions, topics, ids, k):
    """All cosines by hand, ordered by score, topic id, point id."""
    out = {}
    for i, o in enumerate(opinions):
        scored = []
        for j, t in enumerate(topics):
            if o is None or t is None or not np.any(o) or not np.any(t):
                continue
            s = round(float(np.dot(o, t) / np.linalg.norm(o) / np.linalg.norm(t)), 9)
            scored.append((-s, ids[j], f"p{j:03}"))
        out[f"o{i:03}"] = [(p, t, -s) for s, t, p in sorted(scored)[:k]]
    return out


def hits_of(df):
    return {r["opinion_id"]: [tuple(h) for h in r["hits"] or []] for r in df.collect()}


def same_hits(got, expected):
    assert got.keys() == expected.keys()
    for key, hits in expected.items():
        assert [h[:2] for h in got[key]] == [h[:2] for h in hits], key
        assert [h[2] for h in got[key]] == pytest.approx([h[2] for h in hits], abs=2e-9)


@pytest.mark.parametrize("plan", PLANS)
def test_plans_match_brute_force_with_ties_zero_vectors_and_repeated_ids(spark, plan):
    rng = np.random.default_rng(3)
    topics = list(rng.normal(size=(40, 6)))
    topics[5] = topics[9] = topics[2] * 3  # ties
    topics[11] = np.zeros(6)
    topics[12] = None
    ids = [f"t{i % 7}" for i in range(40)]
    opinions = list(rng.normal(size=(31, 6)))
    opinions[4] = topics[2]
    opinions[6] = np.zeros(6)
    opinions[7] = None
    got = match.topic_hits(opinions_of(spark, opinions), topics_of(spark, topics, ids), k=5, plan=plan, **PLANS[plan])
    same_hits(hits_of(got), brute_force(opinions, topics, ids, 5))


@pytest.mark.parametrize("plan", PLANS)
def test_hot_cell_is_cut_into_blocks_and_stays_whole(spark, plan):
    rng = np.random.default_rng(4)
    near = np.array([1.0, 0, 0]) + 0.01 * rng.normal(size=(60, 3))
    topics = list(near[:30]) + list(rng.normal(size=(10, 3)))
    opinions = list(near[30:]) + list(rng.normal(size=(5, 3)))
    ids = [f"t{i:03}" for i in range(40)]
    got = match.topic_hits(opinions_of(spark, opinions), topics_of(spark, topics, ids), k=8, plan=plan, **PLANS[plan])
    same_hits(hits_of(got), brute_force(opinions, topics, ids, 8))


@pytest.mark.parametrize("plan", ["broadcast", "blocked"])
def test_fewer_topics_than_k_and_no_topics(spark, plan):
    opinions = opinions_of(spark, [[1, 0], [0, 1]])
    few = match.topic_hits(opinions, topics_of(spark, [[1, 1]]), k=5, plan=plan)
    assert [len(h) for h in hits_of(few).values()] == [1, 1]
    none = match.match_topics(opinions, topics_of(spark, []), plan=plan).collect()
    assert [(r["matched_topic_id"], r["confidence"]) for r in none] == [(None, False)] * 2


def test_threshold_is_inclusive_and_unmatched_rows_stay(spark):
    half = [0.5, np.sqrt(0.75)]
    rows = match.match_topics(
        opinions_of(spark, [[1, 0], half, [0.49, np.sqrt(1 - 0.49**2)], None]), topics_of(spark, [[1, 0]])
    )
    got = {r["opinion_id"]: (r["matched_topic_id"], r["confidence"]) for r in rows.collect()}
    assert got == {"o000": ("t000", True), "o001": ("t000", True), "o002": ("t000", False), "o003": (None, False)}
    assert [r["opinion_id"] for r in match_reports.below_threshold(rows).collect()] == ["o002"]


@pytest.mark.parametrize("plan", ["auto", "broadcast"])
def test_topics_beyond_the_broadcast_bound_take_another_plan(spark, plan):
    topics, opinions = topics_of(spark, [*np.eye(4), None]), opinions_of(spark, np.eye(4))
    small = match.topic_hits(opinions, topics, plan=plan, broadcast_bytes=64)
    assert "MapInArrow" not in small._jdf.queryExecution().toString()  # hits are joined, not looked up in a broadcast
    same_hits(hits_of(small), hits_of(match.topic_hits(opinions, topics)))


@pytest.mark.parametrize("plan", PLANS)
def test_vectors_without_a_finite_length_meet_nothing(spark, plan):
    odd = [[float("nan"), 1], [float("inf"), 1], [0, 0], None]
    topics, opinions = topics_of(spark, [[1, 0], *odd, [0, 1]]), opinions_of(spark, [[1, 1], *odd])
    options = PLANS[plan] | ({"n_cells": 2} if plan == "cells" else {})
    got = hits_of(match.topic_hits(opinions, topics, plan=plan, **options))
    assert [h[0] for h in got.pop("o000")] == ["p000", "p005"]
    assert all(not hits for hits in got.values()) and len(got) == 4


def test_sparse_vectors_give_the_hits_of_dense_ones(spark):
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((60, 24)) < 0.2, rng.normal(size=(60, 24)), 0.0)
    dense[7] = dense[3] * 2
    dense[8] = 0

    def sparse(df):
        at = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda i: F.get("vector", i) != 0)
        values = F.transform(at, lambda i: F.get("vector", i))
        return df.withColumn("vector", F.struct(at.alias("indices"), values.alias("values")))

    opinions, topics = opinions_of(spark, dense[:30]), topics_of(spark, dense[:40], [f"t{i % 7}" for i in range(40)])
    expected = hits_of(match.topic_hits(opinions, topics))
    # Among topics of cosine zero the order is that of the ids in either form.
    for options in ({}, {"broadcast_bytes": 8}, {"plan": "blocked", "topic_rows": 6, "opinion_rows": 5}):
        same_hits(hits_of(match.topic_hits(sparse(opinions), sparse(topics), dim=24, **options)), expected)


def test_kept_columns_pass_through(spark):
    o = opinions_of(spark, [[1, 0]]).withColumn("topic_id", F.lit("t000"))
    row = match.match_topics(o, topics_of(spark, [[1, 0]]), keep=("topic_id",)).first()
    assert row["topic_id"] == row["matched_topic_id"] == "t000"


def test_wrong_vector_length_is_an_error(spark):
    with pytest.raises(Exception, match="every vector must have 2 numbers"):
        match.topic_hits(opinions_of(spark, [[1, 2, 3]]), topics_of(spark, [[1, 0]])).collect()


def cosine_of_texts(a, b, idf, dim):
    from agoralens.operators.encode import bucket_of

    def vector(words):
        v = np.zeros(dim)
        for w in words:
            v[bucket_of(w, dim)] += 1
        return v * idf

    x, y = vector(a), vector(b)
    return x @ y / np.linalg.norm(x) / np.linalg.norm(y)


def test_text_match_against_hand_computed_cosines(spark):
    texts = ["the cat sat", "the dog sat on the mat", "a bird", None, "...", "the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "opinion_id int, text string")
    encoder = TfIdfEncoder.fit(docs, dim=512)
    topics = [("1", "1", "cat mat"), ("2", "2", "bird dog")]
    stored = encoder(spark.createDataFrame(topics, "point_id string, topic_id string, text string"))
    rows = match.match_topics(encoder(docs), stored, dim=512).collect()
    got = {r["opinion_id"]: {h["topic_id"]: h["score"] for h in r["top_k_matches"] or []} for r in rows}
    for i, text in enumerate(texts):
        words = [w for w in (text or "").split() if w.isalpha()]
        if not words:
            assert got[str(i)] == {}
            continue
        for _, t, topic in topics:
            expected = cosine_of_texts(words, topic.split(), encoder.idf, 512)
            assert got[str(i)][t] == pytest.approx(expected, abs=2e-9)


def test_weights_are_zero_for_a_word_in_every_text(spark):
    docs = spark.createDataFrame([("same",), ("same",)], "text string")
    assert TfIdfEncoder.fit(docs, dim=64)(docs).filter("vector is not null").count() == 0


def test_encoder_survives_saving(spark, tmp_path):
    docs = spark.createDataFrame([("a b",), ("b c",)], "text string")
    encoder = TfIdfEncoder.fit(docs, dim=64)
    encoder.save(str(tmp_path / "e"))
    assert np.array_equal(TfIdfEncoder.load(spark, str(tmp_path / "e")).idf, encoder.idf)


def test_model_encoder_gives_unit_vectors_and_nulls(spark):
    def make_model():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts])

    docs = spark.createDataFrame([("aa",), (None,), ("",), ("bcd",)], "text string")
    out = [r["vector"] for r in model_encoder(make_model, batch_size=2)(docs).collect()]
    assert out[1] is None and out[2] is None
    assert out[0] == pytest.approx([2**-0.5, 2**-0.5]) and out[3] == pytest.approx([1, 0])


def test_pair_similarity(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "left_vector array<double>, right_vector array<double>"
    )
    got = [r["similarity"] for r in match.pair_similarity(df).collect()]
    assert got[0] == pytest.approx(2**-0.5, abs=1e-8) and got[1] is None


def scored(spark, rows):
    return spark.createDataFrame(rows, "similarity_score double, is_correct boolean")


def test_sweep_counts_a_score_on_the_cut_and_never_covers_more_at_a_higher_cut(spark):
    rows = [(0.15, True), (0.15000000000000002, False), (0.5, True), (1.0, True), (None, False)]
    out = match_reports.threshold_sweep(scored(spark, rows)).collect()
    assert len(out) == 21
    cuts = np.arange(0.0, 1.05, 0.05)
    for r, cut in zip(out, cuts):
        passed = [c for s, c in rows if s is not None and s >= cut]
        assert r["threshold"] == cut
        assert r["coverage"] == pytest.approx(len(passed) / len(rows))
        assert r["accuracy"] == pytest.approx(sum(passed) / len(passed) if passed else 0)
    assert all(a["coverage"] >= b["coverage"] for a, b in zip(out, out[1:]))


def test_sweep_where_nothing_passes(spark):
    out = match_reports.threshold_sweep(scored(spark, [(-0.5, True)])).collect()
    assert {(r["accuracy"], r["coverage"]) for r in out} == {(0.0, 0.0)}


def test_box_statistics_by_hand(spark):
    values = [0.0, 0.4, 0.5, 0.5, 0.6, 2.0]
    out = match_reports.box_statistics(scored(spark, [(v, True) for v in values] + [(0.3, False)]))
    rows = {r["is_correct"]: r for r in out.collect()}
    q1, q2, q3 = np.percentile(values, [25, 50, 75])
    box = rows[True]
    assert (box["q1"], box["median"], box["q3"]) == pytest.approx((q1, q2, q3))
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (0.4, 0.6, 2)
    assert rows[False]["whisker_low"] == rows[False]["whisker_high"] == 0.3


def test_report_counts_add_up(spark):
    rows = [(i / 10, True) for i in range(11)] + [(None, False)]
    out = match_reports.similarity_report(scored(spark, rows)).collect()
    assert len(out) == 50 and sum(r["count"] for r in out) == 11
    assert out[0]["guide_share"] == pytest.approx(4 / 11) and out[0]["mean"] == pytest.approx(0.5)
