"""Queries: vectors, matching and the studies of its scores."""

from pyspark.sql import functions as F

from agoralens.functions import vectors
from agoralens.operators import match, match_dense, match_reports, match_sparse
from agoralens.operators.encode import TfIdfEncoder
from agoralens.plans.inputs import (
    DIM,
    HITS_SQL,
    MATCHED_SQL,
    CLASSIFIED_SQL,
    bucket_sql,
    classified,
    documents,
    flag_correct,
    label_topics,
    opinions,
    rule_classify,
    table,
    topics,
    vector_opinions,
    weights_sql,
)
from agoralens.plans.profile_queries import histogram_sql
from agoralens.plans.registry import query
from agoralens.session import fresh_path, settled
from agoralens.schemas import OPINIONS_CLASSIFIED, OPINIONS_MATCHED
from agoralens.sources.tables import conform, read_table, write_table
from agoralens.sources.vector_buckets import merge_buckets, read_buckets
from agoralens.sources.vector_table import merge_vectors, vector_table, write_vectors

ROUND = 6


def matches(spark, sf_dir):
    return flag_correct(
        match.match_topics(vector_opinions(spark, sf_dir), label_topics(spark, sf_dir), keep=("topic_id",))
    )


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, ROUND) for c in columns})


@query(
    "normalise_vectors",
    """WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM p GROUP BY vec_id)
SELECT vec_id, pos::INTEGER AS pos, round(x / norm, 6) AS x FROM p JOIN n USING (vec_id)""",
)
def normalise_vectors(spark, sf_dir):
    unit = table(spark, sf_dir, "embeddings").select("vec_id", vectors.l2_normalise("embedding").alias("v"))
    return rounded(unit.select("vec_id", F.posexplode("v").alias("pos", "x")), "x")


@query(
    "match_best",
    f"""WITH {MATCHED_SQL}
SELECT opinion_id, topic_id, matched_topic_id, similarity_score, confidence, is_correct FROM matched""",
)
def match_best(spark, sf_dir):
    return matches(spark, sf_dir).drop("top_k_matches")


@query(
    "match_topk",
    f"""WITH {HITS_SQL}
SELECT opinion_id::VARCHAR AS opinion_id, rank::INTEGER AS rank, topic_id, score FROM hits WHERE rank <= 5""",
)
def match_topk(spark, sf_dir):
    return match.ranked_hits(matches(spark, sf_dir))


SELF_SQL = """WITH v AS (SELECT vec_id::VARCHAR AS id, label::VARCHAR AS label, embedding::DOUBLE[] AS e FROM embeddings),
scored AS (SELECT o.id AS opinion_id, t.id AS point_id, t.label AS topic_id,
  round(list_cosine_similarity(o.e, t.e), 9) AS score FROM v o, v t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY opinion_id ORDER BY score DESC, topic_id, point_id) AS rank FROM scored)
SELECT opinion_id, rank::INTEGER AS rank, point_id, topic_id, score FROM ranked WHERE rank <= 5"""


def _self_match(spark, sf_dir, **options):
    """Every vector against all vectors, whose labels repeat as topic ids."""
    points = vector_opinions(spark, sf_dir)
    hits = match.topic_hits(points, points.withColumn("point_id", F.col("opinion_id")), **options)
    flat = hits.select("opinion_id", F.posexplode("hits").alias("pos", "hit"))
    return flat.select(
        "opinion_id",
        (F.col("pos") + 1).alias("rank"),
        "hit.point_id",
        "hit.topic_id",
        "hit.score",
    )


@query("match_broadcast", SELF_SQL)
def match_broadcast(spark, sf_dir):
    return _self_match(spark, sf_dir, plan="broadcast")


@query("match_blocked", SELF_SQL)
def match_blocked(spark, sf_dir):
    """The plan for topic vectors beyond the broadcast bound, with blocks small enough to cut."""
    return _self_match(spark, sf_dir, plan="blocked", topic_rows=256, opinion_rows=256)


@query("match_cells", SELF_SQL)
def match_cells(spark, sf_dir):
    """The plan that ``auto`` takes beyond the bound, with blocks small enough to cut."""
    return _self_match(spark, sf_dir, broadcast_bytes=64, topic_rows=256, opinion_rows=256)


@query("match_probes")
def match_probes(spark, sf_dir):
    """Pairs scored and recall at five, exact (0) and with a quarter, half and most of the cells probed."""
    points = vector_opinions(spark, sf_dir)
    cells = max(4, round(points.count() ** 0.5))
    dim = points.agg(F.max(F.size("vector"))).first()[0]
    topics = points.withColumn("point_id", F.col("opinion_id").cast("string"))
    return match_dense.probe_report(points, topics, 5, dim, (cells // 4, cells // 2, cells * 7 // 8), n_cells=cells)


@query(
    "match_attached",
    f"""WITH {MATCHED_SQL}
SELECT opinion_id, topic_id, matched_topic_id, similarity_score, is_correct FROM matched""",
)
def match_attached(spark, sf_dir):
    """Matches put back on the opinions by id."""
    found = matches(spark, sf_dir)
    return match.with_matches(vector_opinions(spark, sf_dir).drop("vector"), found)


@query(
    "below_threshold",
    f"""WITH {MATCHED_SQL}
SELECT opinion_id, matched_topic_id AS matched_topic, similarity_score AS score FROM matched WHERE similarity_score < 0.5""",
)
def below_threshold(spark, sf_dir):
    return match_reports.below_threshold(matches(spark, sf_dir))


@query(
    "match_summary",
    f"""WITH {MATCHED_SQL}
SELECT count(*) AS total, count(*) FILTER (is_correct) AS correct, round(avg(is_correct::INTEGER), 6) AS accuracy,
  round(avg(similarity_score), 6) AS mean_similarity, count(*) FILTER (similarity_score >= 0.5) AS confident,
  count(*) FILTER (similarity_score < 0.5) AS below_threshold FROM matched""",
)
def match_summary(spark, sf_dir):
    return rounded(match_reports.match_summary(matches(spark, sf_dir)), "accuracy", "mean_similarity")


@query(
    "threshold_sweep",
    f"""WITH {MATCHED_SQL},
cuts AS (SELECT i AS step, i * 0.05::DOUBLE AS threshold FROM range(21) r(i))
SELECT step::INTEGER AS step, round(threshold, 6) AS threshold,
  round(coalesce(count(*) FILTER (similarity_score >= threshold AND is_correct)::DOUBLE
    / nullif(count(*) FILTER (similarity_score >= threshold), 0), 0), 6) AS accuracy,
  round(count(*) FILTER (similarity_score >= threshold)::DOUBLE / count(*), 6) AS coverage,
  count(*) FILTER (similarity_score >= threshold) AS passed
FROM matched, cuts GROUP BY step, threshold""",
)
def threshold_sweep(spark, sf_dir):
    return rounded(match_reports.threshold_sweep(matches(spark, sf_dir)), "threshold", "accuracy", "coverage")


@query(
    "score_by_correctness",
    f"""WITH {MATCHED_SQL}
SELECT is_correct, count(*) AS count, round(avg(similarity_score), 6) AS mean, round(stddev_pop(similarity_score), 6) AS std
FROM matched GROUP BY is_correct""",
)
def score_by_correctness(spark, sf_dir):
    return rounded(match_reports.score_by_correctness(matches(spark, sf_dir)), "mean", "std")


def _box_sql(source, score):
    return f"""q AS (SELECT is_correct, quantile_cont({score}, 0.25) AS q1, quantile_cont({score}, 0.5) AS median,
  quantile_cont({score}, 0.75) AS q3 FROM {source} GROUP BY is_correct)
SELECT is_correct, count(*) AS count, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
  round(any_value(q3), 6) AS q3,
  round(least(min({score}) FILTER ({score} >= q1 - 1.5 * (q3 - q1)), any_value(q1)), 6) AS whisker_low,
  round(greatest(max({score}) FILTER ({score} <= q3 + 1.5 * (q3 - q1)), any_value(q3)), 6) AS whisker_high,
  count(*) FILTER ({score} < q1 - 1.5 * (q3 - q1) OR {score} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM {source} JOIN q USING (is_correct) GROUP BY is_correct"""


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("score_boxplot", f"WITH {MATCHED_SQL}, {_box_sql('matched', 'similarity_score')}")
def score_boxplot(spark, sf_dir):
    return rounded(match_reports.box_statistics(matches(spark, sf_dir)), *BOX)


CONFIDENCE_SQL = f"""{CLASSIFIED_SQL},
flagged AS (SELECT *, predicted_type = type AS is_correct FROM classified)"""


def flagged(spark, sf_dir):
    return classified(spark, sf_dir).withColumn("is_correct", match.is_correct("predicted_type", "type"))


@query("confidence_boxplot", f"WITH {CONFIDENCE_SQL}, {_box_sql('flagged', 'type_confidence')}")
def confidence_boxplot(spark, sf_dir):
    return rounded(match_reports.box_statistics(flagged(spark, sf_dir), "type_confidence"), *BOX)


@query(
    "confidence_by_correctness",
    f"""WITH {CONFIDENCE_SQL}
SELECT is_correct, count(*) AS count, round(avg(type_confidence), 6) AS mean, round(stddev_pop(type_confidence), 6) AS std
FROM flagged GROUP BY is_correct""",
)
def confidence_by_correctness(spark, sf_dir):
    return rounded(match_reports.score_by_correctness(flagged(spark, sf_dir), "type_confidence"), "mean", "std")


def _report_sql(source, score, bins):
    extra = f""", round((SELECT avg({score}) FROM {source}), 6) AS mean,
  round((SELECT avg(({score} >= 0.7)::INTEGER) FROM {source}), 6) AS guide_share"""
    return histogram_sql(source, score, bins, extra)


REPORT = ("lower", "upper", "mean", "guide_share")


@query("similarity_report", f"WITH {MATCHED_SQL}, {_report_sql('matched', 'similarity_score', 50)}")
def similarity_report(spark, sf_dir):
    return rounded(match_reports.similarity_report(matches(spark, sf_dir)), *REPORT)


@query("confidence_report", f"WITH {CLASSIFIED_SQL}, {_report_sql('classified', 'type_confidence', 30)}")
def confidence_report(spark, sf_dir):
    return rounded(match_reports.confidence_report(classified(spark, sf_dir)), *REPORT)


@query(
    "pair_similarity",
    """SELECT a.vec_id AS left_id, b.vec_id AS right_id,
  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def pair_similarity(spark, sf_dir):
    """Each vector with the vector of the next id."""
    rows = table(spark, sf_dir, "embeddings")
    left = rows.select(F.col("vec_id").alias("left_id"), F.col("embedding").alias("left_vector"))
    right = rows.select(
        F.col("vec_id").alias("right_id"),
        (F.col("vec_id") - 1).alias("left_id"),
        F.col("embedding").alias("right_vector"),
    )
    pairs = match.pair_similarity(left.join(right, "left_id"))
    return pairs.select("left_id", "right_id", "similarity")


@query(
    "encode_tfidf",
    f"WITH {weights_sql()} SELECT doc_id, bucket, round(w, 6) AS weight FROM vec",
)
def encode_tfidf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    coded = TfIdfEncoder.fit(docs, dim=DIM)(docs.select("doc_id", "text"))
    parts = F.arrays_zip(F.col("vector.indices").alias("bucket"), F.col("vector.values").alias("weight"))
    flat = coded.select("doc_id", F.inline(parts))
    return rounded(flat.toDF("doc_id", "bucket", "weight"), "weight")


TEXT_HITS_SQL = f"""{weights_sql()},
ttf AS (
  SELECT item_id::VARCHAR AS topic_id, {bucket_sql('w')} AS bucket, count(*) AS tf
  FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w FROM benchmark) GROUP BY ALL),
tw AS (
  SELECT topic_id, bucket, tf * coalesce(idf, ln((n + 1)::DOUBLE)) AS w FROM ttf LEFT JOIN idf USING (bucket), corpus),
tn AS (SELECT topic_id, sqrt(sum(w * w)) AS norm FROM tw GROUP BY topic_id),
tvec AS (SELECT topic_id, bucket, w / norm AS w FROM tw JOIN tn USING (topic_id) WHERE norm > 0),
dots AS (SELECT doc_id, topic_id, sum(vec.w * tvec.w) AS dot FROM vec JOIN tvec USING (bucket) GROUP BY ALL),
scored AS (
  SELECT d.doc_id, t.topic_id, round(coalesce(dot, 0), 9) AS score
  FROM (SELECT DISTINCT doc_id FROM vec) d, (SELECT DISTINCT topic_id FROM tvec) t
  LEFT JOIN dots ON dots.doc_id = d.doc_id AND dots.topic_id = t.topic_id),
hits AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, topic_id) AS rank FROM scored)"""


def text_topics(spark, sf_dir, encoder):
    items = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), F.col("item_id").alias("topic_id"), "text"
    )
    return settled(vector_table(items, encoder), "text-topics")


def text_opinions(docs, encoder):
    """The stored vectors of the opinions: a task that encodes as it matches holds twice the Python workers."""
    return settled(encoder(docs).select("opinion_id", "vector"), "text-opinions")


def _text_matches(spark, sf_dir, **options):
    docs = opinions(spark, sf_dir)
    encoder = TfIdfEncoder.fit(docs, dim=DIM)
    return match.match_topics(text_opinions(docs, encoder), text_topics(spark, sf_dir, encoder), dim=DIM, **options)


@query(
    "text_match_topk",
    f"""WITH {TEXT_HITS_SQL}
SELECT doc_id::VARCHAR AS opinion_id, rank::INTEGER AS rank, topic_id, score FROM hits WHERE rank <= 5""",
)
def text_match_topk(spark, sf_dir):
    return match.ranked_hits(_text_matches(spark, sf_dir))


@query(
    "text_match_best",
    f"""WITH {TEXT_HITS_SQL}
SELECT d.doc_id::VARCHAR AS opinion_id, h.topic_id AS matched_topic_id, score AS similarity_score,
  coalesce(score >= 0.5, false) AS confidence
FROM documents d LEFT JOIN (SELECT * FROM hits WHERE rank = 1) h ON h.doc_id = d.doc_id""",
)
def text_match_best(spark, sf_dir):
    """Every document with its best topic; documents without a known word stay, unmatched."""
    return _text_matches(spark, sf_dir).drop("top_k_matches")


@query(
    "text_match_lists",
    f"""WITH {TEXT_HITS_SQL}
SELECT doc_id::VARCHAR AS opinion_id, rank::INTEGER AS rank, topic_id, score FROM hits WHERE rank <= 5""",
)
def text_match_lists(spark, sf_dir):
    """The same through inverted lists: the topics are beyond a broadcast bound of 64 bytes."""
    return match.ranked_hits(_text_matches(spark, sf_dir, broadcast_bytes=64))


@query("text_match_pairs")
def text_match_pairs(spark, sf_dir):
    """How many pairs and list entries there are, and how many of them the inverted lists need."""
    docs = opinions(spark, sf_dir)
    encoder = TfIdfEncoder.fit(docs, dim=DIM)
    return match_sparse.pair_report(text_opinions(docs, encoder), text_topics(spark, sf_dir, encoder), 5, DIM)


@query(
    "similar_topics",
    f"""WITH {weights_sql()},
btok AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w FROM benchmark),
ttf AS (SELECT item_id, {bucket_sql('w')} AS bucket, count(*) AS tf FROM btok GROUP BY ALL),
tw AS (SELECT item_id, bucket, tf * coalesce(idf, ln((n + 1)::DOUBLE)) AS w FROM ttf LEFT JOIN idf USING (bucket), corpus),
tn AS (SELECT item_id, sqrt(sum(w * w)) AS norm FROM tw GROUP BY item_id),
tvec AS (SELECT item_id, bucket, w / norm AS w FROM tw JOIN tn USING (item_id) WHERE norm > 0),
dots AS (SELECT a.item_id AS q, b.item_id AS t, sum(a.w * b.w) AS dot FROM tvec a JOIN tvec b USING (bucket) GROUP BY ALL),
ids AS (SELECT DISTINCT item_id FROM tvec),
scored AS (SELECT a.item_id::VARCHAR AS query_id, b.item_id::VARCHAR AS topic_id, round(coalesce(dot, 0), 9) AS score
  FROM ids a, ids b LEFT JOIN dots ON q = a.item_id AND t = b.item_id),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, topic_id) AS rank FROM scored)
SELECT query_id AS opinion_id, rank::INTEGER AS rank, topic_id, b.text AS topic_text, score
FROM hits JOIN benchmark b ON b.item_id::VARCHAR = topic_id WHERE rank <= 5""",
)
def similar_topics(spark, sf_dir):
    """Each benchmark text as a query for its five most similar benchmark texts."""
    encoder = TfIdfEncoder.fit(documents(spark, sf_dir), dim=DIM)
    stored = text_topics(spark, sf_dir, encoder)
    queries = stored.select(F.col("point_id").alias("opinion_id"), "vector")
    return match.similar_topics(queries, stored, dim=DIM)


@query(
    "text_pair_similarity",
    f"""WITH {weights_sql()},
dots AS (SELECT a.doc_id AS l, sum(a.w * b.w) AS dot FROM vec a JOIN vec b ON b.doc_id = a.doc_id + 1 AND b.bucket = a.bucket GROUP BY 1),
ids AS (SELECT DISTINCT doc_id FROM vec)
SELECT a.doc_id AS left_id, round(CASE WHEN i.doc_id IS NOT NULL AND j.doc_id IS NOT NULL THEN coalesce(dot, 0) END, 9) AS similarity
FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 LEFT JOIN dots ON l = a.doc_id
LEFT JOIN ids i ON i.doc_id = a.doc_id LEFT JOIN ids j ON j.doc_id = b.doc_id""",
)
def text_pair_similarity(spark, sf_dir):
    """Each document with the document of the next id."""
    docs = documents(spark, sf_dir)
    coded = TfIdfEncoder.fit(docs, dim=DIM)(docs.select("doc_id", "text")).select("doc_id", "vector")
    coded = settled(coded, "text-vectors")
    left = coded.select(F.col("doc_id").alias("left_id"), F.col("vector").alias("left_vector"))
    right = coded.select((F.col("doc_id") - 1).alias("left_id"), F.col("vector").alias("right_vector"))
    pairs = match.pair_similarity(left.join(right, "left_id"), dim=DIM)
    return pairs.select("left_id", "similarity")


UPSERT_SQL = """WITH c AS (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label),
arriving AS (SELECT vec_id::VARCHAR AS point_id, 'replaced' AS topic_text FROM c
  UNION ALL SELECT 'new ' || label, 'added' FROM c),
stored AS (SELECT vec_id::VARCHAR AS point_id, 'stored' AS topic_text FROM embeddings)
SELECT point_id, topic_text FROM stored WHERE point_id NOT IN (SELECT point_id FROM arriving)
UNION ALL SELECT point_id, topic_text FROM arriving"""


def _points(spark, sf_dir):
    """The points of a vector table, and one replaced and one new point per label."""
    rows = table(spark, sf_dir, "embeddings")

    def point(df, point_id, text):
        return df.select(
            point_id.alias("point_id"),
            F.col("label").cast("string").alias("topic_id"),
            F.lit(text).alias("topic_text"),
            "embedding",
        )

    first = rows.groupBy("label").agg(
        F.min("vec_id").alias("vec_id"), F.min_by("embedding", "vec_id").alias("embedding")
    )
    arriving = point(first, F.col("vec_id").cast("string"), "replaced").unionByName(
        point(first, F.concat(F.lit("new "), F.col("label").cast("string")), "added")
    )
    return point(rows, F.col("vec_id").cast("string"), "stored"), arriving


@query("vector_upsert", UPSERT_SQL)
def vector_upsert(spark, sf_dir):
    """The vector table written, then merged with the arriving points."""
    path = fresh_path(spark, "vectors")
    stored, arriving = _points(spark, sf_dir)
    write_vectors(stored, path)
    return spark.read.parquet(merge_vectors(arriving, path)).select("point_id", "topic_text")


@query("vector_bucket_merge", UPSERT_SQL)
def vector_bucket_merge(spark, sf_dir):
    """The same in buckets: the merge writes those that the arriving points fall into."""
    path = fresh_path(spark, "vector-buckets")
    stored, arriving = _points(spark, sf_dir)
    merge_buckets(stored, path, buckets=64)
    merge_buckets(arriving, path)
    return read_buckets(spark, path).select("point_id", "topic_text")


@query(
    "study_tables",
    f"""WITH {CLASSIFIED_SQL}, {TEXT_HITS_SQL.replace('hits AS', 'topic_hits AS')}
SELECT c.opinion_id::VARCHAR AS opinion_id, c.topic_id, type, h.topic_id AS matched_topic_id, score AS similarity_score,
  coalesce(h.topic_id = c.topic_id, false) AS is_correct, predicted_type, round(type_confidence, 6) AS type_confidence
FROM classified c LEFT JOIN (SELECT * FROM topic_hits WHERE rank = 1) h ON h.doc_id = c.opinion_id""",
)
def study_tables(spark, sf_dir):
    """Matched opinions written and read, then classified, written and read with their schemas."""
    folder = fresh_path(spark, "study")
    docs = opinions(spark, sf_dir)
    encoder = TfIdfEncoder.fit(docs, dim=DIM)
    found = match.match_topics(text_opinions(docs, encoder), text_topics(spark, sf_dir, encoder), dim=DIM)
    rows = match.with_matches(docs.withColumn("effectiveness", F.lit(None).cast("string")), found)
    write_table(conform(rows, OPINIONS_MATCHED), f"{folder}/opinions_with_matches.parquet")
    matched = read_table(spark, f"{folder}/opinions_with_matches.parquet", OPINIONS_MATCHED)
    write_table(conform(rule_classify(matched), OPINIONS_CLASSIFIED), f"{folder}/opinions_classified.parquet")
    rows = read_table(spark, f"{folder}/opinions_classified.parquet", OPINIONS_CLASSIFIED)
    return rounded(rows.drop("text", "effectiveness"), "type_confidence")


@query(
    "vector_payload",
    """WITH toxic AS (SELECT source, max(toxic) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY source),
topics AS (SELECT source, text FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rn FROM documents) WHERE rn = 1)
SELECT source AS point_id, 'topic_id' AS "key", source AS value FROM topics UNION ALL
SELECT source, 'topic_text', CASE WHEN toxic = 1 THEN 'withheld' ELSE text END FROM topics LEFT JOIN toxic USING (source) UNION ALL
SELECT source, 'toxic', '1' FROM toxic WHERE toxic = 1""",
)
def vector_payload(spark, sf_dir):
    """Payloads of the topic vectors; metadata of toxic sources wins over the base fields."""
    docs = documents(spark, sf_dir)
    toxic = (
        docs.select("doc_id", "source")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .groupBy(F.col("source").alias("point_id"))
        .agg(F.max("toxic").alias("toxic"))
        .filter("toxic = 1")
    )
    extra = F.create_map(F.lit("topic_text"), F.lit("withheld"), F.lit("toxic"), F.col("toxic").cast("string"))

    def no_vectors(df, _):  # payloads need none
        return df.withColumn("vector", F.lit(None).cast("array<double>"))

    points = vector_table(topics(spark, sf_dir), no_vectors, toxic.select("point_id", extra.alias("extra")))
    return points.select("point_id", F.explode("payload").alias("key", "value"))


