"""Queries: topic analysis, prompts, summaries, conclusions and look-ups."""

from string import Formatter

from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.operators import analysis
from agoralens.operators.conclude import NO_SENTENCE, generate_conclusions, opinion_results, topic_result
from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.match import pair_similarity
from agoralens.operators.summarise import summarise_topics
from agoralens.plans.inputs import (
    CLASSIFIED_SQL,
    DIM,
    SPACE,
    TOPICS_SQL,
    bucket_sql,
    classified,
    opinions,
    table,
    topics,
    weights_sql,
)
from agoralens.plans.registry import query
from agoralens.session import fresh_path, settled


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "topic_analysis",
    f"""WITH {CLASSIFIED_SQL},
t AS (SELECT topic_id, count(*) AS total, avg(type_confidence) AS conf FROM classified GROUP BY topic_id)
SELECT topic_id, total AS total_opinions, predicted_type AS "position", count(*) AS count,
  round(count(*) * 100.0::DOUBLE / total, 6) AS percent, round(conf, 6) AS avg_confidence
FROM classified JOIN t USING (topic_id) GROUP BY topic_id, total, predicted_type, conf""",
)
def topic_analysis(spark, sf_dir):
    """The position maps of each topic as rows."""
    rows = analysis.topic_analysis(classified(spark, sf_dir), topic="topic_id")
    flat = rows.select(
        "topic_id",
        "total_opinions",
        F.explode("position_distribution").alias("position", "count"),
        "position_percentages",
        F.round("avg_confidence", 6).alias("avg_confidence"),
    )
    share = F.round(F.col("position_percentages")[F.col("position")], 6)
    return flat.withColumn("percent", share).drop("position_percentages")


SAMPLES_SQL = f"""{CLASSIFIED_SQL},
ranked AS (
  SELECT topic_id, predicted_type, text,
    row_number() OVER (PARTITION BY topic_id, predicted_type ORDER BY opinion_id) AS rank FROM classified),
samples AS (
  SELECT * FROM ranked WHERE rank <= CASE predicted_type
    {' '.join(f"WHEN '{p}' THEN {n}" for p, n in fv.SAMPLE_LIMITS.items())} ELSE 0 END)"""


@query(
    "topic_samples",
    f"""WITH {SAMPLES_SQL}
SELECT topic_id, CASE predicted_type {' '.join(f"WHEN '{p}' THEN '{f}'" for p, f in fv.SAMPLE_FIELDS.items())} END AS field,
  rank::INTEGER AS rank, text FROM samples""",
)
def topic_samples(spark, sf_dir):
    rows = analysis.topic_samples(classified(spark, sf_dir), topic="topic_id")
    fields = [fv.SAMPLE_FIELDS[p] for p in fv.POSITIONS]
    lists = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"samples.{f}").alias("texts")) for f in fields])
    flat = rows.select("topic_id", F.inline(lists))
    return flat.select("topic_id", "field", F.posexplode("texts").alias("pos", "text")).select(
        "topic_id", "field", (F.col("pos") + 1).alias("rank"), "text"
    )


def _prompt_sql():
    fields = {"total": "total::VARCHAR", "topic_text": "text"}
    for p in fv.POSITIONS:
        fields[f"{p}_count"] = f"coalesce({p}_n, 0)::VARCHAR"
        fields[f"{p}_pct"] = f"printf('%.1f', coalesce({p}_n, 0) * 100.0::DOUBLE / total)"
        fields[fv.SAMPLE_FIELDS[p]] = f"coalesce({p}_s, '{fv.NO_SAMPLES}')"
    parts = []
    for literal, name, _, _ in Formatter().parse(fv.PROMPT):
        parts.append("'" + literal.replace("'", "''") + "'")
        if name:
            parts.append(fields[name])
    bullet = "'  - ' || CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END"
    texts = ", ".join(
        f"string_agg({bullet}, chr(10) ORDER BY rank) FILTER (predicted_type = '{p}') AS {p}_s" for p in fv.POSITIONS
    )
    counts = ", ".join(f"count(*) FILTER (predicted_type = '{p}') AS {p}_n" for p in fv.POSITIONS)
    return f"""WITH {SAMPLES_SQL}, {TOPICS_SQL},
s AS (SELECT topic_id, {texts} FROM samples GROUP BY topic_id),
c AS (SELECT topic_id, count(*) AS total, {counts} FROM classified GROUP BY topic_id)
SELECT topic_id, {' || '.join(parts)} AS prompt
FROM topics JOIN c USING (topic_id) LEFT JOIN s USING (topic_id)"""


@query("topic_prompt", _prompt_sql())
def topic_prompt(spark, sf_dir):
    rows = analysis.topic_analysis(classified(spark, sf_dir), topic="topic_id")
    return analysis.topic_prompt(topics(spark, sf_dir), rows)


SUMMARY_SQL = f"""{weights_sql()},
first AS (
  SELECT * FROM (SELECT source AS topic_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank
    FROM documents) WHERE rank <= 10),
raw AS (
  SELECT topic_id, rank, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos
  FROM (SELECT topic_id, rank, list_filter(list_transform(regexp_extract_all(text, '[^.!?\\n]+[.!?]*'),
    lambda x: regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')), lambda x: x <> '') AS s FROM first)),
st AS (
  SELECT topic_id, rank, pos, {bucket_sql('w')} AS bucket, count(*) AS tf
  FROM (SELECT topic_id, rank, pos, unnest(regexp_extract_all(lower(sentence), '\\p{{L}}+')) AS w FROM raw) GROUP BY ALL),
sw AS (SELECT topic_id, rank, pos, bucket, tf * idf AS w FROM st JOIN idf USING (bucket)),
tv AS (SELECT topic_id, bucket, sum(w) AS t FROM sw GROUP BY ALL),
tn AS (SELECT topic_id, sqrt(sum(t * t)) AS norm FROM tv GROUP BY topic_id),
sd AS (SELECT topic_id, rank, pos, sum(w * t) AS dot, sqrt(sum(w * w)) AS own FROM sw JOIN tv USING (topic_id, bucket) GROUP BY ALL),
ss AS (SELECT topic_id, rank, pos, CASE WHEN own * norm > 0 THEN round(dot / (own * norm), 9) ELSE 0 END AS score FROM sd JOIN tn USING (topic_id)),
sc AS (
  SELECT r.*, coalesce(score, 0) AS score, len(regexp_extract_all(sentence, '[^{SPACE}]+')) AS words
  FROM raw r LEFT JOIN ss USING (topic_id, rank, pos)),
run AS (SELECT *, sum(words) OVER (PARTITION BY topic_id ORDER BY score DESC, rank, pos ROWS UNBOUNDED PRECEDING) AS upto FROM sc),
summary AS (
  SELECT topic_id, string_agg(sentence, ' ' ORDER BY rank, pos) AS summary FROM run
  WHERE upto <= 150 OR upto - words < 50 GROUP BY topic_id)"""


@query("topic_summary", f"WITH {SUMMARY_SQL} SELECT topic_id, summary FROM summary")
def topic_summary(spark, sf_dir):
    docs = opinions(spark, sf_dir)
    return summarise_topics(docs, TfIdfEncoder.fit(docs, dim=DIM), "topic_id")


def _conclusion_counts(p):
    return f"CASE WHEN status = 'ok' THEN {p}_n END AS {p}_count"


CONCLUSIONS_SQL = f"""{CLASSIFIED_SQL}, {TOPICS_SQL}, {SUMMARY_SQL},
c AS (SELECT topic_id, count(*) AS total, avg(type_confidence) AS conf,
  {', '.join(f"count(*) FILTER (predicted_type = '{p}') AS {p}_n" for p in fv.POSITIONS)} FROM classified GROUP BY topic_id),
all_topics AS (
  SELECT topic_id, text FROM topics UNION ALL SELECT 'item ' || item_id, text FROM benchmark),
j AS (
  SELECT *, CASE WHEN total IS NULL THEN 'no_data' WHEN summary IS NULL THEN 'error' ELSE 'ok' END AS status
  FROM all_topics LEFT JOIN c USING (topic_id) LEFT JOIN summary USING (topic_id)),
conclusions AS (
  SELECT topic_id, text AS topic_text,
    CASE status WHEN 'no_data' THEN '{fv.NO_DATA}' WHEN 'error' THEN '{fv.ERROR_PREFIX}{NO_SENTENCE.replace("'", "''")}' ELSE summary END AS generated_conclusion,
    coalesce(total, 0) AS opinion_count, {', '.join(_conclusion_counts(p) for p in fv.POSITIONS)},
    CASE WHEN status = 'ok' THEN round(conf, 6) END AS avg_confidence, status
  FROM j)"""


def conclusion_topics(spark, sf_dir):
    """The topics of the documents, and the benchmark texts as topics without opinions."""
    items = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("topic_id"), "text"
    )
    return topics(spark, sf_dir).select("topic_id", "text").unionByName(items)


def _conclusions(spark, sf_dir, **options):
    rows = classified(spark, sf_dir)
    encoder = TfIdfEncoder.fit(rows, dim=DIM)
    out = generate_conclusions(rows, conclusion_topics(spark, sf_dir), encoder, "topic_id", **options)
    return rounded(out, "avg_confidence")


@query("conclusions", f"WITH {CONCLUSIONS_SQL} SELECT * FROM conclusions")
def conclusions(spark, sf_dir):
    """Conclusions written to a table, which is read back."""
    path = fresh_path(spark, "conclusions") + ".parquet"
    _conclusions(spark, sf_dir, output_path=path)
    return rounded(spark.read.parquet(path), "avg_confidence")


@query(
    "topic_result",
    f"""WITH {CONCLUSIONS_SQL}
SELECT topic_id, topic_text, generated_conclusion AS conclusion, opinion_count AS total_opinions,
  CASE WHEN opinion_count > 0 THEN claim_count END AS claims, avg_confidence FROM conclusions""",
)
def result_of_topic(spark, sf_dir):
    folded = analysis.fold_counts(analysis.position_counts(classified(spark, sf_dir), "topic_id"))
    rows = topic_result(conclusion_topics(spark, sf_dir), folded, _conclusions(spark, sf_dir))
    claims = F.when(F.col("total_opinions") > 0, analysis.count_of("claim"))
    return rounded(rows.withColumn("claims", claims).drop("position_distribution"), "avg_confidence")


@query(
    "opinion_lookup",
    f"""WITH {CONCLUSIONS_SQL},
tops AS (SELECT source, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rn FROM documents) WHERE rn = 1),
dots AS (
  SELECT a.doc_id, sum(a.w * b.w) AS dot FROM documents d JOIN tops t USING (source)
  JOIN vec a ON a.doc_id = d.doc_id JOIN vec b ON b.doc_id = t.doc_id AND b.bucket = a.bucket GROUP BY 1),
ids AS (SELECT DISTINCT doc_id FROM vec),
sims AS (
  SELECT d.doc_id, round(coalesce(dot, 0), 9) AS s FROM documents d JOIN tops t USING (source)
  JOIN ids i ON i.doc_id = d.doc_id JOIN ids j ON j.doc_id = t.doc_id LEFT JOIN dots ON dots.doc_id = d.doc_id),
asked AS (SELECT opinion_id::VARCHAR AS opinion_id FROM opinions UNION SELECT 'unknown ' || lang FROM documents)
SELECT a.opinion_id, c.topic_id AS matched_topic_id, t.text AS topic_text, s::FLOAT AS topic_similarity,
  c.predicted_type AS predicted_position, c.type_confidence::FLOAT AS position_confidence,
  n.generated_conclusion AS conclusion, c.opinion_id IS NOT NULL AS is_processed
FROM asked a LEFT JOIN classified c ON c.opinion_id::VARCHAR = a.opinion_id LEFT JOIN sims ON sims.doc_id = c.opinion_id
LEFT JOIN topics t ON t.topic_id = c.topic_id LEFT JOIN conclusions n ON n.topic_id = c.topic_id""",
)
def opinion_lookup(spark, sf_dir):
    """The results of all documents by id, and of ids that were never scored.

    The similarity is that of a text and the text of its topic; position, confidence and
    conclusion are those of the classifier and of the conclusions.
    """
    docs = classified(spark, sf_dir)
    encoder = TfIdfEncoder.fit(docs, dim=DIM)
    coded = settled(encoder(docs).drop("text", "type"), "scored-opinions")
    known = topics(spark, sf_dir)
    told = encoder(known).select("topic_id", F.col("vector").alias("right_vector"))
    pairs = coded.withColumnRenamed("vector", "left_vector").join(told, "topic_id", "left")
    scored = pair_similarity(pairs, dim=DIM).select(
        F.col("opinion_id").cast("string").alias("opinion_id"),
        F.col("topic_id").alias("matched_topic_id"),
        F.col("similarity").cast("float").alias("topic_similarity"),
        F.col("predicted_type").alias("predicted_position"),
        F.col("type_confidence").cast("float").alias("position_confidence"),
    )
    others = table(spark, sf_dir, "documents").select(F.concat(F.lit("unknown "), "lang")).distinct()
    asked = scored.select("opinion_id").union(others)
    return opinion_results(asked, scored, known, _conclusions(spark, sf_dir))
