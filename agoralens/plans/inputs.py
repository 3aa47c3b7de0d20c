"""The given tables in the roles of the engine, and the same roles as SQL.

Opinions are ``documents``: the source is the topic, the language decides the position.
Topics by text are one row per source with its shortest text, or ``benchmark``. Topics by
vector are the mean vector of each label in ``embeddings``.
"""

import os

from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.text import tokens
from agoralens.operators.match import is_correct
from agoralens.session import settled
from agoralens.sources.tables import spread_small

SPACE = fv.SPACE_CLASS
DIM = 4096
POSITION_OF = {"en": "claim", "fr": "evidence", "de": "counterclaim", "es": "rebuttal"}
# Function words by which the rule below tells the language of a text.
WORDS = {
    "en": ("the", "and", "of", "to", "that", "in"),
    "fr": ("le", "les", "et", "des", "la", "dans"),
    "de": ("der", "die", "und", "das", "den", "von"),
    "es": ("el", "los", "que", "y", "las", "por"),
}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark, sf_dir, name):
    """A table as a file stream; a single file is picked out of its folder by name."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if "://" not in path and os.path.isfile(path):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def documents(spark, sf_dir):
    """The documents for work on whole texts."""
    return spread_small(table(spark, sf_dir, "documents"))


def _position(lang):
    out = None
    for code, position in POSITION_OF.items():
        out = F.when(lang == code, position) if out is None else out.when(lang == code, position)
    return out.otherwise("unknown")


def opinions(spark, sf_dir):
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("opinion_id"),
        F.col("source").alias("topic_id"),
        "text",
        _position(F.col("lang")).alias("type"),
    )


def topics(spark, sf_dir):
    """One row per source: its shortest text, the lowest id among equals."""
    docs = table(spark, sf_dir, "documents")
    shortest = docs.groupBy("source").agg(F.min(F.struct("n_chars", "doc_id")).alias("s"))
    rows = docs.join(shortest.select("s.doc_id"), "doc_id")
    return rows.select(F.col("source").alias("id"), F.col("source").alias("topic_id"), "text", F.col("lang").alias("type"))


def rule_classify(df):
    """Position and confidence from counts of function words: (most + 1) / (all + 4)."""
    listed = [w for words in WORDS.values() for w in words]
    found = df.withColumn("_w", F.filter(tokens(F.col("text")), lambda w: w.isin(*listed)))

    def hits(code):
        return F.size(F.filter("_w", lambda w: w.isin(*WORDS[code])))

    counted = found.withColumn("_h", F.struct(*[hits(c).alias(c) for c in WORDS]))
    most = F.greatest(*[F.col(f"_h.{c}") for c in WORDS])
    total = sum((F.col(f"_h.{c}") for c in WORDS), F.lit(0))
    best = F.when(most == 0, "none")
    for code in WORDS:
        best = best.when(F.col(f"_h.{code}") == most, code)
    return counted.withColumns(
        {"predicted_type": _position(best), "type_confidence": (most + 1) / (total + 4)}
    ).drop("_w", "_h")


def classified(spark, sf_dir):
    """The classified opinions. They are not stored: a query reads the columns that it needs."""
    return rule_classify(opinions(spark, sf_dir))


def vector_opinions(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("opinion_id"),
        F.col("label").cast("string").alias("topic_id"),
        F.col("embedding").alias("vector"),
    )


def label_topics(spark, sf_dir):
    """The mean vector of each label as a topic, in a stored vector table."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "m")))
    vectors = means.groupBy("label").agg(F.transform(ordered, lambda p: p["m"]).alias("vector"))
    label = F.col("label").cast("string")
    points = vectors.select(
        label.alias("point_id"),
        label.alias("topic_id"),
        F.concat(F.lit("label "), label).alias("topic_text"),
        "vector",
    )
    return settled(points, "label-topics")


def flag_correct(matches):
    return matches.withColumn("is_correct", is_correct("matched_topic_id", "topic_id"))


# --- the same roles as SQL ----------------------------------------------------------------


def _case(column):
    whens = " ".join(f"WHEN '{c}' THEN '{p}'" for c, p in POSITION_OF.items())
    return f"CASE {column} {whens} ELSE 'unknown' END"


def _hit_sql(code):
    words = ", ".join(f"'{w}'" for w in WORDS[code])
    return f"len(list_filter(t, lambda w: w IN ({words})))"


OPINIONS_SQL = f"""opinions AS (
  SELECT doc_id AS opinion_id, source AS topic_id, text, {_case('lang')} AS type FROM documents)"""
TOPICS_SQL = """topics AS (
  SELECT source AS topic_id, text, lang AS type FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rn FROM documents)
  WHERE rn = 1)"""
_MOST = "greatest(en, fr, de, es)"
_BEST = " ".join(f"WHEN {c} = {_MOST} THEN '{p}'" for c, p in POSITION_OF.items())
CLASSIFIED_SQL = f"""{OPINIONS_SQL},
hits AS (
  SELECT *, {', '.join(f'{_hit_sql(c)} AS {c}' for c in WORDS)}
  FROM (SELECT *, regexp_extract_all(lower(text), '\\p{{L}}+') AS t FROM opinions)),
classified AS (
  SELECT opinion_id, topic_id, text, type,
    CASE WHEN {_MOST} = 0 THEN 'unknown' {_BEST} END AS predicted_type,
    ({_MOST} + 1)::DOUBLE / (en + fr + de + es + 4) AS type_confidence
  FROM hits)"""
LABEL_TOPICS_SQL = """parts AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
label_topics AS (
  SELECT label::VARCHAR AS topic_id, list(m ORDER BY pos) AS v
  FROM (SELECT label, pos, avg(x) AS m FROM parts GROUP BY label, pos) GROUP BY label)"""
HITS_SQL = f"""{LABEL_TOPICS_SQL},
scored AS (
  SELECT e.vec_id AS opinion_id, e.label::VARCHAR AS true_topic, t.topic_id,
    round(list_cosine_similarity(e.embedding::DOUBLE[], t.v), 9) AS score
  FROM embeddings e, label_topics t),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY opinion_id ORDER BY score DESC, topic_id) AS rank FROM scored)"""
MATCHED_SQL = f"""{HITS_SQL},
matched AS (
  SELECT opinion_id::VARCHAR AS opinion_id, true_topic AS topic_id, topic_id AS matched_topic_id,
    score AS similarity_score, score >= 0.5 AS confidence, topic_id = true_topic AS is_correct
  FROM hits WHERE rank = 1)"""


def weights_sql(dim=DIM):
    """Bucket weights of the documents: ``idf(bucket, idf)`` and ``corpus(n)``."""
    return f"""tok AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w FROM documents),
tf AS (
  SELECT doc_id, {bucket_sql('w', dim)} AS bucket, count(*) AS tf FROM tok GROUP BY ALL),
corpus AS (SELECT count(*) AS n FROM documents),
idf AS (
  SELECT bucket, ln((any_value(n) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM tf, corpus GROUP BY bucket),
dw AS (SELECT doc_id, bucket, tf * idf AS w FROM tf JOIN idf USING (bucket)),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dw GROUP BY doc_id),
vec AS (SELECT doc_id, bucket, w / norm AS w FROM dw JOIN dn USING (doc_id) WHERE norm > 0)"""


def bucket_sql(word, dim=DIM):
    return f"(('0x' || substr(md5({word}), 1, 7))::BIGINT % {dim})::INTEGER"
