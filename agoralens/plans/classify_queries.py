"""Queries: labels, split, metrics and the trained classifier."""

from pyspark.sql import functions as F

from agoralens.operators import classify as clf
from agoralens.operators import metrics
from agoralens.operators.split import stratified_split
from agoralens.plans.inputs import CLASSIFIED_SQL, POSITION_OF, WORDS, classified, opinions, table
from agoralens.plans.registry import query
from agoralens.session import fresh_path
from agoralens.sources.model_store import load_model, save_model, write_history


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "class_weights",
    """WITH c AS (SELECT lang, count(*) AS count FROM documents GROUP BY lang)
SELECT lang, count, round((SELECT sum(count) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * count), 6) AS weight FROM c""",
)
def class_weights(spark, sf_dir):
    return rounded(metrics.class_weights(table(spark, sf_dir, "documents"), "lang"), "weight")


@query(
    "label_encode",
    """WITH c AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS id FROM (SELECT DISTINCT lang FROM documents))
SELECT doc_id, lang, id::DOUBLE AS label_id, lang AS label FROM documents JOIN c USING (lang)""",
)
def label_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    encoder = clf.label_encoder(docs, "lang")
    return clf.label_decoder(encoder).transform(encoder.transform(docs)).select("doc_id", "lang", "label_id", "label")


@query(
    "stratified_split",
    """SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id))
  <= round(count(*) OVER (PARTITION BY lang) * 0.2::DOUBLE) AS is_validation FROM documents""",
)
def split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return stratified_split(docs, "lang", "doc_id")


@query(
    "predicted_positions",
    f"""WITH {CLASSIFIED_SQL}
SELECT opinion_id, topic_id, type, predicted_type, round(type_confidence, 6) AS type_confidence FROM classified""",
)
def predicted_positions(spark, sf_dir):
    return rounded(classified(spark, sf_dir).drop("text"), "type_confidence")


@query(
    "confusion",
    f"""WITH {CLASSIFIED_SQL}
SELECT type AS true_label, predicted_type AS predicted_label, count(*) AS count FROM classified GROUP BY ALL""",
)
def confusion(spark, sf_dir):
    return metrics.confusion_counts(classified(spark, sf_dir), "type", "predicted_type")


MATRIX_LABELS = (*POSITION_OF.values(), "unknown")


@query(
    "confusion_matrix",
    f"""WITH {CLASSIFIED_SQL}
SELECT type AS true_label, {', '.join(f"count(*) FILTER (predicted_type = '{p}') AS {p}" for p in MATRIX_LABELS)}
FROM classified GROUP BY type""",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(classified(spark, sf_dir), "type", "predicted_type", MATRIX_LABELS)


PER_CLASS_SQL = f"""{CLASSIFIED_SQL},
names AS (SELECT DISTINCT type AS label FROM classified UNION SELECT DISTINCT predicted_type FROM classified),
sums AS (
  SELECT label, count(*) FILTER (type = label) AS support, count(*) FILTER (predicted_type = label) AS predicted,
    count(*) FILTER (type = label AND predicted_type = label) AS hits FROM names, classified GROUP BY label),
per_class AS (
  SELECT label, support, hits, coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS precision,
    coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall,
    coalesce(2.0::DOUBLE * hits / nullif(predicted + support, 0), 0) AS f1 FROM sums)"""
NAMES = ("precision", "recall", "f1")
# The same over the rows that the split holds out.
VALIDATION_SQL = PER_CLASS_SQL.replace("classified AS (", "whole AS (").replace(
    "\nnames AS (",
    """
marked AS (
  SELECT *, row_number() OVER (PARTITION BY type ORDER BY md5('42:' || opinion_id))
    <= round(count(*) OVER (PARTITION BY type) * 0.2::DOUBLE) AS is_validation FROM whole),
classified AS (SELECT * FROM marked WHERE is_validation),
names AS (""",
)


def _avg_sql(c):
    return f"avg({c})"


def _weighted_sql(c):
    return f"sum({c} * support) / sum(support)"


@query(
    "metrics",
    f"""WITH {PER_CLASS_SQL}
SELECT round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy,
  {', '.join(f'round({_weighted_sql(c)}, 6) AS {c}_weighted, round({_avg_sql(c)}, 6) AS {c}_macro' for c in NAMES)} FROM per_class""",
)
def all_metrics(spark, sf_dir):
    df = metrics.classification_metrics(classified(spark, sf_dir), "type", "predicted_type")
    return rounded(df, *df.columns)


def _summary_sql(label, parts):
    return f"""SELECT 'summary', '{label}', {', '.join(f'round({p}, 6)' for p in parts)}, sum(support)::BIGINT FROM per_class"""


@query(
    "class_report",
    f"""WITH {PER_CLASS_SQL}
SELECT 'class' AS kind, label, {', '.join(f'round({c}, 6) AS {c}' for c in NAMES)}, support FROM per_class UNION ALL
{_summary_sql('accuracy', ['sum(hits)::DOUBLE / sum(support)'] * 3)} UNION ALL
{_summary_sql('macro avg', [_avg_sql(c) for c in NAMES])} UNION ALL
{_summary_sql('weighted avg', [_weighted_sql(c) for c in NAMES])}""",
)
def class_report(spark, sf_dir):
    df = metrics.classification_report(classified(spark, sf_dir), "type", "predicted_type")
    return rounded(df, *NAMES)


@query(
    "accuracy",
    f"WITH {CLASSIFIED_SQL} SELECT round(avg((type = predicted_type)::INTEGER), 6) AS accuracy FROM classified",
)
def accuracy(spark, sf_dir):
    return rounded(metrics.accuracy(classified(spark, sf_dir), "type", "predicted_type"), "accuracy")


@query(
    "distribution_compare",
    f"""WITH {CLASSIFIED_SQL}
SELECT coalesce(a.l, b.l) AS label, coalesce(a.n, 0) AS original_count, coalesce(b.n, 0) AS predicted_count
FROM (SELECT type AS l, count(*) AS n FROM classified GROUP BY 1) a
FULL JOIN (SELECT predicted_type AS l, count(*) AS n FROM classified GROUP BY 1) b ON a.l = b.l""",
)
def distribution_compare(spark, sf_dir):
    return metrics.distribution_compare(classified(spark, sf_dir), "type", "predicted_type")


@query(
    "run_summary",
    f"""WITH {VALIDATION_SQL}
SELECT (SELECT count(*) FROM whole) AS total, (SELECT count(DISTINCT type) FROM whole) AS classes,
  round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy, round({_weighted_sql('f1')}, 6) AS f1_weighted,
  round(avg(f1), 6) AS f1_macro FROM per_class""",
)
def run_summary(spark, sf_dir):
    """Metrics on the fifth of each class that the split holds out."""
    df = classified(spark, sf_dir)
    split = stratified_split(df.select("opinion_id", "type"), "type", "opinion_id")
    held = df.join(split.filter("is_validation").select("opinion_id"), "opinion_id")
    return rounded(
        metrics.run_summary(df, held, "type", "predicted_type"), "accuracy", "f1_weighted", "f1_macro"
    )


VOCABULARY = sorted({w for words in WORDS.values() for w in words})
# Naive Bayes in closed form: class sums with one added, and the posterior of every opinion.
def _bayes_sql(weight):
    """``bayes``: the posterior of every opinion, with the weight of a training row of each class."""
    return f"""{CLASSIFIED_SQL},
marked AS (
  SELECT *, row_number() OVER (PARTITION BY type ORDER BY md5('42:' || opinion_id))
    <= round(count(*) OVER (PARTITION BY type) * 0.2::DOUBLE) AS is_validation FROM classified),
vocabulary AS (SELECT unnest([{', '.join(f"'{w}'" for w in VOCABULARY)}]) AS word),
words AS (
  SELECT opinion_id, word, count(*) AS n FROM (
    SELECT opinion_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM opinions)
  SEMI JOIN vocabulary USING (word) GROUP BY ALL),
train AS (SELECT * FROM marked WHERE NOT is_validation),
weights AS (
  SELECT type, (SELECT count(*) FROM train)::DOUBLE / ((SELECT count(DISTINCT type) FROM train) * count(*)) AS w
  FROM train GROUP BY type),
prior AS (
  SELECT type, ln((sum({weight}) + 1) / (sum(sum({weight})) OVER () + count(*) OVER ())) AS pi
  FROM train JOIN weights USING (type) GROUP BY type),
sums AS (
  SELECT p.type, v.word, coalesce(sum(n * {weight}), 0) AS s FROM prior p CROSS JOIN vocabulary v
  LEFT JOIN (SELECT * FROM train JOIN weights USING (type) JOIN words USING (opinion_id)) t
    ON t.type = p.type AND t.word = v.word GROUP BY ALL),
theta AS (
  SELECT type, word, ln((s + 1) / (sum(s) OVER (PARTITION BY type) + {len(VOCABULARY)})) AS theta FROM sums),
logs AS (
  SELECT m.opinion_id, p.type AS class, any_value(pi) + coalesce(sum(n * theta), 0) AS l
  FROM marked m CROSS JOIN prior p LEFT JOIN words w ON w.opinion_id = m.opinion_id
  LEFT JOIN theta t ON t.type = p.type AND t.word = w.word GROUP BY ALL),
shares AS (
  SELECT opinion_id, class, exp(l - max(l) OVER o) / sum(exp(l - m)) OVER o AS p
  FROM (SELECT *, max(l) OVER (PARTITION BY opinion_id) AS m FROM logs) WINDOW o AS (PARTITION BY opinion_id)),
bayes AS (
  SELECT opinion_id, m.type, is_validation, arg_max(class, p) AS predicted, max(p) AS confidence,
    -ln(greatest(max(p) FILTER (class = m.type), 1e-15)) AS loss
  FROM marked m JOIN shares USING (opinion_id) GROUP BY ALL)"""


def _bayes(spark, sf_dir, **options):
    return clf.train_bayes(opinions(spark, sf_dir), VOCABULARY, **options)


@query(
    "bayes_predict",
    f"""WITH {_bayes_sql('1')}
SELECT opinion_id, type, predicted AS predicted_type, round(confidence, 6) AS type_confidence FROM bayes""",
)
def bayes_predict(spark, sf_dir):
    """Predictions of a saved and restored naive Bayes model for all documents."""
    path = fresh_path(spark, "bayes")
    save_model(_bayes(spark, sf_dir, balanced=False).model, path)
    rows = clf.predict(load_model(path), opinions(spark, sf_dir))
    return rounded(rows.select("opinion_id", "type", "predicted_type", "type_confidence"), "type_confidence")


@query(
    "bayes_balanced",
    f"WITH {_bayes_sql('w')} SELECT opinion_id, is_validation, round(confidence, 6) AS type_confidence FROM bayes",
)
def bayes_balanced(spark, sf_dir):
    """The part of each document in the split, and its confidence by a model with class weights."""
    trained = _bayes(spark, sf_dir)
    rows = clf.predict(trained.model, opinions(spark, sf_dir)).join(trained.split.drop("type"), "opinion_id")
    return rounded(rows.select("opinion_id", "is_validation", "type_confidence"), "type_confidence")


@query(
    "bayes_history",
    f"""WITH {_bayes_sql('1')}
SELECT 1 AS epoch, round(sum(loss * w) FILTER (NOT is_validation) / sum(w) FILTER (NOT is_validation), 6) AS train_loss,
  round(avg((type = predicted)::INTEGER) FILTER (NOT is_validation), 6) AS train_accuracy,
  round(avg(loss) FILTER (is_validation), 6) AS val_loss,
  round(avg((type = predicted)::INTEGER) FILTER (is_validation), 6) AS val_accuracy
FROM bayes JOIN weights USING (type)""",
)
def bayes_history(spark, sf_dir):
    """Loss and accuracy of both parts, written and read back."""
    path = fresh_path(spark, "history")
    write_history(_bayes(spark, sf_dir, balanced=False).history, path)
    return rounded(spark.read.parquet(path), "train_loss", "train_accuracy", "val_loss", "val_accuracy")


def _train(spark, sf_dir):
    return clf.train_classifier(opinions(spark, sf_dir), max_iter=10)


@query("train_predict")
def train_predict(spark, sf_dir):
    """Every document with the position and confidence of a classifier trained on four fifths."""
    trained = _train(spark, sf_dir)
    rows = clf.predict(trained.model, opinions(spark, sf_dir))
    narrow = rows.select("opinion_id", "predicted_type", F.round("type_confidence", 4).alias("type_confidence"))
    return trained.split.join(narrow, "opinion_id")


@query("training_history")
def training_history(spark, sf_dir):
    """Loss and accuracy of both parts, written and read back."""
    path = fresh_path(spark, "history")
    write_history(_train(spark, sf_dir).history, path)
    return spark.read.parquet(path)


@query("training_objective")
def training_objective(spark, sf_dir):
    return clf.objective_history(_train(spark, sf_dir).model)


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Predictions of a saved and restored model for all documents."""
    path = fresh_path(spark, "model")
    save_model(_train(spark, sf_dir).model, path)
    return clf.predict(load_model(path), opinions(spark, sf_dir)).select("opinion_id", "predicted_type")


@query("quality_classifier")
def quality_classifier(spark, sf_dir):
    """A harder class: the quality label, joined to its document; metrics of the held-out part."""
    labelled = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("opinion_id"), "text", F.col("quality").cast("string").alias("type")
    )
    trained = clf.train_classifier(labelled, max_iter=10)
    scored = clf.predict(trained.model, labelled).select("opinion_id", "predicted_type")
    held = trained.split.filter("is_validation").join(scored, "opinion_id")
    return metrics.classification_report(held, "type", "predicted_type")


@query(
    "token_counts",
    """SELECT doc_id, len(regexp_extract_all(lower(text), '\\p{L}+'))::INTEGER AS tokens FROM documents""",
)
def token_counts(spark, sf_dir):
    """Tokens of each whole text, as the classifier reads it."""
    stage = clf.text_stages()[0]
    return stage.transform(table(spark, sf_dir, "documents")).select("doc_id", F.size("_tokens").alias("tokens"))


