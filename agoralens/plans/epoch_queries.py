"""Queries: training epoch by epoch, its history and its coefficients."""

from pyspark.sql import functions as F

from agoralens.functions.text import tokens
from agoralens.operators.epochs import train_epochs, with_positions
from agoralens.plans.classify_queries import VOCABULARY, rounded
from agoralens.plans.inputs import OPINIONS_SQL, opinions
from agoralens.plans.registry import query
from agoralens.session import fresh_path
from agoralens.sources.model_store import write_history

EPOCHS, RATE, PENALTY = 3, 0.5, 1e-4


def listed_words(df, words=VOCABULARY):
    """``df`` with ``vector``, the unit vector of the counts of some words; null without any."""

    def count(word):
        return F.size(F.filter("_w", lambda w: w == word))

    found = df.withColumn("_w", F.filter(tokens(F.col("text")), lambda w: w.isin(*words)))
    found = found.withColumn("_n", F.array(*[count(w) for w in words]))
    found = found.withColumn("_l", F.sqrt(F.aggregate("_n", F.lit(0.0), lambda a, n: a + n * n)))
    vector = F.struct(
        F.sequence(F.lit(0), F.lit(len(words) - 1)).alias("indices"),
        F.transform("_n", lambda n: n / F.col("_l")).alias("values"),
    )
    return found.withColumn("vector", F.when(F.col("_l") > 0, vector)).drop("_w", "_n", "_l")


def _epoch_sql(e):
    """The shares by the weights after epoch ``e``, what they give, and the weights after the next."""
    return f"""logits{e} AS (
  SELECT opinion_id, class, sum(v * w) AS l FROM x JOIN w{e} USING (feature) GROUP BY ALL),
exps{e} AS (SELECT opinion_id, class, exp(l - max(l) OVER (PARTITION BY opinion_id)) AS ex FROM logits{e}),
p{e} AS MATERIALIZED (
  SELECT opinion_id, class, ex / sum(ex) OVER (PARTITION BY opinion_id) AS p FROM exps{e}),
met{e} AS MATERIALIZED (
  SELECT opinion_id, m.type, is_validation, wt, -ln(greatest(max(p) FILTER (class = m.type), 1e-15)) AS loss,
    (list(class ORDER BY round(p, 9) DESC, class))[1] AS predicted,
    (list(p ORDER BY round(p, 9) DESC, class))[1] AS confidence
  FROM marked m JOIN weights USING (type) JOIN p{e} USING (opinion_id) GROUP BY ALL),
g{e} AS (
  SELECT class, feature, sum((p - (class = type)::INTEGER) * wt * v) / (SELECT sum(wt) FROM train) AS g
  FROM train JOIN p{e} USING (opinion_id) JOIN x USING (opinion_id) GROUP BY ALL),
step{e} AS (
  SELECT class, feature, w, s, coalesce(g, 0) + CASE WHEN feature = '' THEN 0 ELSE {PENALTY}::DOUBLE * w END AS g
  FROM w{e} LEFT JOIN g{e} USING (class, feature)),
w{e + 1} AS MATERIALIZED (
  SELECT class, feature, w - {RATE}::DOUBLE * g / sqrt(s + g * g + 1e-8::DOUBLE) AS w, s + g * g AS s FROM step{e})"""


EPOCHS_SQL = f"""{OPINIONS_SQL},
marked AS MATERIALIZED (
  SELECT opinion_id, type, row_number() OVER (PARTITION BY type ORDER BY md5('42:' || opinion_id))
    <= round(count(*) OVER (PARTITION BY type) * 0.2::DOUBLE) AS is_validation FROM opinions),
vocabulary AS (SELECT unnest([{', '.join(f"'{w}'" for w in VOCABULARY)}]) AS word),
words AS (
  SELECT opinion_id, word, count(*) AS n FROM (
    SELECT opinion_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM opinions)
  SEMI JOIN vocabulary USING (word) GROUP BY ALL),
x AS MATERIALIZED (
  SELECT opinion_id, word AS feature, n / sqrt((sum(n * n) OVER (PARTITION BY opinion_id))::DOUBLE) AS v FROM words
  UNION ALL SELECT opinion_id, '', 1 FROM opinions),
weights AS (
  SELECT type, (SELECT count(*) FROM marked WHERE NOT is_validation)::DOUBLE
    / ((SELECT count(DISTINCT type) FROM marked WHERE NOT is_validation) * count(*)) AS wt
  FROM marked WHERE NOT is_validation GROUP BY type),
train AS (SELECT * FROM marked JOIN weights USING (type) WHERE NOT is_validation),
w0 AS (
  SELECT type AS class, feature, 0::DOUBLE AS w, 0::DOUBLE AS s
  FROM weights, (SELECT word AS feature FROM vocabulary UNION ALL SELECT '')),
{', '.join(_epoch_sql(e) for e in range(EPOCHS + 1))}"""


def _row_sql(e):
    return f"""SELECT {e} AS epoch,
  (SELECT round(sum(loss * wt) / sum(wt), 6) FROM met{e - 1} WHERE NOT is_validation) AS train_loss,
  (SELECT round(avg((type = predicted)::INTEGER), 6) FROM met{e - 1} WHERE NOT is_validation) AS train_accuracy,
  (SELECT round(avg(loss), 6) FROM met{e} WHERE is_validation) AS val_loss,
  (SELECT round(avg((type = predicted)::INTEGER), 6) FROM met{e} WHERE is_validation) AS val_accuracy"""


def _trained(spark, sf_dir):
    """Two epochs, then one more from the coefficients that they wrote: rows, coefficients, histories."""
    rows = listed_words(opinions(spark, sf_dir)).select("opinion_id", "type", "vector")
    options = {"rate": RATE, "penalty": PENALTY, "path": fresh_path(spark, "coefficients")}
    first = train_epochs(rows, len(VOCABULARY), epochs=EPOCHS - 1, **options)
    second = train_epochs(rows, len(VOCABULARY), epochs=1, start=first.coefficients, **options)
    return rows, second.coefficients, [first.history, second.history]


@query("epoch_history", f"WITH {EPOCHS_SQL}\n" + "\nUNION ALL ".join(map(_row_sql, range(1, EPOCHS + 1))))
def epoch_history(spark, sf_dir):
    """Train and validation loss and accuracy of each epoch, over a stop and a new start, written and read."""
    _, _, parts = _trained(spark, sf_dir)
    path = fresh_path(spark, "history")
    write_history(parts[0].unionByName(parts[1]), path)
    return rounded(spark.read.parquet(path), "train_loss", "train_accuracy", "val_loss", "val_accuracy")


@query(
    "epoch_coefficients",
    f"""WITH {EPOCHS_SQL}
SELECT {EPOCHS} AS epoch, class AS label, feature AS word, round(w, 6) AS weight FROM w{EPOCHS} WHERE s > 1e-20""",
)
def epoch_coefficients(spark, sf_dir):
    """The written coefficients after the last epoch; the word of the bias is empty."""
    _, coefficients, _ = _trained(spark, sf_dir)
    rows = coefficients.filter("squares > 1e-20")
    word = F.when(F.col("feature") < 0, "").otherwise(F.try_element_at(F.array(*map(F.lit, VOCABULARY)), F.col("feature") + 1))
    return rows.select("epoch", "label", word.alias("word"), F.round("weight", 6).alias("weight"))


@query(
    "epoch_predict",
    f"""WITH {EPOCHS_SQL}
SELECT opinion_id, type, predicted AS predicted_type, round(confidence, 6) AS type_confidence FROM met{EPOCHS}""",
)
def epoch_predict(spark, sf_dir):
    """Every document with its position and confidence by the coefficients of the last epoch."""
    rows, coefficients, _ = _trained(spark, sf_dir)
    labels = [r["label"] for r in coefficients.select("label").distinct().collect()]
    scored = with_positions(rows, coefficients, labels, len(VOCABULARY))
    return rounded(scored.select("opinion_id", "type", "predicted_type", "type_confidence"), "type_confidence")
