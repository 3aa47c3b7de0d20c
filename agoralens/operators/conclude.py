"""One conclusion row per topics row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.operators.analysis import count_of, fold_counts, position_counts
from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.summarise import summarise_topics
from agoralens.sources.tables import write_table

NO_SENTENCE = "no sentence in the opinions of the topic"


def generate_conclusions(
    opinions: DataFrame,
    topics: DataFrame,
    encoder: TfIdfEncoder,
    topic_col="matched_topic_id",
    label="predicted_type",
    id_col="opinion_id",
    output_path: str | None = None,
) -> DataFrame:
    """Counts, mean confidence, summary and ``status`` for each row of ``topics``.

    ``status`` is ``ok``, ``no_data`` for a topic without opinions, or ``error`` where no
    summary can be built. A topic id that repeats in ``topics`` gives one row each time.
    """
    folded = fold_counts(position_counts(opinions, topic_col, label))
    summaries = summarise_topics(opinions, encoder, topic_col, id_col)
    joined = (
        topics.select("topic_id", F.col("text").alias("topic_text"))
        .join(folded, "topic_id", "left")
        .join(summaries, "topic_id", "left")
    )
    total, summary = F.col("total_opinions"), F.col("summary")
    status = (
        F.when(total.isNull(), "no_data").when(summary.isNull(), "error").otherwise("ok")
    )
    text = (
        F.when(F.col("status") == "no_data", fv.NO_DATA)
        .when(F.col("status") == "error", fv.ERROR_PREFIX + NO_SENTENCE)
        .otherwise(summary)
    )
    ok = F.col("status") == "ok"
    out = joined.withColumn("status", status).select(
        "topic_id",
        "topic_text",
        text.alias("generated_conclusion"),
        F.coalesce(total, F.lit(0)).alias("opinion_count"),
        *[F.when(ok, count_of(p)).alias(f"{p}_count") for p in fv.POSITIONS],
        F.when(ok, F.col("avg_confidence")).alias("avg_confidence"),
        "status",
    )
    if output_path:
        write_table(out, output_path)
    return out


def opinion_results(asked, scored, topics, conclusions) -> DataFrame:
    """The full result of each asked opinion id: match, position, topic text, conclusion.

    ``is_processed`` is false for an id that has not been scored. Topic texts and conclusions
    are reduced to one row per topic id first, so that no opinion is multiplied. Adaptive
    execution broadcasts these sides when their measured size allows it and else splits the
    partition of a hot topic.
    """
    text = topics.groupBy(F.col("topic_id").alias("matched_topic_id")).agg(F.min("text").alias("topic_text"))
    conclusion = conclusions.groupBy(F.col("topic_id").alias("matched_topic_id")).agg(
        F.min_by("generated_conclusion", F.struct("topic_text", "generated_conclusion")).alias("conclusion")
    )
    found = scored.withColumn("is_processed", F.lit(True))
    return (
        asked.select("opinion_id")
        .join(found, "opinion_id", "left")
        .join(text, "matched_topic_id", "left")
        .join(conclusion, "matched_topic_id", "left")
        .select(
            "opinion_id",
            "matched_topic_id",
            "topic_text",
            "topic_similarity",
            "predicted_position",
            "position_confidence",
            "conclusion",
            F.coalesce("is_processed", F.lit(False)).alias("is_processed"),
        )
    )


def topic_result(topics: DataFrame, folded: DataFrame, conclusions: DataFrame) -> DataFrame:
    """Topic id, text, conclusion, total, position map and mean confidence."""
    text = topics.groupBy("topic_id").agg(F.min("text").alias("topic_text"))
    conclusion = conclusions.groupBy("topic_id").agg(
        F.min_by("generated_conclusion", F.struct("topic_text", "generated_conclusion")).alias("conclusion")
    )
    return (
        text.join(conclusion, "topic_id", "left")
        .join(folded, "topic_id", "left")
        .select(
            "topic_id",
            "topic_text",
            "conclusion",
            F.coalesce("total_opinions", F.lit(0)).alias("total_opinions"),
            "position_distribution",
            "avg_confidence",
        )
    )
