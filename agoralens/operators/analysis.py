"""Per-topic analysis of classified opinions: counts, shares, samples, prompt text."""

from string import Formatter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.text import bullet_list, normal_label, percent_text
from agoralens.session import settled


def first_ids(rows: DataFrame, keys, n, id_col="opinion_id") -> DataFrame:
    """The first n ids per key with their ``rank``; each task keeps at most n per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(id_col)
    return rows.select(*keys, id_col).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def first_texts(df: DataFrame, keys, n, id_col="opinion_id", text="text", where=None) -> DataFrame:
    """The first n texts per key in id order, with their ``rank``.

    Only keys and ids are ranked. The texts of the few ids that are left are fetched by a join on
    the unique id.
    """
    rows = df.filter(F.col(text).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    ranked = first_ids(rows, keys, n, id_col)
    return df.select(id_col, text).join(ranked, id_col).select(*keys, id_col, text, "rank")


def stored_positions(df, topic="matched_topic_id", label="predicted_type", id_col="opinion_id") -> DataFrame:
    """Topic, position, id and confidence of each opinion, and whether it has a text, stored.

    Counts and samples both read them. Stored once, a classifier behind them runs once; a filter
    on the position would else be pushed below it with a copy of its whole expression.
    """
    confidence = F.col("type_confidence") if "type_confidence" in df.columns else F.lit(None).cast("double")
    rows = df.select(
        F.col(topic).alias("topic_id"),
        normal_label(F.col(label)).alias("position"),
        F.col(id_col).alias("id"),
        confidence.alias("type_confidence"),
        F.col("text").isNotNull().alias("has_text"),
    )
    return settled(rows, "positions")


def position_counts(df: DataFrame, topic="matched_topic_id", label="predicted_type") -> DataFrame:
    """Rows, confidence sum and confidence count per topic and position."""
    return (
        df.filter(F.col(topic).isNotNull())
        .groupBy(F.col(topic).alias("topic_id"), normal_label(F.col(label)).alias("position"))
        .agg(
            F.count("*").alias("count"),
            F.sum("type_confidence").alias("confidence_sum"),
            F.count("type_confidence").alias("confidence_count"),
        )
    )


def fold_counts(counts: DataFrame) -> DataFrame:
    """Position counts of a topic folded into maps, with total and mean confidence.

    A null position counts in the total but not in the maps. A topic has as many rows here
    as the classifier has labels.
    """
    known = F.when(F.col("position").isNotNull(), F.struct("position", "count"))
    folded = counts.groupBy("topic_id").agg(
        F.sum("count").alias("total_opinions"),
        F.map_from_entries(F.array_sort(F.collect_list(known))).alias("position_distribution"),
        (F.sum("confidence_sum") / F.nullif(F.sum("confidence_count"), F.lit(0))).alias("avg_confidence"),
    )
    return folded.select(
        "topic_id",
        "total_opinions",
        "position_distribution",
        F.transform_values(
            "position_distribution", lambda _, n: n * 100.0 / F.col("total_opinions")
        ).alias("position_percentages"),
        "avg_confidence",
    )


def topic_samples(df, topic="matched_topic_id", label="predicted_type", id_col="opinion_id") -> DataFrame:
    """The sample texts of each topic: one array per position."""
    return _samples(stored_positions(df, topic, label, id_col), df.select(F.col(id_col).alias("id"), "text"))


def _samples(positions, texts):
    most = max(fv.SAMPLE_LIMITS.values())
    wanted = F.col("position").isin(*fv.POSITIONS) & F.col("topic_id").isNotNull() & F.col("has_text")
    first = first_ids(positions.filter(wanted), ("topic_id", "position"), most, "id")
    first = texts.join(first, "id")

    def sample(position):
        hit = (F.col("position") == position) & (F.col("rank") <= fv.SAMPLE_LIMITS[position])
        ranked = F.array_sort(F.collect_list(F.when(hit, F.struct("rank", "text"))))
        return F.transform(ranked, lambda s: s["text"]).alias(fv.SAMPLE_FIELDS[position])

    arrays = first.groupBy("topic_id").agg(*[sample(p) for p in fv.POSITIONS])
    return arrays.select("topic_id", F.struct(*[fv.SAMPLE_FIELDS[p] for p in fv.POSITIONS]).alias("samples"))


def topic_analysis(df, topic="matched_topic_id", label="predicted_type", id_col="opinion_id") -> DataFrame:
    """One row per topic: total, position maps, sample texts, mean confidence."""
    positions = stored_positions(df, topic, label, id_col)
    folded = fold_counts(position_counts(positions, "topic_id", "position"))
    samples = _samples(positions, df.select(F.col(id_col).alias("id"), "text"))
    joined = folded.join(samples, "topic_id", "left")
    none = F.struct(
        *[F.array().cast("array<string>").alias(fv.SAMPLE_FIELDS[p]) for p in fv.POSITIONS]
    )
    return joined.withColumn("samples", F.coalesce("samples", none))


def count_of(position):
    """The count of one position in the distribution map, 0 where it is missing."""
    return F.coalesce(F.try_element_at("position_distribution", F.lit(position)), F.lit(0))


def topic_prompt(topics: DataFrame, analysis: DataFrame, id_cols=("topic_id",)) -> DataFrame:
    """The prompt text of every topic that has opinions."""
    fields = {"total": F.col("total_opinions").cast("string"), "topic_text": F.col("text")}
    for p in fv.POSITIONS:
        share = F.coalesce(F.try_element_at("position_percentages", F.lit(p)), F.lit(0.0))
        fields[f"{p}_count"] = count_of(p).cast("string")
        fields[f"{p}_pct"] = percent_text(share)
        fields[fv.SAMPLE_FIELDS[p]] = bullet_list(F.col("samples")[fv.SAMPLE_FIELDS[p]])
    parts = []
    for literal, name, _, _ in Formatter().parse(fv.PROMPT):
        parts.append(F.lit(literal))
        if name:
            parts.append(F.coalesce(fields[name], F.lit("")))
    return topics.join(analysis, "topic_id").select(*id_cols, F.concat(*parts).alias("prompt"))
