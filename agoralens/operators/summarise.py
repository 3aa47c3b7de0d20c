"""Extractive summary: the sentences of a topic that are closest to its texts as a whole."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.text import sentences, word_count
from agoralens.operators.analysis import first_texts
from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.match import pair_similarity


def topic_sentences(df, topic, n_texts=fv.SUMMARY_TEXTS, id_col="opinion_id") -> DataFrame:
    """Sentences of the first texts of each topic: topic_id, rank, pos, sentence."""
    rows = df.select(F.col(topic).alias("topic_id"), id_col, "text").filter("topic_id is not null")
    first = first_texts(rows, ("topic_id",), n_texts, id_col)
    return first.select("topic_id", "rank", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence"))


def sentence_scores(parts: DataFrame, encoder: TfIdfEncoder) -> DataFrame:
    """Cosine of each sentence with all sentences of its topic as one text.

    A topic has the sentences of few texts here. A sentence without weight has a null score.
    """
    in_order = F.array_sort(F.collect_list(F.struct("rank", "pos", "sentence")))
    whole = parts.groupBy("topic_id").agg(
        F.array_join(F.transform(in_order, lambda s: s["sentence"]), " ").alias("text")
    )
    topic_vectors = encoder(whole).select("topic_id", F.col("vector").alias("right_vector"))
    vectors = encoder(parts, "sentence").withColumnRenamed("vector", "left_vector")
    pairs = pair_similarity(vectors.join(topic_vectors, "topic_id"), dim=encoder.dim)
    return pairs.select(*parts.columns, F.col("similarity").alias("score"))


def summarise_topics(
    df: DataFrame,
    encoder: TfIdfEncoder,
    topic="matched_topic_id",
    id_col="opinion_id",
    n_texts=fv.SUMMARY_TEXTS,
    max_words=fv.SUMMARY_MAX_WORDS,
    min_words=fv.SUMMARY_MIN_WORDS,
) -> DataFrame:
    """``topic_id`` and ``summary``: the best sentences within the word budget, in text order.

    A sentence is taken while the total with it is within ``max_words``, or while the total
    before it is under ``min_words``. A topic without a sentence has no row.
    """
    parts = topic_sentences(df, topic, n_texts, id_col)
    scored = sentence_scores(parts, encoder).select(
        *parts.columns,
        F.coalesce("score", F.lit(0.0)).alias("score"),
        word_count(F.col("sentence")).alias("words"),
    )
    best_first = Window.partitionBy("topic_id").orderBy(F.desc("score"), "rank", "pos")
    upto = F.sum("words").over(best_first.rowsBetween(Window.unboundedPreceding, 0))
    chosen = scored.withColumn("upto", upto).filter(
        (F.col("upto") <= max_words) | (F.col("upto") - F.col("words") < min_words)
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", "pos", "sentence")))
    return chosen.groupBy("topic_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["sentence"]), " ").alias("summary")
    )
