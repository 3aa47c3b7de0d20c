"""Cleaning of the three input tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions.text import with_text_counts
from agoralens.sources.tables import Tables


def long_enough(df: DataFrame, text="text", min_length=fv.MIN_TEXT_LENGTH) -> DataFrame:
    """Rows with text counts added and short or null texts removed."""
    return with_text_counts(df.filter(F.length(text) >= min_length), text)


def with_known_topic(opinions: DataFrame, topics: DataFrame, key="topic_id") -> DataFrame:
    """Opinions whose topic is among the topics; a null key matches a null key.

    Only distinct keys are sent to the join. Adaptive execution broadcasts them when their
    measured size allows it and else splits the partition of a hot topic.
    """
    keys = topics.select(F.col(key).alias("_key")).distinct()
    return opinions.join(keys, opinions[key].eqNullSafe(F.col("_key")), "left_semi")


def clean_tables(topics: DataFrame, conclusions: DataFrame, opinions: DataFrame) -> Tables:
    """Long enough topics, long enough opinions on those topics, all conclusions."""
    clean_topics = long_enough(topics)
    return Tables(
        topics=clean_topics,
        conclusions=with_text_counts(conclusions),
        opinions=with_known_topic(long_enough(opinions), clean_topics),
    )
