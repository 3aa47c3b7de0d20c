"""Explicit schemas. Ids are always strings, so that no id is read as a number."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


TOPICS = _strings("id", "topic_id", "text", "type")
OPINIONS = _strings("opinion_id", "topic_id", "text", "type", "effectiveness")
CONCLUSIONS = _strings("topic_id", "text", "type")

TEXT_COUNTS = [
    T.StructField("text_length", T.IntegerType()),
    T.StructField("word_count", T.IntegerType()),
]
TOPICS_CLEAN = T.StructType(TOPICS.fields + TEXT_COUNTS)
OPINIONS_CLEAN = T.StructType(OPINIONS.fields + TEXT_COUNTS)
CONCLUSIONS_CLEAN = T.StructType(CONCLUSIONS.fields + TEXT_COUNTS)

OPINIONS_MATCHED = T.StructType(
    OPINIONS.fields
    + [
        T.StructField("matched_topic_id", T.StringType()),
        T.StructField("similarity_score", T.DoubleType()),
        T.StructField("is_correct", T.BooleanType()),
    ]
)
OPINIONS_CLASSIFIED = T.StructType(
    OPINIONS_MATCHED.fields
    + [
        T.StructField("predicted_type", T.StringType()),
        T.StructField("type_confidence", T.DoubleType()),
    ]
)
GENERATED_CONCLUSIONS = T.StructType(
    _strings("topic_id", "topic_text", "generated_conclusion").fields
    + [
        T.StructField(n, T.LongType())
        for n in (
            "opinion_count",
            "claim_count",
            "evidence_count",
            "counterclaim_count",
            "rebuttal_count",
        )
    ]
    + [T.StructField("avg_confidence", T.DoubleType())]
)
TRAINING_HISTORY = T.StructType(
    [T.StructField("epoch", T.IntegerType())]
    + [
        T.StructField(n, T.DoubleType())
        for n in ("train_loss", "train_accuracy", "val_loss", "val_accuracy")
    ]
)
SUBMITTED_OPINION = T.StructType(
    _strings("opinion_id", "text", "user_id").fields
    + [T.StructField("timestamp", T.LongType())]
)
