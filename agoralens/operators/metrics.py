"""Evaluation tables from true and predicted labels.

Everything is derived from the confusion counts, whose size is the square of the number of
classes. Labels are the union of the true and the predicted ones. A missing prediction is a miss
for its true label and no class of its own; a missing true label counts against the prediction.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Rows per pair of true and predicted label."""
    return df.groupBy(F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label")).agg(
        F.count("*").alias("count")
    )


def confusion_matrix(df: DataFrame, true: str, predicted: str, labels) -> DataFrame:
    """One row per true label and one column per predicted label."""
    counts = confusion_counts(df, true, predicted)
    return (
        counts.groupBy("true_label")
        .pivot("predicted_label", list(labels))
        .agg(F.sum("count"))
        .fillna(0)
    )


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _per_class(df, true, predicted):
    counts = confusion_counts(df, true, predicted)
    same = F.col("true_label").eqNullSafe(F.col("predicted_label"))
    # Each count speaks once for its true label and once for its predicted label.
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("true_label").alias("label"),
                    F.col("count").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(same, F.col("count")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("predicted_label").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("count").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        )
    )
    sums = sides.filter("label is not null").groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return sums.select(
        "label",
        "support",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def _weighted(c):
    return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))


def classification_metrics(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Accuracy and the weighted and macro precision, recall and F1 in one row."""
    names = ("precision", "recall", "f1")
    return _per_class(df, true, predicted).agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[_weighted(c).alias(f"{c}_weighted") for c in names],
        *[F.avg(c).alias(f"{c}_macro") for c in names],
    )


def classification_report(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted rows."""
    classes = _per_class(df, true, predicted)
    names = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    accuracy = _ratio(F.sum("hits"), F.sum("support"))
    summary = {
        "accuracy": [accuracy.alias(c) for c in names],
        "macro avg": [F.avg(c).alias(c) for c in names],
        "weighted avg": [_weighted(c).alias(c) for c in names],
    }
    out = classes.select(F.lit("class").alias("kind"), "label", *names, "support")
    for label, columns in summary.items():
        row = classes.agg(*columns, total)
        out = out.unionByName(row.select(F.lit("summary").alias("kind"), F.lit(label).alias("label"), *names, "support"))
    return out


def accuracy(df: DataFrame, true: str, predicted: str) -> DataFrame:
    same = F.coalesce(F.col(true) == F.col(predicted), F.lit(False))
    return df.agg(F.avg(same.cast("int")).alias("accuracy"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights, rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("count"))
    total = counts.agg(F.struct(F.sum("count").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.withColumn("t", total).select(
        label, "count", (F.col("t.n") / (F.col("t.k") * F.col("count"))).alias("weight")
    )


def distribution_compare(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Rows per label before and after classification, by label."""
    sides = F.array(
        F.struct(F.col(true).alias("label"), F.lit(1).alias("o"), F.lit(0).alias("p")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).alias("o"), F.lit(1).alias("p")),
    )
    return (
        df.select(F.inline(sides))
        .filter("label is not null")
        .groupBy("label")
        .agg(F.sum("o").alias("original_count"), F.sum("p").alias("predicted_count"))
        .orderBy("label")
    )


def run_summary(classified: DataFrame, validation: DataFrame, true: str, predicted: str) -> DataFrame:
    """Total rows, validation accuracy, weighted and macro F1, number of classes."""
    metrics = classification_metrics(validation, true, predicted).agg(
        F.first(F.struct("accuracy", "f1_weighted", "f1_macro"))
    )
    return (
        classified.agg(F.count("*").alias("total"), F.count_distinct(true).alias("classes"))
        .withColumn("m", metrics.scalar())
        .select("total", "classes", "m.accuracy", "m.f1_weighted", "m.f1_macro")
    )
