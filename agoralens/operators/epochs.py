"""Multinomial regression trained epoch by epoch, with the history of every epoch.

The built-in regression takes no start and tells only its objective, so the loop is written here.
A step is one job: each task adds up the gradient of its rows on Arrow batches, the sums are merged by
feature, and the driver gets one row for each feature. An epoch takes one step for each slice of the
training rows, then reads the validation rows once. Steps adapt to each coefficient (AdaGrad).

Coefficients and their sums of squared gradients are written after every epoch. A run that starts
from them goes on where they end, as if it had never stopped.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens import fixed_values as fv
from agoralens.functions.lookup import one_row_map
from agoralens.functions.vectors import SCORE_DIGITS
from agoralens.operators.metrics import class_weights
from agoralens.operators.split import stratified_split
from agoralens.schemas import TRAINING_HISTORY
from agoralens.session import fresh_path

BIAS, SUMMARY = -1, -2  # numbers of rows that are not features
LEAST = 1e-15
SMOOTH = 1e-8
COEFFICIENTS = "epoch int, label string, feature int, weight double, squares double"


class EpochRun(NamedTuple):
    """``coefficients`` after each epoch, ``history`` with a row for each, and the split."""

    coefficients: DataFrame
    history: DataFrame
    split: DataFrame


class Weights(NamedTuple):
    """One column for each label, one row for each feature, the bias last."""

    labels: list
    weight: np.ndarray
    squares: np.ndarray

    @classmethod
    def zero(cls, labels, dim):
        return cls(list(labels), np.zeros((dim + 1, len(labels))), np.zeros((dim + 1, len(labels))))

    @property
    def dim(self):
        return len(self.weight) - 1

    def moved(self, gradient, rate, penalty):
        """The weights after a step against the mean gradient; the bias is not penalised."""
        gradient = gradient + penalty * self.weight
        gradient[-1] -= penalty * self.weight[-1]
        squares = self.squares + gradient**2
        return Weights(self.labels, self.weight - rate * gradient / np.sqrt(squares + SMOOTH), squares)

    def table(self, epoch):
        """The written form, features without a weight left out."""
        feature, label = np.nonzero((self.weight != 0) | (self.squares != 0))
        return pa.table(
            {
                "epoch": pa.array(np.full(len(feature), epoch), pa.int32()),
                "label": pa.array(np.array(self.labels, object)[label], pa.string()),
                "feature": pa.array(np.where(feature == self.dim, BIAS, feature), pa.int32()),
                "weight": self.weight[feature, label],
                "squares": self.squares[feature, label],
            }
        )


def read_weights(coefficients: DataFrame, labels, dim: int, epoch=None):
    """The weights after ``epoch``, else after the last one, and the number of that epoch.

    A table without rows, or no table, gives zero weights and epoch 0.
    """
    out = Weights.zero(labels, dim)
    if coefficients is None:
        return out, 0
    epoch = epoch or coefficients.agg(F.max("epoch")).first()[0] or 0
    # One row for each feature and label at most.
    rows = coefficients.filter(F.col("epoch") == epoch).toPandas()
    unknown = set(rows["label"]) - set(labels)
    if unknown or (rows["feature"] >= dim).any():
        raise ValueError(f"the coefficients are of another task: {sorted(unknown)}")
    column = rows["label"].map({name: i for i, name in enumerate(labels)}).to_numpy(np.int64)
    feature = rows["feature"].to_numpy(np.int64)
    feature = np.where(feature == BIAS, dim, feature)
    out.weight[feature, column], out.squares[feature, column] = rows["weight"], rows["squares"]
    return out, epoch


def _entries(batch, indices="f", values="x"):
    """Row, feature and value of each entry of a batch; null lists are empty."""
    f, x = batch.column(indices), batch.column(values)
    sizes = np.where(f.is_valid(), np.diff(f.offsets.to_numpy()), 0)
    rows = np.repeat(np.arange(len(f)), sizes)
    return rows, f.flatten().to_numpy().astype(np.int64), x.flatten().to_numpy().astype(np.float64)


def _probabilities(weight, rows, features, values, count):
    """The share of each label for each row."""
    logits = np.tile(weight[-1], (count, 1))
    for k in range(weight.shape[1]):
        logits[:, k] += np.bincount(rows, weights=values * weight[features, k], minlength=count)
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _chosen(p):
    """The first of the labels with the largest share; shares tie whatever the order of a sum."""
    return np.round(p, SCORE_DIGITS).argmax(axis=1)


def _sums(sent, learn, columns):
    """Sums over the rows of a task: loss, weight, hits and rows, and the gradient if asked for."""

    def run(batches):
        model = sent.value
        gradient, summary = np.zeros_like(model.weight), np.zeros(4)
        for batch in batches:
            count = batch.num_rows
            rows, features, values = _entries(batch)
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            p = _probabilities(model.weight, rows, features, values, count)
            loss = -np.log(np.maximum(p[np.arange(count), y], LEAST))
            summary += [(loss * w).sum(), w.sum(), (_chosen(p) == y).sum(), count]
            if learn:
                p[np.arange(count), y] -= 1
                p *= w[:, None]
                for k in range(p.shape[1]):
                    gradient[:-1, k] += np.bincount(features, weights=p[rows, k] * values, minlength=model.dim)
                gradient[-1] += p.sum(axis=0)
        met = np.flatnonzero(gradient.any(axis=1))
        out = np.zeros((len(met) + 1, len(columns)))
        out[:-1, : gradient.shape[1]], out[-1, :4] = gradient[met], summary
        at = np.append(np.where(met == model.dim, BIAS, met), SUMMARY)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), *[pa.array(c) for c in out.T.copy()]], names=["f", *columns]
        )

    return run


def _pass(rows, model, learn):
    """One job over some rows: the summary and the gradient's sum."""
    columns = [f"c{k}" for k in range(max(4, len(model.labels)))]
    sent = rows.sparkSession.sparkContext.broadcast(model)  # labels x features numbers
    kinds = "f int, " + ", ".join(f"{c} double" for c in columns)
    parts = rows.select("f", "x", "y", "w").mapInArrow(_sums(sent, learn, columns), kinds)
    merged = parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()  # a row for each feature
    sent.destroy()
    gradient, summary = np.zeros_like(model.weight), np.zeros(4)
    values, at = merged[columns].to_numpy(), merged["f"].to_numpy()
    for row in values[at == SUMMARY]:
        summary = row[:4]
    known = at != SUMMARY
    gradient[np.where(at[known] == BIAS, model.dim, at[known])] = values[known][:, : gradient.shape[1]]
    return summary, gradient


def train_epochs(
    df: DataFrame,
    dim: int,
    epochs=5,
    steps=1,
    label="type",
    id_col="opinion_id",
    vector="vector",
    share=fv.SPLIT_SHARE,
    seed=fv.SPLIT_SEED,
    rate=0.5,
    penalty=1e-4,
    start: DataFrame | None = None,
    path: str | None = None,
) -> EpochRun:
    """Train on sparse ``vector`` columns, ``STRUCT<indices, values>`` below ``dim``.

    The split is that of ``stratified_split``, training rows have balanced class weights. An epoch
    takes ``steps`` steps, each over the rows of one hash range of the ids, which is a folder of the
    stored rows. Its train loss and accuracy are those met on the way, before each step; validation
    loss and accuracy are taken at its end. The train loss is weighted, the validation loss is not;
    both are means over rows. A row with a null vector has no feature, rows with a null label take
    no part; without a training row the history is empty.

    ``start`` holds the coefficients of an earlier run over the same labels; epochs are numbered on
    from its last one. Coefficients are written under ``path``, one folder for each epoch.
    """
    spark = df.sparkSession
    path = (path or fresh_path(spark, "coefficients")).rstrip("/")
    stored = fresh_path(spark, "epoch-rows")
    rows = stratified_split(df.select(id_col, F.col(label).alias("_label"), vector), "_label", id_col, share, seed)
    number = F.when(F.col("is_validation"), -1).otherwise(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(steps)))
    rows = rows.select(
        id_col,
        "_label",
        F.col(vector).getField("indices").cast("array<int>").alias("f"),
        F.col(vector).getField("values").cast("array<double>").alias("x"),
        number.cast("int").alias("slice"),
    )
    rows.write.partitionBy("slice").parquet(stored)
    schema = T.StructType([*rows.drop("slice").schema.fields, T.StructField("slice", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(stored)
    split = rows.select(id_col, F.col("_label").alias(label), (F.col("slice") < 0).alias("is_validation"))

    train = rows.filter("slice >= 0")
    weights = class_weights(train, "_label").select("_label", "weight")
    labels = sorted(r["_label"] for r in weights.collect())  # one row for each class
    code = F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i)]) if labels else None
    history = []
    if labels:
        coded = rows.withColumn("y", F.try_element_at(code, F.col("_label")))
        coded = coded.filter("y is not null")  # a class may have validation rows only if its share is 1
        plain = coded.filter("slice < 0").withColumn("w", F.lit(1.0))
        coded = coded.withColumn("w", one_row_map(weights, "_label", "weight")[F.col("_label")])
        model, done = read_weights(start, labels, dim)
        for epoch in range(done + 1, done + epochs + 1):
            met = np.zeros(4)
            for number in range(steps):
                summary, gradient = _pass(coded.filter(F.col("slice") == number), model, True)
                met += summary
                if summary[1]:
                    model = model.moved(gradient / summary[1], rate, penalty)
            held, _ = _pass(plain, model, False)
            spark.createDataFrame(model.table(epoch)).coalesce(1).write.mode("overwrite").parquet(f"{path}/{epoch}")
            history.append((epoch, *_means(met), *_means(held)))
    written = [f"{path}/{h[0]}" for h in history]
    coefficients = spark.read.schema(COEFFICIENTS).parquet(*written) if written else spark.createDataFrame([], COEFFICIENTS)
    return EpochRun(coefficients, spark.createDataFrame(history, TRAINING_HISTORY), split)


def _means(summary):
    loss, weight, hits, rows = summary.tolist()
    return (loss / weight, hits / rows) if rows else (None, None)


def with_positions(df: DataFrame, coefficients: DataFrame, labels, dim: int, vector="vector", epoch=None) -> DataFrame:
    """``df`` with ``predicted_type``, ``type_confidence`` and ``probabilities`` in label order.

    Scored by the coefficients after ``epoch``, else the last one. A null vector is one without a
    feature, so its row gets the shares that the bias gives.
    """
    labels = sorted(labels)
    model, _ = read_weights(coefficients, labels, dim, epoch)
    sent = df.sparkSession.sparkContext.broadcast(model)
    rows = df.withColumns(
        {
            "_f": F.col(vector).getField("indices").cast("array<int>"),
            "_x": F.col(vector).getField("values").cast("array<double>"),
        }
    )
    kept = df.columns
    names = [*kept, "predicted_type", "type_confidence", "probabilities"]

    def run(batches):
        for batch in batches:
            p = _probabilities(sent.value.weight, *_entries(batch, "_f", "_x"), batch.num_rows)
            best = _chosen(p)
            offsets = pa.array(np.arange(len(p) + 1) * len(labels), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(np.array(labels, object)[best], pa.string()),
                    pa.array(p[np.arange(len(p)), best]),
                    pa.ListArray.from_arrays(offsets, pa.array(p.ravel())),
                ],
                names=names,
            )

    more = T.StructType.fromDDL("predicted_type string, type_confidence double, probabilities array<double>")
    return rows.mapInArrow(run, T.StructType([*df.schema.fields, *more.fields]))
