"""Toxicity by a character n-gram linear classifier on naive Bayes log-count ratios.

A feature says whether an n-gram is in the text, scaled by the log ratio of its document
frequencies among toxic and clean training texts. A logistic regression learns one weight for each
scaled feature. N-grams that are rare or say little, by a likelihood-ratio test, are left out, so
the score of a text looks only at the few n-grams that the model kept, and texts of any length are
read whole.

Fitted on a bounded sample: the ``sample`` labelled rows with the smallest hash of their id. The
sample's counts come from the executors; the driver gets the kept n-grams and, for the sample's
rows, which of these they hold.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agoralens.llm.common import held_out, portions, wider
from agoralens.llm.ngrams import all_grams
from agoralens.session import settled

ORDERS = (4, 5, 6)
BUCKET_BITS = 20
SAMPLE = 12000
LEAST_DOCS = 3
LEAST_RATIO = 1.0
LEAST_GAIN = 14.0
EPOCHS = 5


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    kept: np.ndarray
    threshold: float = 0.3

    def score(self, text):
        """Between 0 and 1, higher for texts that are more likely toxic. Null is the empty text."""
        hits = all_grams(text or "", ORDERS, BUCKET_BITS)
        hits = np.unique(hits[self.kept[hits]])
        z = self.bias + float(self.weights[hits].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def labelled_sample(docs, labels, divisor=4, sample=SAMPLE, id_col="doc_id", text_col="text", label_col="toxic"):
    """``(_id, y, text)`` of the sample, stored. Rows with a null id, label or text take no part.

    A repeated label counts once, and the larger one holds; of rows with one id the first text in
    order counts.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col, divisor))
    ids = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("text is not null")
    # At most `sample` pairs of numbers: the broadcast has a fixed bound.
    rows = texts.join(F.broadcast(ids), "_id").groupBy("_id", "y").agg(F.min("text").alias("text"))
    return settled(rows, "toxicity-sample")


def _document_counts(batches):
    """How many toxic and clean texts of this task hold each n-gram."""
    counts = np.zeros((2, 1 << BUCKET_BITS), np.int32)
    for batch in portions(batches):
        for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
            counts[y, np.unique(all_grams(text, ORDERS, BUCKET_BITS))] += 1
    found = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found), pa.array(counts[1, found]), pa.array(counts[0, found])], names=["g", "toxic", "clean"]
    )


def _kept_features(kept):
    def run(batches):
        for batch in portions(batches):
            found = [
                np.unique(g[kept[g]]).astype(np.int32)
                for g in (all_grams(t, ORDERS, BUCKET_BITS) for t in batch.column("text").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").cast(pa.string()), batch.column("y"), pa.array(found, pa.list_(pa.int32()))],
                names=["_id", "y", "f"],
            )

    return run


def train(docs, labels, threshold=0.3, **options) -> ToxicityModel:
    """Fit on a labelled sample; ``options`` go to ``labelled_sample``.

    Without a toxic or without a clean row, the score of any text is the share of toxic rows.
    """
    rows = labelled_sample(docs, labels, **options)
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    nothing = np.zeros(1 << BUCKET_BITS, np.float32)
    if not toxic or not clean:
        return ToxicityModel(nothing, 30.0 if toxic else -30.0, nothing.astype(bool), threshold)

    ratio = F.log((F.col("toxic") + 1) / (toxic + 2)) - F.log((F.col("clean") + 1) / (clean + 2))
    counted = rows.mapInArrow(_document_counts, "g int, toxic int, clean int").groupBy("g")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n, share = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)

    def gain(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    tested = 2 * (gain(F.col("toxic"), n * share) + gain(F.col("clean"), n * (1 - share)))
    telling = counted.where((n >= LEAST_DOCS) & (tested >= LEAST_GAIN)).select("g", ratio.alias("r"))
    telling = telling.where(F.abs("r") >= LEAST_RATIO).toPandas()
    ratios = nothing.copy()
    ratios[telling["g"]] = telling["r"]
    kept = ratios != 0
    found = rows.mapInArrow(_kept_features(kept), "_id string, y int, f array<int>").collect()
    weights, bias = _regress(sorted(found, key=lambda r: (r["_id"], r["y"], r["f"])), ratios, toxic / (toxic + clean))
    return ToxicityModel((weights * ratios).astype(np.float32), bias, kept, threshold)


def _regress(rows, ratios, share):
    """Logistic regression on the scaled features, by gradient steps that adapt per feature."""
    weights = np.zeros(len(ratios))
    seen = np.full(len(ratios), 1e-6)
    bias = float(np.log(share / (1 - share)))
    shuffled = np.random.default_rng(7)
    features = [np.array(r["f"], np.int64) for r in rows]
    for _ in range(EPOCHS):
        for i in shuffled.permutation(len(rows)):
            f = features[i]
            z = bias + (weights[f] * ratios[f]).sum()
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - rows[i]["y"]
            slope = error * ratios[f] + 1e-4 * weights[f]
            seen[f] += slope * slope
            weights[f] -= 0.3 * slope / np.sqrt(seen[f])
            bias -= 0.02 * error
    return weights, bias


def with_toxicity(docs, model, text_col="text", score_name="score", label_name="predicted"):
    """``docs`` with the score and the predicted class of each text; columns of these names go.

    Null and empty texts are scored like any text without a known n-gram.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kept = [c for c in docs.columns if c not in (score_name, label_name)]
    rows = docs.select(*[docs[c] for c in kept])

    def run(batches):
        scorer = sent.value
        for batch in portions(batches):
            scores = np.array([scorer.score(t.as_py()) for t in batch.column(text_col)], np.float64)
            labels = (scores >= scorer.threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array(labels)], names=[*kept, score_name, label_name]
            )

    return rows.mapInArrow(run, wider(rows.schema, **{score_name: "double", label_name: "int"}))


def toxicity(docs, labels, divisor=4, threshold=0.3, **options):
    """Train on ``labels`` and score all of ``docs``: its columns, ``score`` and ``predicted``.

    Only rows whose id has another remainder than 2 modulo ``divisor`` are learned from.
    """
    return with_toxicity(docs, train(docs, labels, threshold, divisor=divisor, **options))


