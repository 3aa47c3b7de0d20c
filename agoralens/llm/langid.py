"""Language identification by sparse multinomial regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader and elastic-net penalties: the L1 part keeps weights of
n-grams that say nothing at exactly zero. Document frequencies are counted on all training texts. A
sample of labelled rows, bounded for each language, is dealt over a fixed number of shards; each
trains on its rows, and the weights are averaged. A part of the sample is kept from training and sets
the temperature that turns logits into honest probabilities.
"""

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agoralens.llm.common import LETTER, held_out, portions, wider
from agoralens.llm.ngrams import all_grams
from agoralens.session import settled

ORDERS = (1, 2, 3)
BUCKET_BITS = 15
SAMPLE = 6000  # rows of each language, about
SHARDS = 4
EPOCHS = 4
CALIBRATE = 6  # one row in so many sets the temperature
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.001
UNKNOWN = "und"


def counts_of(text):
    """The n-gram buckets of a text and how often each occurs."""
    counts = np.bincount(all_grams(text, ORDERS, BUCKET_BITS), minlength=1 << BUCKET_BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def tf_idf(found, counts, idf):
    x = counts * idf[found]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


def soft_max(logits):
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0
    least: float = 0.0  # certain predictions have this share at temperature 1, or more

    def logits(self, found, counts):
        return tf_idf(found, counts, self.idf) @ self.weights[found]

    def told(self, text):
        """Language, probability, and whether the prediction is as certain as on texts of a known language.

        ``und``, 0 and false for null and for texts without a letter.
        """
        if not self.languages or not text or not LETTER.search(text):
            return UNKNOWN, 0.0, False
        logits = self.logits(*counts_of(text))
        p = soft_max(logits / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(soft_max(logits)[best] >= self.least)

    def predict(self, text):
        """The language and its probability; ``und`` and 0 for null and for texts without a letter."""
        return self.told(text)[:2]


class Leader:
    """Follow-the-regularised-leader with one learning rate per weight."""

    def __init__(self, size, classes):
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))

    def weights(self, rows=slice(None)):
        z = self.z[rows]
        rate = (BETA + np.sqrt(self.n[rows])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def learn(self, found, x, label):
        w = self.weights(found)
        error = soft_max(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[found]
        self.z[found] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[found] = n + g * g


def _sparse(languages):
    def run(batches):
        for batch in portions(batches):
            rows = [counts_of(t) for t in batch.column("text").to_pylist()]
            labels = [languages.index(lang) for lang in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part"),
                    pa.array(labels, pa.int32()),
                    pa.array([f.astype(np.int32) for f, _ in rows], pa.list_(pa.int32())),
                    pa.array([c.astype(np.int32) for _, c in rows], pa.list_(pa.int32())),
                ],
                names=["part", "y", "f", "n"],
            )

    return run


def _read(rows):
    """Label, buckets and counts of the rows of an Arrow batch or table."""
    for y, f, n in zip(rows.column("y").to_pylist(), rows.column("f"), rows.column("n")):
        yield y, f.values.to_numpy(), n.values.to_numpy()


def _in_order(rows):
    """Rows by label, number of buckets and bytes. Only rows alike in the first two are turned into bytes at once."""

    def alike(row):
        return row[0], len(row[1])

    for _, same in groupby(sorted(rows, key=alike), alike):
        yield from sorted(same, key=lambda r: (r[1].tobytes(), r[2].tobytes()))


def _train_shard(idf, classes):
    def run(shard):
        rows = list(_in_order((y, f, tf_idf(f, n, idf)) for y, f, n in _read(shard)))
        leader, order = Leader(len(idf), classes), np.random.default_rng(11)
        for _ in range(EPOCHS):
            for i in order.permutation(len(rows)):
                y, f, x = rows[i]
                leader.learn(f, x, y)
        return pa.table({"n": [len(rows)], "w": [leader.weights().astype(np.float32).tobytes()]})

    return run


def _logits(model):
    def run(batches):
        for batch in portions(batches):
            found = [(y, model.logits(f, n)) for y, f, n in _read(batch)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([y for y, _ in found], pa.int32()), pa.array([z for _, z in found], pa.list_(pa.float64()))],
                names=["y", "z"],
            )

    return run


def _frequencies(batches):
    seen = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
    for batch in portions(batches):
        for text in batch.column("text"):
            seen[counts_of(text.as_py())[0]] += 1
            seen[-1] += 1
    found = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(seen[found], pa.int64())], names=["f", "n"])


def inverse_frequencies(texts):
    """The inverse document frequency of each bucket over all ``texts`` with a letter."""
    parts = texts.where(F.col("text").rlike(r"\p{L}")).mapInArrow(_frequencies, "f bigint, n bigint")
    seen = parts.groupBy("f").agg(F.sum("n").alias("n")).toPandas()  # a row for each bucket at most
    frequency = np.zeros((1 << BUCKET_BITS) + 1)
    frequency[seen["f"]] = seen["n"]
    return np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1


def labelled_sample(docs, divisor, sample, id_col, text_col, lang_col):
    """``(lang, text, part)``: about ``sample`` texts with a letter of each language, stored.

    A text is taken if the hash of its id is below a limit, the share of its language's rows that
    ``sample`` is; of a language with fewer rows all are taken. So no language is ranked, however
    frequent it is. Of rows with one id and language the first text in order counts.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("_id is not null and lang is not null").where(~held_out("_id", divisor))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    limits = counts.select("lang", (F.lit(float(sample)) / F.col("n")).alias("share"))
    place = F.shiftrightunsigned(F.xxhash64("_id"), 11) / float(1 << 53)
    chosen = rows.join(F.broadcast(limits), "lang").where(place < F.col("share"))  # a row for each language
    chosen = chosen.groupBy("_id", "lang").agg(F.min("text").alias("text"))
    part = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(SHARDS * CALIBRATE))
    return settled(chosen.select("lang", "text", part.cast("int").alias("part")), "langid-sample")


def train(docs, divisor=4, sample=SAMPLE, id_col="doc_id", text_col="text", lang_col="lang") -> LanguageModel:
    """Fit on about ``sample`` rows of each language (``labelled_sample``).

    Rows whose id has remainder 2 modulo ``divisor`` are not learned from. Without a row to learn
    from, every text is ``und``.
    """
    rows = labelled_sample(docs, divisor, sample, id_col, text_col, lang_col)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    size = 1 << BUCKET_BITS
    if not languages:
        return LanguageModel([], np.zeros(size), np.zeros((size, 0)))

    sparse = rows.mapInArrow(_sparse(languages), "part int, y int, f array<int>, n array<int>")
    sparse = settled(sparse, "langid-features")
    learned = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, divisor))
    idf = inverse_frequencies(learned.select(F.col(text_col).alias("text")))

    learn = sparse.where(F.col("part") >= SHARDS) if len(languages) > 1 else sparse
    shards = learn.groupBy(F.pmod("part", F.lit(SHARDS)))  # a bounded number of rows in each
    trained = shards.applyInArrow(_train_shard(idf, len(languages)), "n long, w binary").collect()
    trained.sort(key=lambda r: (r["n"], r["w"]))
    weights = np.zeros((size, len(languages)))
    for row in trained:
        share = row["n"] / sum(r["n"] for r in trained)
        weights += share * np.frombuffer(row["w"], np.float32).reshape(weights.shape)
    model = LanguageModel(languages, idf, weights)
    held = sparse.where(F.col("part") < SHARDS).mapInArrow(_logits(model), "y int, z array<double>").collect()
    labels, logits = [r["y"] for r in held], np.array([r["z"] for r in held])
    model.temperature = best_temperature(labels, logits)
    model.least = least_certain(labels, logits, len(languages))
    return model


def least_certain(labels, logits, languages):
    """The share at temperature 1 below which a language counts as unknown.

    Half way between chance and the least certain of the right predictions on rows that the model
    did not learn from, so that texts like these stay. The temperature is left out: few rows, all
    of them right, make it so small that every text looks certain. Zero without such a row.
    """
    if not len(labels):
        return 0.0
    p = soft_max(logits)
    right = p.max(axis=1)[p.argmax(axis=1) == np.array(labels)]
    return float((1 / languages + right.min()) / 2) if len(right) else 0.0


def best_temperature(labels, logits):
    """The temperature with the least mean log loss, out of a fine grid. One without rows."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = soft_max(logits / t)[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    return float(min(np.geomspace(0.02, 20, 241), key=loss))


def with_language(docs, model, text_col="text", lang_name="lang_pred", score_name="score", certain_name=None):
    """``docs`` with the predicted language and its probability; columns of these names go.

    ``certain_name`` names a further column: whether the text is of a known language for certain.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size for given languages
    kinds = {lang_name: "string", score_name: "double"} | ({certain_name: "boolean"} if certain_name else {})
    kept = [c for c in docs.columns if c not in kinds]
    rows = docs.select(*[docs[c] for c in kept])

    def run(batches):
        known = sent.value
        for batch in portions(batches):
            found = [known.told(t.as_py()) for t in batch.column(text_col)]
            told = [
                pa.array([lang for lang, _, _ in found], pa.string()),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([certain for _, _, certain in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *told[: len(kinds)]], names=[*kept, *kinds])

    return rows.mapInArrow(run, wider(rows.schema, **kinds))


def language(docs, divisor=4, **options):
    """Train on ``docs`` and add ``lang_pred`` and ``score`` to all of its rows."""
    return with_language(docs, train(docs, divisor, **options))
