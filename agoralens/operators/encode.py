"""Text encoders. An encoder is called as ``encoder(df, text_col)`` and adds ``vector``.

``TfIdfEncoder`` gives sparse unit vectors, ``STRUCT<indices, values>``: tokens are cut by column
functions and counted on Arrow batches. ``model_encoder`` wraps a model that maps a list of texts to dense vectors.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agoralens.functions.text import tokens
from agoralens.functions.vectors import slices

SPARSE = "struct<indices:array<int>,values:array<double>>"
SLICE_WORDS = 1 << 18  # that are counted at once


@lru_cache(maxsize=1 << 16)
def bucket_of(token: str, dim: int) -> int:
    """The vector position of a token: the first 28 bits of its MD5, modulo ``dim``."""
    return int(hashlib.md5(token.encode()).hexdigest()[:7], 16) % dim


def count_buckets(words, dim):
    """Rows, buckets and counts of an Arrow batch of token lists, in row and bucket order."""
    sizes = np.diff(words.offsets.to_numpy())
    sizes = np.where(words.is_valid(), sizes, 0)
    flat = words.flatten().dictionary_encode()
    places = np.array([bucket_of(t, dim) for t in flat.dictionary.to_pylist()], dtype=np.int64)
    codes = flat.indices.to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(words)), sizes)
    keys, counts = np.unique(rows * dim + places[codes], return_counts=True)
    return keys // dim, keys % dim, counts


def word_slices(words):
    """A batch of token lists in parts of bounded size, at least one."""
    sizes = np.where(words.is_valid(), np.diff(words.offsets.to_numpy()), 0) + 1
    for start, stop in slices(sizes, SLICE_WORDS) or [(0, 0)]:
        yield words.slice(start, stop - start)


class TfIdfEncoder:
    """Hashed TF-IDF with a fixed number of buckets.

    Texts are cut into tokens inside the JVM. Counting them per text needs a loop over
    arrays, which Spark interprets element by element, so that part runs on slices of Arrow
    batches. No token leaves its row, so nothing is shuffled. The fitted state is one weight
    per bucket: its size is ``dim`` whatever the corpus.
    """

    def __init__(self, spark: SparkSession, idf):
        self.spark = spark
        self.idf = np.asarray(idf, dtype=np.float64)
        self.dim = len(self.idf)

    @classmethod
    def fit(cls, corpus: DataFrame, text="text", dim=4096) -> "TfIdfEncoder":
        """One pass over the corpus; a batch sends at most ``dim`` + 1 counts."""

        def count(batches):
            for batch in batches:
                texts_with = np.zeros(dim, np.int64)
                for words in word_slices(batch.column("words")):
                    texts_with += np.bincount(count_buckets(words, dim)[1], minlength=dim)
                met = np.flatnonzero(texts_with)
                # Bucket -1 carries the number of texts.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(met, -1).astype(np.int32)),
                        pa.array(np.append(texts_with[met], batch.num_rows).astype(np.int64)),
                    ],
                    names=["bucket", "texts"],
                )

        counts = (
            corpus.select(tokens(F.col(text)).alias("words"))
            .mapInArrow(count, "bucket int, texts long")
            .groupBy("bucket")
            .agg(F.sum("texts").alias("texts"))
        )
        found = {r["bucket"]: r["texts"] for r in counts.collect()}
        n = found.get(-1, 0)
        return cls(corpus.sparkSession, [np.log((n + 1) / (found.get(b, 0) + 1)) for b in range(dim)])

    def __call__(self, df: DataFrame, text="text") -> DataFrame:
        """Adds the unit ``vector``; null for a null text and for one without weight."""
        idf, dim = self.idf, self.dim

        def weighted(words):
            rows, buckets, counts = count_buckets(words, dim)
            weights = counts * idf[buckets]
            lengths = np.sqrt(np.bincount(rows, weights**2, minlength=len(words)))
            sizes = np.bincount(rows, minlength=len(words))
            known = lengths > 0
            kept = known[rows]
            offsets = pa.array(np.append(0, np.cumsum(np.where(known, sizes, 0))).astype(np.int32))
            indices = pa.array(buckets[kept].astype(np.int32))
            values = pa.array(weights[kept] / lengths[rows[kept]])
            return pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(offsets, x) for x in (indices, values)],
                names=["indices", "values"],
                mask=pa.array(~known),
            )

        @F.arrow_udf(SPARSE)
        def embed(words: pa.Array) -> pa.Array:
            return pa.concat_arrays([weighted(part) for part in word_slices(words)])

        return df.withColumn("vector", embed(tokens(F.col(text))))

    def weight_table(self) -> DataFrame:
        """The bucket weights as a table of ``dim`` rows."""
        rows = [(b, float(w)) for b, w in enumerate(self.idf)]
        return self.spark.createDataFrame(rows, "bucket int, idf double")

    def save(self, path: str) -> None:
        self.weight_table().coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TfIdfEncoder":
        return cls(spark, [r["idf"] for r in sorted(spark.read.parquet(path).collect())])


def model_encoder(make_model, batch_size=32):
    """An encoder around a model of the user's choice.

    ``make_model()`` runs once per Python worker and returns a function from a list of texts
    to a 2-d array. Arrow batches are cut into ``batch_size`` texts. A null text and a
    vector without length give a null vector; all others have length one.
    """

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            out = np.full(len(texts), None, dtype=object)
            rows = np.flatnonzero(texts.notna().to_numpy())
            for start in range(0, len(rows), batch_size):
                part = rows[start : start + batch_size]
                vectors = np.asarray(model(texts.iloc[part].tolist()), dtype=np.float64)
                lengths = np.linalg.norm(vectors, axis=1)
                for at, v, length in zip(part, vectors, lengths):
                    if length > 0:
                        out[at] = (v / length).astype(np.float32)
            yield pd.Series(out, index=texts.index)

    def encode(df: DataFrame, text="text") -> DataFrame:
        return df.withColumn("vector", embed(F.col(text)))

    return encode
