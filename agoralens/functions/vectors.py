"""Column functions on dense vectors held as arrays, and how batches of vectors are cut."""

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from agoralens.functions.text import let

SCORE_DIGITS = 9
CHUNK_BYTES = 32 << 20  # that the arrays of a step inside a task may take


def slices(costs, limit=CHUNK_BYTES // 8):
    """Ranges of neighbouring rows whose costs sum to about ``limit``, or of one dear row."""
    group = np.cumsum(costs) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(costs)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def as_doubles(v) -> Column:
    col = F.col(v) if isinstance(v, str) else v
    return col.cast("array<double>")


def dot(a, b) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(as_doubles(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalise(v) -> Column:
    """The unit vector, or null where the norm is zero, infinite or NaN."""
    return let(
        as_doubles(v),
        lambda a: let(norm(a), lambda n: F.when(_has_length(n), F.transform(a, lambda x: x / n))),
    )


def _has_length(n) -> Column:
    # NaN is above infinity in Spark's order.
    return (n > 0) & (n < F.lit(float("inf")))


def cosine(a, b) -> Column:
    """Cosine of two vectors, null where one has no length."""
    scale = norm(a) * norm(b)
    return F.when(_has_length(scale), dot(a, b) / scale)


def stable_score(score) -> Column:
    """A score without its last digits, so that equal vectors tie whatever the sum order."""
    return F.round(score, SCORE_DIGITS)
