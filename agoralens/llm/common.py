"""What several training-data operators share."""

import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITE = r"[\x20\x09-\x0D]+"
LETTER = re.compile(r"[^\W\d_]")
PORTION_ROWS = 1000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column, divisor):
    """crc32 of the id as text, modulo ``divisor``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def held_out(column, divisor):
    """Rows that models must not learn from: those with remainder 2."""
    return remainder(column, divisor) == 2


def ascii_words(text):
    """The words of a text in UTF-8, A-Z in lower case, cut at the six ASCII white-space bytes."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def slices(sizes, limit):
    """Ranges of neighbouring rows whose sizes sum to ``limit`` at most, or of one larger row."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def give_back():
    """Frees the memory that Arrow holds in reserve; a Python worker would carry it into later tasks."""
    pa.default_memory_pool().release_unused()


def portions(batches, rows=PORTION_ROWS):
    """The batches in runs of ``rows`` rows at most, so that what a step makes of them is bounded too."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
            give_back()


def wider(schema, **kinds):
    """A schema with more columns at its end, by name and type."""
    more = [T.StructField(name, T.StructType.fromDDL(f"x {kind}").fields[0].dataType) for name, kind in kinds.items()]
    return T.StructType([*schema.fields, *more])
