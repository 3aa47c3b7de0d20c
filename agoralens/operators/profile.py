"""Profiling of tables: counts, shares, nulls, duplicates, key consistency, lengths."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens import fixed_values as fv
from agoralens.functions.lookup import one_row
from agoralens.functions.text import is_blank
from agoralens.operators.quantiles import selected_quantiles
from agoralens.session import settled


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), column)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with their percentage of all non-null rows."""
    counts = value_counts(df, column)
    total = one_row(counts, F.sum("count").alias("n"))
    return counts.withColumn("percent", F.col("count") * 100.0 / total["n"]).orderBy(
        F.desc("count"), column
    )


def imbalance(df: DataFrame, column: str) -> DataFrame:
    """Most and least common value with counts, and the ratio of the two."""
    counts = value_counts(df, column)
    top = F.min_by(column, F.struct(-F.col("count"), F.col(column)))
    # The last row of the descending counts: the smallest count, the largest value of it.
    low = F.max_by(column, F.struct(-F.col("count"), F.col(column)))
    return counts.agg(
        top.alias("most_common"),
        F.max("count").alias("most_count"),
        low.alias("least_common"),
        F.min("count").alias("least_count"),
        (F.max("count") / F.min("count")).alias("ratio"),
    )


def opinions_per_topic(df: DataFrame, topic="topic_id") -> DataFrame:
    """Opinion count per topic, largest first."""
    counts = df.filter(F.col(topic).isNotNull()).groupBy(topic).agg(
        F.count("*").alias("opinion_count")
    )
    return counts.orderBy(F.desc("opinion_count"), topic)


def top_topics(df: DataFrame, n=20, topic="topic_id") -> DataFrame:
    return opinions_per_topic(df, topic).limit(n)


def type_by_topic(df: DataFrame, types, topic="topic_id", column="type") -> DataFrame:
    """One row per topic and one count column per type, 0 where there is none."""
    known = df.filter(F.col(topic).isNotNull() & F.col(column).isNotNull())
    return known.groupBy(topic).pivot(column, list(types)).count().fillna(0)


def top_type_by_topic(df: DataFrame, types, n=15, topic="topic_id", column="type") -> DataFrame:
    """The rows of ``type_by_topic`` for the n largest topics, in their order.

    The n topics are broadcast, so only their rows are counted by type.
    """
    top = top_topics(df, n, topic)
    rows = df.join(F.broadcast(top), topic)
    return (
        type_by_topic(rows, types, topic, column)
        .join(F.broadcast(top), topic)
        .orderBy(F.desc("opinion_count"), topic)
    )


def row_counts(**tables: DataFrame) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return _union(parts)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column and, in the row of a null column name, of the whole table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0))
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    entries.append(F.struct(F.lit(None).cast("string").alias("column"), total.alias("nulls")))
    return counts.select(F.inline(F.array(*entries)))


def table_info(df: DataFrame) -> DataFrame:
    """Column position, name, type and non-null count."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*entries)))


def _exact(value: Column, kind: T.DataType) -> Column:
    """A value in a form whose JSON is equal exactly where Spark groups values together."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        # Adding zero turns -0.0 into 0.0; all NaN are one text.
        return (value + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _exact(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_exact(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    return value.cast("string")


def row_digest(df: DataFrame) -> Column:
    """A SHA-256 digest of all columns; null and the empty text differ.

    Times keep their microseconds, and zeros of either sign are equal.
    """
    parts = []
    for f in df.schema:
        text = F.to_json(F.struct(_exact(F.col(f"`{f.name}`"), f.dataType).alias("v")))
        parts += [F.length(text).cast("string"), text]
    return F.sha2(F.concat_ws(":", *parts), 256)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row.

    Rows are compared by digest, so the shuffle carries 32 bytes per distinct row of a task
    and not its texts. Copies are folded before the shuffle.
    """
    groups = df.select(F.unhex(row_digest(df)).alias("d")).groupBy("d").agg(F.count("*").alias("c"))
    return groups.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicates"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """How many rows repeat an earlier key; a null key counts as a value."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("c"))
    return groups.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicates"))


def mark_duplicates(df: DataFrame, keys, id_col: str) -> DataFrame:
    """Adds ``is_duplicate``: true for all rows of a key but the one with the lowest id.

    Keys are compared by digest, and the lowest id per key is a partial aggregate. The marks
    come back by the unique id, so the copies of a hot key are never brought together.
    """
    digest = F.unhex(row_digest(df.select(*keys)))
    firsts = df.select(digest.alias("d"), id_col).groupBy("d").agg(F.min(id_col).alias(id_col))
    marks = firsts.select(id_col, F.lit(False).alias("is_duplicate"))
    return df.join(marks, id_col, "left").withColumn(
        "is_duplicate", F.coalesce("is_duplicate", F.lit(True))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, null included."""
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-null values."""
    return df.agg(F.count_distinct(column).alias("distinct_count"))


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks; null equals null."""
    return left.select(key).subtract(right.select(key))


def key_consistency(topics, opinions, conclusions, key="topic_id") -> DataFrame:
    """Key set sizes of the three tables, orphaned opinions and topics without opinions."""
    # One pass over the keys of all tables: a bit says which tables hold a key.
    held = _union(
        [
            df.select(F.col(key).alias("k"), F.lit(bit).alias("bit"))
            for bit, df in ((1, topics), (2, opinions), (4, conclusions))
        ]
    )
    keys = held.groupBy("k").agg(F.bit_or("bit").alias("bits"))

    def has(bit):
        return F.col("bits").bitwiseAND(F.lit(bit)) != 0

    checks = {
        "topics": has(1),
        "opinions": has(2),
        "conclusions": has(4),
        "orphaned_opinions": has(2) & ~has(1),
        "topics_without_opinions": has(1) & ~has(2),
    }
    counts = keys.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    entries = [F.struct(F.lit(n).alias("check"), F.col(n).alias("value")) for n in checks]
    return counts.select(F.inline(F.array(*entries)))


def short_texts(df: DataFrame, text="text", below=fv.MIN_TEXT_LENGTH, keep=()) -> DataFrame:
    return df.filter(F.length(text) < below).select(*keep, text)


def first_rows(df: DataFrame, order, n=3) -> DataFrame:
    """The first n rows in the order of a key."""
    return df.orderBy(order).limit(n)


def quality_report(topics, opinions, conclusions, key="topic_id", text="text") -> DataFrame:
    """Nulls, duplicate rows, key consistency, blank and short texts: (check, table, value)."""
    parts = []
    for name, df in (("topics", topics), ("opinions", opinions), ("conclusions", conclusions)):
        nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
        checks = {"missing_values": "nulls"}
        if name != "conclusions":
            checks |= {"blank_texts": "blank", "short_texts": "short"}
            parts.append(
                duplicate_rows(df).select(
                    F.lit("duplicate_rows").alias("check"),
                    F.lit(name).alias("table"),
                    F.col("duplicates").alias("value"),
                )
            )
        entries = [
            F.struct(F.lit(check).alias("check"), F.col(c).alias("value")) for check, c in checks.items()
        ]
        counts = df.agg(
            nulls.alias("nulls"),
            F.count_if(is_blank(F.col(text))).alias("blank"),
            F.count_if(F.length(text) < fv.MIN_TEXT_LENGTH).alias("short"),
        )
        parts.append(
            counts.select(F.inline(F.array(*entries))).select(
                "check", F.lit(name).alias("table"), "value"
            )
        )
    keys = key_consistency(topics, opinions, conclusions, key)
    owner = (
        F.when(F.col("check") == "orphaned_opinions", "opinions")
        .when(F.col("check") == "topics_without_opinions", "topics")
        .otherwise(F.col("check"))
    )
    label = F.when(F.col("check") == F.col("table"), "distinct_keys").otherwise(F.col("check"))
    parts.append(keys.withColumn("table", owner).select(label.alias("check"), "table", "value"))
    return _union(parts)


DESCRIPTION = "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of number columns.

    The columns are stored once. One pass gives the statistics and the first brackets of all
    quartiles, a few more the exact quartiles of all columns at once.
    """
    numbers = settled(df.select(*columns), "numbers")
    stats = [
        f(c).cast("double").alias(f"{name}_{i}")
        for i, c in enumerate(columns)
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    quartiles, rows = selected_quantiles(numbers, columns, (0.25, 0.5, 0.75), also=stats)
    out = []
    for i, c in enumerate(columns):
        row = rows[0].asDict() if rows else {}
        ends = [row.get(f"{name}_{i}") for name in ("mean", "std", "min")]
        quarter = [quartiles.get((0, c, s)) for s in (0.25, 0.5, 0.75)]
        out.append((c, row.get(f"n_v{i}", 0), *ends, *quarter, row.get(f"max_{i}")))
    return df.sparkSession.createDataFrame(out, DESCRIPTION)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram: bin, lower and upper edge, count; the last bin is closed.

    A constant column gets a range of one around its value. A value on an edge goes to the
    bin that the edge opens.
    """
    v = F.col(value).cast("double")
    known = df.select(v.alias("v")).filter("v is not null")
    span = one_row(known, F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo = F.when(F.col("s.lo") == F.col("s.hi"), F.col("s.lo") - 0.5).otherwise(F.col("s.lo"))
    hi = F.when(F.col("s.lo") == F.col("s.hi"), F.col("s.hi") + 0.5).otherwise(F.col("s.hi"))
    rows = known.withColumn("s", span).select("v", lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    guess = F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))
    edge = F.col("lo") + F.col("i") * width
    next_edge = F.col("lo") + (F.col("i") + 1) * width
    index = (
        F.when((F.col("v") < edge) & (F.col("i") > 0), F.col("i") - 1)
        .when((F.col("v") >= next_edge) & (F.col("i") < bins - 1), F.col("i") + 1)
        .otherwise(F.col("i"))
    )
    counts = (
        rows.withColumn("i", guess).withColumn("bin", index.cast("long")).groupBy("bin").agg(F.count("*").alias("n"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").alias("bin")).withColumn("s", span)
    filled = all_bins.select("bin", lo.alias("lo"), hi.alias("hi")).join(counts, "bin", "left")
    lower = F.col("lo") + F.col("bin") * width
    upper = F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width)
    return filled.select(
        "bin",
        lower.alias("lower"),
        upper.alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"),
    ).orderBy("bin")


def _union(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
