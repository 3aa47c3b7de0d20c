"""Queries: profiling and cleaning."""

from pyspark.sql import functions as F

from agoralens.functions.text import is_blank, preview, with_text_counts
from agoralens.operators import profile, sketches
from agoralens.operators.clean import clean_tables, long_enough, with_known_topic
from agoralens.plans.inputs import OPINIONS_SQL, SPACE, TOPICS_SQL, documents, opinions, table, topics
from agoralens.plans.registry import query
from agoralens.session import fresh_path, settled
from agoralens.sources.tables import load_all, read_table, write_clean_tables, write_table

WORD_COUNT_SQL = f"len(regexp_extract_all(text, '[^{SPACE}]+'))::INTEGER"


@query(
    "text_stats",
    f"""SELECT doc_id, length(text)::INTEGER AS text_length, {WORD_COUNT_SQL} AS word_count,
  NOT regexp_matches(text, '[^{SPACE}]') AS is_blank FROM documents""",
)
def text_stats(spark, sf_dir):
    df = with_text_counts(documents(spark, sf_dir))
    return df.select("doc_id", "text_length", "word_count", is_blank("text").alias("is_blank"))


@query(
    "preview",
    "SELECT doc_id, substr(text, 1, 150) || '...' AS preview FROM documents ORDER BY doc_id LIMIT 3",
)
def first_previews(spark, sf_dir):
    df = profile.first_rows(table(spark, sf_dir, "documents"), "doc_id", 3)
    return df.select("doc_id", preview("text").alias("preview"))


@query("short_texts", "SELECT doc_id, text FROM documents WHERE length(text) < 10")
def short_texts(spark, sf_dir):
    return profile.short_texts(table(spark, sf_dir, "documents"), keep=("doc_id",))


@query(
    "clean_opinions",
    f"""WITH {OPINIONS_SQL}, {TOPICS_SQL}
SELECT opinion_id, topic_id, text, type, length(text)::INTEGER AS text_length, {WORD_COUNT_SQL} AS word_count
FROM opinions WHERE length(text) >= 10
  AND topic_id IN (SELECT topic_id FROM topics WHERE length(text) >= 10)""",
)
def clean_opinions(spark, sf_dir):
    return with_known_topic(long_enough(opinions(spark, sf_dir)), long_enough(topics(spark, sf_dir)))


@query(
    "clean_topics",
    f"""SELECT item_id, text, length(text)::INTEGER AS text_length, {WORD_COUNT_SQL} AS word_count
FROM benchmark WHERE length(text) >= 10""",
)
def clean_topics(spark, sf_dir):
    return long_enough(table(spark, sf_dir, "benchmark"))


@query("value_counts", "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "documents"), "lang")


@query(
    "value_share",
    """SELECT lang, count(*) AS count, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent
FROM documents WHERE lang IS NOT NULL GROUP BY lang""",
)
def value_share(spark, sf_dir):
    df = profile.value_shares(table(spark, sf_dir, "documents"), "lang")
    return df.withColumn("percent", F.round("percent", 6))


@query(
    "imbalance",
    """WITH c AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
s AS (SELECT *, row_number() OVER (ORDER BY n DESC, lang) AS up, row_number() OVER (ORDER BY n, lang DESC) AS down FROM c)
SELECT max(CASE WHEN up = 1 THEN lang END) AS most_common, max(n) AS most_count,
  max(CASE WHEN down = 1 THEN lang END) AS least_common, min(n) AS least_count,
  round(max(n)::DOUBLE / min(n), 6) AS ratio FROM s""",
)
def imbalance(spark, sf_dir):
    df = profile.imbalance(table(spark, sf_dir, "documents"), "lang")
    return df.withColumn("ratio", F.round("ratio", 6))


@query("per_topic_counts", "SELECT source AS topic_id, count(*) AS opinion_count FROM documents GROUP BY source")
def per_topic_counts(spark, sf_dir):
    return profile.opinions_per_topic(opinions(spark, sf_dir))


@query(
    "top20_topics",
    """SELECT o_custkey, count(*) AS opinion_count FROM orders GROUP BY o_custkey
ORDER BY opinion_count DESC, o_custkey LIMIT 20""",
)
def top20_topics(spark, sf_dir):
    return profile.top_topics(table(spark, sf_dir, "orders"), 20, "o_custkey")


@query(
    "top15_pivot",
    """SELECT source AS topic_id, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en,
  count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr, count(*) AS opinion_count
FROM documents GROUP BY source ORDER BY opinion_count DESC, topic_id LIMIT 15""",
)
def top15_pivot(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("source", "topic_id")
    return profile.top_type_by_topic(docs, ("de", "en", "es", "fr"), 15, column="lang")


def with_nulls(spark, sf_dir):
    """Documents with nulls put in place of one language, one source and the 8-character texts."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.length("text") != 8, F.col("text")).alias("text"),
        F.nullif("lang", F.lit("de")).alias("lang"),
        F.nullif("source", F.lit("src1")).alias("source"),
    )


WITH_NULLS_SQL = """d AS (SELECT doc_id, CASE WHEN length(text) <> 8 THEN text END AS text,
  nullif(lang, 'de') AS lang, nullif(source, 'src1') AS source FROM documents)"""


@query(
    "null_counts",
    f"""WITH {WITH_NULLS_SQL},
c AS (SELECT count(*) - count(doc_id) AS a, count(*) - count(text) AS b, count(*) - count(lang) AS c,
  count(*) - count(source) AS e FROM d)
SELECT 'doc_id' AS "column", a AS nulls FROM c UNION ALL SELECT 'text', b FROM c UNION ALL
SELECT 'lang', c FROM c UNION ALL SELECT 'source', e FROM c UNION ALL SELECT NULL, a + b + c + e FROM c""",
)
def null_counts(spark, sf_dir):
    return profile.null_counts(with_nulls(spark, sf_dir))


@query(
    "table_info",
    f"""WITH {WITH_NULLS_SQL}
SELECT 0 AS "position", 'doc_id' AS "column", 'bigint' AS "type", count(doc_id) AS non_null FROM d UNION ALL
SELECT 1, 'text', 'string', count(text) FROM d UNION ALL
SELECT 2, 'lang', 'string', count(lang) FROM d UNION ALL
SELECT 3, 'source', 'string', count(source) FROM d""",
)
def table_info(spark, sf_dir):
    return profile.table_info(with_nulls(spark, sf_dir))


@query(
    "row_counts",
    """SELECT 'documents' AS "table", count(*) AS rows FROM documents UNION ALL
SELECT 'benchmark', count(*) FROM benchmark UNION ALL SELECT 'labels', count(*) FROM labels""",
)
def row_counts(spark, sf_dir):
    return profile.row_counts(**{n: table(spark, sf_dir, n) for n in ("documents", "benchmark", "labels")})


@query(
    "dup_counts",
    f"""WITH {WITH_NULLS_SQL}
SELECT (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM d)) FROM d)::BIGINT AS row_duplicates,
  (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM d)) FROM d)::BIGINT AS text_duplicates""",
)
def dup_counts(spark, sf_dir):
    rows = with_nulls(spark, sf_dir)
    texts = profile.duplicate_rows(rows.select("text")).scalar()
    both = profile.duplicate_rows(rows.drop("doc_id")).withColumnRenamed("duplicates", "row_duplicates")
    return both.withColumn("text_duplicates", texts)


@query(
    "dup_times",
    """SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_type, epoch_us(ts) % 5000 FROM events)))::BIGINT
  AS duplicates FROM events""",
)
def dup_times(spark, sf_dir):
    """Repeated times that differ in microseconds only: the last five milliseconds of each event."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) % 5000
    events = table(spark, sf_dir, "events")
    return profile.duplicate_rows(events.select("event_type", F.timestamp_micros(micros).alias("at")))


@query(
    "dup_keys",
    "SELECT (count(*) - count(DISTINCT source))::BIGINT AS duplicates FROM documents",
)
def dup_keys(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "documents"), "source")


@query(
    "dup_marks",
    f"""WITH {WITH_NULLS_SQL}
SELECT doc_id, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) > 1 AS is_duplicate FROM d""",
)
def dup_marks(spark, sf_dir):
    marked = profile.mark_duplicates(with_nulls(spark, sf_dir), ("text", "lang"), "doc_id")
    return marked.select("doc_id", "is_duplicate")


@query("distinct_values", f"WITH {WITH_NULLS_SQL} SELECT DISTINCT lang FROM d")
def distinct_values(spark, sf_dir):
    return profile.distinct_values(with_nulls(spark, sf_dir), "lang")


@query("distinct_count", f"WITH {WITH_NULLS_SQL} SELECT count(DISTINCT source) AS distinct_count FROM d")
def distinct_count(spark, sf_dir):
    return profile.distinct_count(with_nulls(spark, sf_dir), "source")


@query(
    "key_consistency",
    """WITH t AS (SELECT DISTINCT doc_id AS k FROM labels), o AS (SELECT DISTINCT doc_id AS k FROM documents),
c AS (SELECT DISTINCT item_id AS k FROM benchmark)
SELECT 'topics' AS "check", (SELECT count(*) FROM t) AS value UNION ALL
SELECT 'opinions', (SELECT count(*) FROM o) UNION ALL
SELECT 'conclusions', (SELECT count(*) FROM c) UNION ALL
SELECT 'orphaned_opinions', (SELECT count(*) FROM o WHERE k NOT IN (SELECT k FROM t)) UNION ALL
SELECT 'topics_without_opinions', (SELECT count(*) FROM t WHERE k NOT IN (SELECT k FROM o))""",
)
def key_consistency(spark, sf_dir):
    conclusions = table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id")
    return profile.key_consistency(
        table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), conclusions, "doc_id"
    )


@query(
    "topics_without_opinions",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def topics_without_opinions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return profile.key_difference(table(spark, sf_dir, "customer"), orders, "c_custkey")


@query(
    "orphaned_opinions",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def orphaned_opinions(spark, sf_dir):
    return profile.key_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


def _quality_sql():
    def counts(name, source):
        return f"""SELECT 'missing_values' AS "check", '{name}' AS "table",
  ((count(*) - count(topic_id)) + (count(*) - count(text)) + (count(*) - count(type)))::BIGINT AS value FROM {source}"""

    def texts(name):
        return f"""SELECT 'blank_texts', '{name}', count(*) FILTER (NOT regexp_matches(text, '[^{SPACE}]')) FROM {name}
UNION ALL SELECT 'short_texts', '{name}', count(*) FILTER (length(text) < 10) FROM {name}
UNION ALL SELECT 'duplicate_rows', '{name}',
  (SELECT count(*) FROM {name}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name}))"""

    def keys(name):
        return f"SELECT 'distinct_keys', '{name}', count(*) FROM (SELECT DISTINCT topic_id FROM {name})"

    names = ("topics", "opinions", "conclusions")
    parts = [counts(n, n) for n in names] + [texts(n) for n in names[:2]] + [keys(n) for n in names]
    parts.append(
        "SELECT 'orphaned_opinions', 'opinions', count(*) FROM (SELECT topic_id FROM opinions EXCEPT SELECT topic_id FROM topics)"
    )
    parts.append(
        "SELECT 'topics_without_opinions', 'topics', count(*) FROM (SELECT topic_id FROM topics EXCEPT SELECT topic_id FROM opinions)"
    )
    return f"""WITH {WITH_NULLS_SQL},
opinions AS (SELECT source AS topic_id, text, lang AS type FROM d),
topics AS (SELECT DISTINCT source AS topic_id, source AS text, 'topic' AS type FROM documents),
conclusions AS (SELECT source AS topic_id, text, lang AS type FROM documents)
{' UNION ALL '.join(parts)}"""


@query("quality_report", _quality_sql())
def quality_report(spark, sf_dir):
    """Opinions with nulls, one topic per source, all documents as conclusions."""
    docs = table(spark, sf_dir, "documents")

    def shape(df):
        return df.select(F.col("source").alias("topic_id"), "text", F.col("lang").alias("type"))

    names = docs.select(
        F.col("source").alias("topic_id"), F.col("source").alias("text"), F.lit("topic").alias("type")
    ).distinct()
    return profile.quality_report(
        names, shape(with_nulls(spark, sf_dir)), shape(docs)
    )


def _describe_sql(column, expr):
    v = f"({expr})"
    return f"""SELECT '{column}' AS "column", count({v}) AS count, round(avg({v}), 6) AS mean,
  round(stddev_samp({v}), 6) AS std, min({v})::DOUBLE AS min, round(quantile_cont({v}, 0.25), 6) AS q25,
  round(quantile_cont({v}, 0.5), 6) AS q50, round(quantile_cont({v}, 0.75), 6) AS q75, max({v})::DOUBLE AS max"""


ROUNDED = ("mean", "std", "q25", "q50", "q75")


@query(
    "describe_lengths",
    f"{_describe_sql('text_length', 'length(text)')} FROM documents UNION ALL {_describe_sql('word_count', WORD_COUNT_SQL)} FROM documents",
)
def describe_lengths(spark, sf_dir):
    df = profile.describe(with_text_counts(documents(spark, sf_dir)), "text_length", "word_count")
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED})


@query("describe_values", f"{_describe_sql('value', 'value')} FROM events")
def describe_values(spark, sf_dir):
    df = profile.describe(table(spark, sf_dir, "events"), "value")
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED})


@query(
    "describe_topic_counts",
    f"WITH c AS (SELECT count(*) AS opinion_count FROM orders GROUP BY o_custkey) {_describe_sql('opinion_count', 'opinion_count')} FROM c",
)
def describe_topic_counts(spark, sf_dir):
    counts = profile.opinions_per_topic(table(spark, sf_dir, "orders"), "o_custkey")
    df = profile.describe(counts, "opinion_count")
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED})


@query("describe_ids", f"{_describe_sql('doc_id', 'doc_id')} FROM documents")
def describe_ids(spark, sf_dir):
    """A key of 64 bits, all of whose values differ."""
    df = profile.describe(table(spark, sf_dir, "documents"), "doc_id")
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED})


def histogram_sql(source, value, bins, extra=""):
    """Bins with exact edges: a value lies in the bin whose edges hold it, the last is closed."""
    return f"""span AS (SELECT min({value})::DOUBLE AS a, max({value})::DOUBLE AS b FROM {source}),
edges AS (SELECT CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi FROM span),
bins AS (SELECT i AS bin, lo + i * ((hi - lo) / {bins}) AS lower,
  CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {bins}) END AS upper FROM edges, range({bins}) r(i)),
counts AS (SELECT bin, count(*) AS n FROM bins, {source} s
  WHERE s.{value} >= lower AND (s.{value} < upper OR (bin = {bins - 1} AND s.{value} <= upper)) GROUP BY bin)
SELECT bin, round(lower, 6) AS lower, round(upper, 6) AS upper, coalesce(n, 0) AS count{extra}
FROM bins LEFT JOIN counts USING (bin)"""


@query(
    "histogram_lengths",
    f"WITH s0 AS (SELECT length(text) AS text_length FROM documents), {histogram_sql('s0', 'text_length', 50)}",
)
def histogram_lengths(spark, sf_dir):
    df = profile.histogram(with_text_counts(documents(spark, sf_dir)), "text_length", 50)
    return df.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


def _cleaned_sql(name, source, where="true", long="length(text) >= 10"):
    return f"""SELECT '{name}' AS "table", topic_id, type, length(text)::INTEGER AS text_length, {WORD_COUNT_SQL} AS word_count
FROM {source} WHERE {long} AND {where}"""


@query(
    "chained_tables",
    f"""WITH {OPINIONS_SQL}, {TOPICS_SQL},
items AS (SELECT 'item ' || item_id AS topic_id, text, 'item' AS type FROM benchmark)
{_cleaned_sql('topics', 'topics')} UNION ALL
{_cleaned_sql('opinions', 'opinions', 'topic_id IN (SELECT topic_id FROM topics WHERE length(text) >= 10)')} UNION ALL
{_cleaned_sql('conclusions', 'items', long='true')}""",
)
def chained_tables(spark, sf_dir):
    """The three tables written, loaded, cleaned, written again and read back."""
    folder = fresh_path(spark, "tables")
    items = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("topic_id"), "text", F.lit("item").alias("type")
    )
    given = opinions(spark, sf_dir).withColumn("effectiveness", F.lit(None).cast("string"))
    for name, df in (("topics", topics(spark, sf_dir)), ("opinions", given), ("conclusions", items)):
        write_table(df, f"{folder}/{name}.parquet")
    write_clean_tables(clean_tables(*load_all(spark, folder)), folder)
    parts = [
        df.select(F.lit(name).alias("table"), "topic_id", "type", "text_length", "word_count")
        for name, df in load_all(spark, folder, clean=True)._asdict().items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("csv_roundtrip", "SELECT doc_id::VARCHAR AS opinion_id, source AS topic_id, text, lang AS type FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Opinions written as CSV and read back with the explicit schema."""
    path = fresh_path(spark, "opinions") + ".csv"
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("opinion_id"),
        F.col("source").alias("topic_id"),
        "text",
        F.col("lang").alias("type"),
    )
    write_table(docs, path)
    return read_table(spark, path, docs.schema)


@query("parquet_roundtrip", "SELECT doc_id::VARCHAR AS opinion_id, source AS topic_id, text FROM documents")
def parquet_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "opinions") + ".parquet"
    docs = opinions(spark, sf_dir)
    write_table(docs, path)
    schema = docs.select(F.col("opinion_id").cast("string"), "topic_id", "text").schema
    return read_table(spark, path, schema)


@query(
    "top_customers",
    """SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey ORDER BY count DESC, o_custkey LIMIT 20""",
)
def top_customers(spark, sf_dir):
    """The most frequent of many keys, by bounded counters in each task and an exact count of the candidates."""
    return sketches.most_frequent(table(spark, sf_dir, "orders"), "o_custkey", 20)


@query(
    "top_event_types",
    """SELECT event_type, count(*) AS count FROM events GROUP BY event_type ORDER BY count DESC, event_type LIMIT 3""",
)
def top_event_types(spark, sf_dir):
    return sketches.most_frequent(table(spark, sf_dir, "events"), "event_type", 3)


@query(
    "distinct_by_sketch",
    """SELECT count(DISTINCT user_id) AS exact, true AS within FROM events""",
)
def distinct_by_sketch(spark, sf_dir):
    """Distinct users from one stored sketch a day, joined: within 5 % of the exact number, three errors."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    stored = settled(sketches.distinct_sketches(events, "day", "user_id"), "sketches")
    estimate = sketches.distinct_estimate(stored).first()["distinct"]
    exact = events.agg(F.count_distinct("user_id").alias("exact"))
    return exact.select("exact", (F.abs(F.lit(estimate) - F.col("exact")) <= 0.05 * F.col("exact")).alias("within"))
