"""The physical plans that the work at scale depends on."""

import pytest

from agoralens.operators import analysis, clean, match, profile, summarise
from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.split import stratified_split
from agoralens.plans import inputs
from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def docs(spark):
    return inputs.table(spark, SF_DIR, "documents")


def test_cleaning_pushes_nothing_but_the_needed_columns(spark):
    df = clean.long_enough(docs(spark).select("doc_id", "text", "lang")).select("doc_id", "word_count")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(df)
    counts = profile.opinions_per_topic(docs(spark), "source")
    text = plan(counts)
    assert "ReadSchema: struct<source:string>" in text and "PushedFilters: [IsNotNull(source)]" in text


def test_first_texts_are_limited_before_the_shuffle(spark):
    df = docs(spark).withColumnRenamed("doc_id", "opinion_id")
    text = plan(analysis.first_texts(df, ("source",), 10))
    assert "WindowGroupLimit" in text and text.count("Exchange") >= 1


def test_broadcast_match_has_no_shuffle(spark):
    df = match.topic_hits(inputs.vector_opinions(spark, SF_DIR), inputs.label_topics(spark, SF_DIR))
    assert "Exchange" not in plan(df) and "MapInArrow" in plan(df)


def test_encoding_has_no_shuffle(spark):
    encoder = TfIdfEncoder.fit(docs(spark), dim=256)
    assert "Exchange" not in plan(encoder(docs(spark)).select("doc_id", "vector"))


def test_split_does_not_shuffle_the_texts(spark):
    text = plan(stratified_split(docs(spark), "lang", "doc_id"))
    main = text.split("===== Subqueries =====")[0]
    assert "Exchange" not in main and "Join" not in main


def test_top_k_is_taken_without_a_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(profile.top_topics(docs(spark), 20, "source"))


def test_summary_joins_on_keys(spark):
    rows = inputs.opinions(spark, SF_DIR)
    text = plan(summarise.summarise_topics(rows, TfIdfEncoder.fit(rows, dim=256), "topic_id"))
    assert "WindowGroupLimit" in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["topic_prompt", "topic_samples", "topic_analysis", "run_summary"])
def test_a_classifier_is_not_copied(spark, name):
    assert plan(queries()[name](spark, SF_DIR)).count("regexp_extract_all") <= 2


NO_PLAN = ("stream_", "train", "model_", "quality_classifier", "csv_", "parquet_", "vector_upsert", "epoch_")


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith(NO_PLAN)))
def test_no_query_has_a_cross_join(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
