import pytest
from pyspark.sql import functions as F

from agoralens import fixed_values as fv
from agoralens.functions import text as tx

TEXTS = [
    None,
    "",
    "   ",
    "  a  b\n",
    "a b",
    "a b",
    "a\x1cb\x1fc",
    " 　",
    "123456789",
    "1234567890",
    "😀 ok",
    'he said "x, y"\nand left',
    "x" * 150,
    "x" * 151,
]


def column(spark, value):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(value).collect()]


def test_lengths_count_characters(spark):
    assert column(spark, tx.text_length("text")) == [None if t is None else len(t) for t in TEXTS]


def test_words_are_runs_of_non_space(spark):
    assert column(spark, tx.word_count("text")) == [None if t is None else len(t.split()) for t in TEXTS]


def test_blank_is_strip_to_nothing(spark):
    assert column(spark, tx.is_blank("text")) == [None if t is None else t.strip() == "" for t in TEXTS]


def test_preview_always_ends_with_dots(spark):
    assert column(spark, tx.preview("text")) == [None if t is None else t[:150] + "..." for t in TEXTS]


@pytest.mark.parametrize(
    "samples, expected",
    [
        ([], fv.NO_SAMPLES),
        (None, fv.NO_SAMPLES),
        (["a", "b"], "  - a\n  - b"),
        (["x" * 150], "  - " + "x" * 150),
        (["x" * 151], "  - " + "x" * 150 + "..."),
    ],
)
def test_bullets(spark, samples, expected):
    df = spark.createDataFrame([(samples,)], "s array<string>")
    assert df.select(tx.bullet_list(F.col("s"))).first()[0] == expected


@pytest.mark.parametrize("value", [0.0, 6.25, 12.5, 12.35, 33.333, 99.95, 100.0, 0.05, 0.15, 1 / 3])
def test_percent_text_rounds_like_a_format(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(tx.percent_text(F.col("v"))).first()[0] == f"{value:.1f}"


def test_sentences(spark):
    text = "One. Two!  Three?\n   \n four...five  "
    df = spark.createDataFrame([(text,)], "text string")
    expected = ["One.", "Two!", "Three?", "four...", "five"]
    assert df.select(tx.sentences(F.col("text"))).first()[0] == expected


def test_tokens_are_runs_of_letters(spark):
    df = spark.createDataFrame([("Élan vital, 2nd über-cool x²",)], "text string")
    assert df.select(tx.tokens(F.col("text"))).first()[0] == ["élan", "vital", "nd", "über", "cool", "x"]
