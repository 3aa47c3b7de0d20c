"""The whole study as one flow: clean, match, classify, conclude."""

from typing import NamedTuple

from pyspark.sql import DataFrame

from agoralens.operators import classify as clf
from agoralens.operators.clean import clean_tables
from agoralens.operators.conclude import generate_conclusions
from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.match import match_topics, with_matches
from agoralens.sources.tables import Tables, read_table, write_table
from agoralens.sources.vector_table import vector_table, write_vectors


class Study(NamedTuple):
    tables: Tables
    classified: DataFrame
    conclusions: DataFrame
    trained: clf.Trained


def run_study(tables: Tables, folder: str, dim=4096, **training) -> Study:
    """Run every step on the three input tables and keep each result under ``folder``.

    Each step is written once and read back, so that later steps do not repeat it and a lost
    executor costs no more than its own tasks.
    """
    spark = tables.opinions.sparkSession
    folder = folder.rstrip("/")
    for name, df in clean_tables(*tables)._asdict().items():
        write_table(df, f"{folder}/{name}_clean.parquet")
    clean = Tables(**{n: spark.read.parquet(f"{folder}/{n}_clean.parquet") for n in Tables._fields})
    encoder = TfIdfEncoder.fit(clean.opinions, dim=dim)
    encoder.save(f"{folder}/encoder.parquet")
    write_vectors(vector_table(clean.topics, encoder), f"{folder}/topic_vectors.parquet")
    vectors = spark.read.parquet(f"{folder}/topic_vectors.parquet")
    write_table(encoder(clean.opinions).select("opinion_id", "vector"), f"{folder}/opinion_vectors.parquet")
    coded = spark.read.parquet(f"{folder}/opinion_vectors.parquet")
    matches = match_topics(coded, vectors, dim=dim)
    write_table(matches, f"{folder}/matches.parquet")
    matched = with_matches(clean.opinions, spark.read.parquet(f"{folder}/matches.parquet"))
    write_table(matched, f"{folder}/opinions_with_matches.parquet")
    matched = read_table(spark, f"{folder}/opinions_with_matches.parquet")
    trained = clf.train_classifier(matched, **training)
    scored = clf.predict(trained.model, matched).drop("probabilities")
    write_table(scored, f"{folder}/opinions_classified.parquet")
    scored = read_table(spark, f"{folder}/opinions_classified.parquet")
    conclusions = generate_conclusions(
        scored, clean.topics, encoder, output_path=f"{folder}/generated_conclusions.parquet"
    )
    return Study(clean, scored, conclusions, trained)


