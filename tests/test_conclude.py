import pytest

from agoralens import fixed_values as fv
from agoralens.operators import analysis
from agoralens.operators.conclude import generate_conclusions, opinion_results, topic_result
from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.summarise import summarise_topics
from agoralens.plans.study import run_study
from agoralens.sources.tables import Tables

DDL = "opinion_id int, matched_topic_id string, predicted_type string, type_confidence double, text string"


@pytest.fixture(scope="module")
def opinions(spark):
    rows = [(i, "hot", ["Claim", "claim ", "EVIDENCE"][i % 3], 0.5, f"Opinion number {i}. It has a tail.") for i in range(30)]
    rows += [
        (100, "b", "rebuttal", 0.9, "One short text"),
        (101, "b", "new kind", 0.7, "Another text"),
        (102, "b", None, None, "Unclassified text"),
        (103, "blank", "claim", 0.2, "   "),
        (104, "blank", "claim", 0.4, None),
        (105, None, "claim", 0.4, "lost"),
    ]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="module")
def topics(spark):
    rows = [("hot", "first"), ("hot", "second"), ("b", "third"), ("blank", "fourth"), ("none", "fifth"), (None, "sixth")]
    return spark.createDataFrame(rows, "topic_id string, text string")


@pytest.fixture(scope="module")
def encoder(opinions):
    return TfIdfEncoder.fit(opinions, dim=256)


def test_analysis_counts_labels_whatever_their_case(opinions):
    rows = {r["topic_id"]: r for r in analysis.topic_analysis(opinions).collect()}
    assert set(rows) == {"hot", "b", "blank"}
    hot, b = rows["hot"], rows["b"]
    assert hot["total_opinions"] == 30 and hot["position_distribution"] == {"claim": 20, "evidence": 10}
    assert hot["position_percentages"]["claim"] == pytest.approx(200 / 3)
    assert [t.split(".")[0] for t in hot["samples"]["claims"]] == [f"Opinion number {i}" for i in (0, 1, 3)]
    assert len(hot["samples"]["evidence"]) == 3 and hot["samples"]["rebuttals"] == []
    assert b["total_opinions"] == 3 and b["position_distribution"] == {"new kind": 1, "rebuttal": 1}
    assert b["position_percentages"]["rebuttal"] == pytest.approx(100 / 3)
    assert b["avg_confidence"] == pytest.approx(0.8)
    assert rows["blank"]["samples"]["claims"] == ["   "]


def test_prompt_shows_counts_shares_and_samples(opinions, topics):
    rows = analysis.topic_prompt(topics, analysis.topic_analysis(opinions), ("topic_id", "text")).collect()
    prompts = {r["text"]: r["prompt"] for r in rows}
    assert set(prompts) == {"first", "second", "third", "fourth"}
    assert "analysis of 30 opinions" in prompts["first"] and "20 opinions (66.7%)" in prompts["first"]
    assert prompts["first"].count(fv.NO_SAMPLES) == 2
    assert prompts["first"].replace("first", "second") == prompts["second"]


def test_one_conclusion_per_topics_row(spark, opinions, topics, encoder, tmp_path):
    path = str(tmp_path / "c.parquet")
    out = generate_conclusions(opinions, topics, encoder, output_path=path)
    rows = {r["topic_text"]: r for r in out.collect()}
    assert spark.read.parquet(path).count() == len(rows) == 6
    assert rows["first"]["generated_conclusion"] == rows["second"]["generated_conclusion"]
    assert (rows["first"]["status"], rows["first"]["claim_count"], rows["first"]["rebuttal_count"]) == ("ok", 20, 0)
    for text in ("fifth", "sixth"):
        r = rows[text]
        assert (r["status"], r["generated_conclusion"], r["opinion_count"]) == ("no_data", fv.NO_DATA, 0)
        assert r["claim_count"] is None and r["avg_confidence"] is None
    assert rows["fourth"]["status"] == "error" and rows["fourth"]["opinion_count"] == 2
    assert rows["fourth"]["generated_conclusion"].startswith(fv.ERROR_PREFIX)


def test_summary_uses_the_first_texts_in_order_within_the_word_budget(spark, opinions, encoder):
    rows = {r["topic_id"]: r["summary"] for r in summarise_topics(opinions, encoder).collect()}
    numbers = [int(s.split()[2]) for s in rows["hot"].split(". ") if s.startswith("Opinion")]
    assert numbers == sorted(numbers) and set(numbers) <= set(range(10))
    assert len(rows["hot"].split()) <= 150
    tight = summarise_topics(opinions, encoder, max_words=6, min_words=1)
    assert all(3 <= len(r["summary"].split()) <= 6 for r in tight.collect() if r["topic_id"] == "hot")


def test_a_sentence_over_the_budget_is_still_taken_when_it_is_the_first(spark, encoder):
    df = spark.createDataFrame([(1, "t", "claim", 0.5, "word " * 400)], DDL)
    assert len(summarise_topics(df, encoder).first()["summary"].split()) == 400


def test_results_by_id_and_topic(spark, opinions, topics, encoder):
    conclusions = generate_conclusions(opinions, topics, encoder)
    scored = spark.createDataFrame(
        [("o1", "hot", 0.9, "claim", 0.5), ("o2", None, None, "claim", 0.5)],
        "opinion_id string, matched_topic_id string, topic_similarity float, predicted_position string, position_confidence float",
    )
    asked = spark.createDataFrame([("o1",), ("o2",), ("o3",)], "opinion_id string")
    rows = {r["opinion_id"]: r for r in opinion_results(asked, scored, topics, conclusions).collect()}
    assert len(rows) == 3 and rows["o1"]["topic_text"] == "first" and rows["o1"]["conclusion"]
    assert [rows[o]["is_processed"] for o in ("o1", "o2", "o3")] == [True, True, False]
    folded = analysis.fold_counts(analysis.position_counts(opinions))
    by_topic = {r["topic_id"]: r for r in topic_result(topics, folded, conclusions).collect()}
    assert by_topic["hot"]["position_distribution"] == {"claim": 20, "evidence": 10}
    assert by_topic["none"]["total_opinions"] == 0


def test_whole_study(spark, tmp_path):
    topics = spark.createDataFrame(
        [("1", "t1", "school uniforms are good", "p"), ("2", "t2", "phones in the classroom", "p"), ("3", "t3", "tiny", "p")],
        "id string, topic_id string, text string, type string",
    )
    words = {"claim": "should must", "evidence": "study shows", "counterclaim": "others say", "rebuttal": "however wrong"}
    rows = []
    for i in range(80):
        label = list(words)[i % 4]
        topic, text = (("t1", "school uniforms"), ("t2", "phones classroom"), ("t3", "tiny topic"))[i % 3]
        rows.append((str(i), topic, f"{words[label]} {text} number{i}.", label, "Adequate"))
    opinions = spark.createDataFrame(rows, "opinion_id string, topic_id string, text string, type string, effectiveness string")
    conclusions = spark.createDataFrame([("t1", "x", "c")], "topic_id string, text string, type string")
    study = run_study(Tables(topics, conclusions, opinions), str(tmp_path), dim=512, features=512)
    scored = study.classified
    assert scored.count() == sum(i % 3 != 2 for i in range(80))
    assert scored.filter("is_correct").count() == scored.count()
    out = {r["topic_id"]: r for r in study.conclusions.collect()}
    assert set(out) == {"t1", "t2"} and {r["status"] for r in out.values()} == {"ok"}
    assert sum(r["opinion_count"] for r in out.values()) == scored.count()
