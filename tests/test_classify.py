import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agoralens.operators import classify as clf
from agoralens.operators import metrics
from agoralens.operators.split import stratified_split
from agoralens.sources.model_store import load_model, save_model, write_history


def frame(spark, sizes):
    rows = [(i, label) for i, label in enumerate(x for label, n in sizes.items() for x in [label] * n)]
    return spark.createDataFrame(rows, "opinion_id int, type string")


@pytest.mark.parametrize(
    "sizes", [{"a": 500, "b": 20, "c": 3, "d": 1}, {"only": 77}, {"a": 10, None: 5}, {"hot": 9000, "cold": 11}]
)
def test_split_is_exact_per_class_and_repeats(spark, sizes):
    df = frame(spark, sizes)
    out = stratified_split(df, "type")
    got = {r["type"]: r["n"] for r in out.filter("is_validation").groupBy("type").agg(F.count("*").alias("n")).collect()}
    expected = {k: int(n * 0.2 + 0.5) for k, n in sizes.items() if k is not None}
    assert got == {k: n for k, n in expected.items() if n}
    assert out.count() == sum(n for k, n in sizes.items() if k is not None)
    again = stratified_split(df.repartition(5), "type").filter("is_validation")
    assert {r[0] for r in again.select("opinion_id").collect()} == {
        r[0] for r in out.filter("is_validation").select("opinion_id").collect()
    }


@pytest.mark.parametrize("share", [0.0, 1.0, 0.5])
def test_split_shares(spark, share):
    out = stratified_split(frame(spark, {"a": 40, "b": 7}), "type", share=share)
    assert out.filter("is_validation").count() == int(40 * share) + int(7 * share + 0.5)


PAIRS = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] * 2 + [("b", "x")]


def by_hand(pairs):
    labels = sorted({x for p in pairs for x in p})
    out = {}
    for label in labels:
        hit = sum(t == p == label for t, p in pairs)
        pred, true = sum(p == label for _, p in pairs), sum(t == label for t, _ in pairs)
        precision, recall = (hit / pred if pred else 0), (hit / true if true else 0)
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0
        out[label] = (precision, recall, f1, true)
    return out


@pytest.mark.parametrize("pairs", [PAIRS, [("a", "a")] * 3, [("a", "b")]])
def test_metrics_by_hand(spark, pairs):
    df = spark.createDataFrame(pairs, "type string, predicted_type string")
    hand = by_hand(pairs)
    report = metrics.classification_report(df, "type", "predicted_type").collect()
    for r in report:
        if r["kind"] == "class":
            assert (r["precision"], r["recall"], r["f1"], r["support"]) == pytest.approx(hand[r["label"]])
    one = metrics.classification_metrics(df, "type", "predicted_type").first()
    accuracy = sum(t == p for t, p in pairs) / len(pairs)
    assert one["accuracy"] == pytest.approx(accuracy)
    assert metrics.accuracy(df, "type", "predicted_type").first()[0] == pytest.approx(accuracy)
    for i, c in enumerate(("precision", "recall", "f1")):
        assert one[f"{c}_macro"] == pytest.approx(np.mean([v[i] for v in hand.values()]))
        weighted = sum(v[i] * v[3] for v in hand.values()) / len(pairs)
        assert one[f"{c}_weighted"] == pytest.approx(weighted)
    counts = metrics.confusion_counts(df, "type", "predicted_type")
    assert counts.agg(F.sum("count")).first()[0] == len(pairs)


def test_class_weights_balance(spark):
    df = frame(spark, {"a": 30, "b": 10, None: 4})
    got = {r["type"]: r["weight"] for r in metrics.class_weights(df, "type").collect()}
    assert got == pytest.approx({"a": 40 / 60, "b": 40 / 20})


def test_labels_are_alphabetic_and_unseen_ones_are_errors(spark):
    encoder = clf.label_encoder(spark.createDataFrame([("b",), ("a",), ("Z",)], "type string"))
    assert encoder.labels == ["Z", "a", "b"]
    with pytest.raises(Exception, match="Unseen label"):
        encoder.transform(spark.createDataFrame([("new",)], "type string")).collect()


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(5)
    words = {"claim": "should must best", "evidence": "study shows percent", "rebuttal": "however wrong instead"}
    rows = []
    for i in range(300):
        label = list(words)[i % 3]
        noise = rng.choice(["we", "say", "this", "is"], 3)
        rows.append((i, " ".join([*rng.choice(words[label].split(), 2), *noise]), label))
    rows += [(900, None, "claim"), (901, "no label", None)]
    df = spark.createDataFrame(rows, "opinion_id int, text string, type string")
    return df, clf.train_classifier(df, features=1 << 10)


def test_training_learns_and_reports(spark, trained, tmp_path):
    df, t = trained
    row = t.history.first()
    assert row["val_accuracy"] > 0.9 and row["train_loss"] < 0.5
    assert t.split.count() == 300
    write_history(t.history, str(tmp_path / "h"))
    assert spark.read.parquet(str(tmp_path / "h")).columns == [
        "epoch",
        "train_loss",
        "train_accuracy",
        "val_loss",
        "val_accuracy",
    ]
    assert clf.objective_history(t.model).count() > 1


def test_history_agrees_with_predictions(spark, trained):
    df, t = trained
    scored = clf.predict(t.model, df).join(t.split.drop("type"), "opinion_id")
    labels = sorted({"claim", "evidence", "rebuttal"})
    val = clf.evaluate(scored.filter("is_validation"), labels).first()
    row = t.history.first()
    assert (row["val_loss"], row["val_accuracy"]) == pytest.approx((val["loss"], val["accuracy"]))


def test_saved_model_keeps_its_labels(spark, trained, tmp_path):
    df, t = trained
    save_model(t.model, str(tmp_path / "m"))
    restored = load_model(str(tmp_path / "m"))
    new = spark.createDataFrame([("study shows percent",), ("however wrong",), (None,), ("",)], "text string")
    rows = clf.predict(restored, new).collect()
    assert [r["predicted_type"] for r in rows[:3]] == ["evidence", "rebuttal", None]
    assert rows[2]["type_confidence"] is None and rows[2]["text"] is None
    assert sum(rows[0]["probabilities"]) == pytest.approx(1)
    assert rows[0]["type_confidence"] == max(rows[0]["probabilities"])


def test_whole_texts_are_read_unless_a_cut_is_asked_for(spark):
    df = spark.createDataFrame([("a " * 500 + "tail",)], "text string")

    def size(max_tokens):
        from pyspark.ml import PipelineModel

        out = PipelineModel(clf.text_stages(max_tokens=max_tokens)).transform(df).first()
        return sum(out["_tf"].values)

    assert size(None) == 501 and size(128) == 128


def test_distribution_compare(spark):
    df = spark.createDataFrame(PAIRS, "type string, predicted_type string")
    pdf = pd.DataFrame(PAIRS, columns=["t", "p"])
    got = {r["label"]: (r["original_count"], r["predicted_count"]) for r in metrics.distribution_compare(df, "type", "predicted_type").collect()}
    for label in "abcx":
        assert got[label] == ((pdf.t == label).sum(), (pdf.p == label).sum())
