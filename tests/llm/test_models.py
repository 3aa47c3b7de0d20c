import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from agoralens.llm import hmm_lm, langid, toxicity
from agoralens.llm.common import slices

SF = "/root/testdata/sf0.01"


def held(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor == 2


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    unseen = [r for r in rows if held(r["doc_id"], 4)]
    assert np.mean([r["predicted"] == r["toxic"] for r in unseen]) >= 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity_does_not_see_held_out_labels(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    some = docs.limit(50)
    first, second = (toxicity.with_toxicity(some, toxicity.train(docs, y)).collect() for y in (labels, flipped))
    assert first == second


def test_toxicity_of_odd_rows(spark, docs_of):
    rows = [(i, "good day to you all" if i % 2 else "you vile idiot go away") for i in range(60)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(1, 0), (None, 1), (3, None)], "doc_id int, toxic int")
    odd = [(None, None), (901, ""), (902, "idiot " * 50000), (903, "Good DAY"), (903, "Good DAY")]
    out = toxicity.toxicity(docs_of(rows + odd), labels)
    got = {(r["doc_id"], r["text"]): r["predicted"] for r in out.collect()}
    assert out.count() == 65 and out.columns.count("score") == 1
    assert got[(902, "idiot " * 50000)] == 1 and got[(903, "Good DAY")] == 0 and (None, None) in got
    none = labels.where("toxic = 0")
    assert {r["predicted"] for r in toxicity.toxicity(docs_of(rows), none).collect()} == {0}
    assert toxicity.toxicity(docs_of([]), labels).count() == 0


def test_language_on_held_out_rows(tables):
    docs, _ = tables
    rows = langid.language(docs).collect()
    unseen = [r for r in rows if held(r["doc_id"], 4)]
    assert np.mean([r["lang"] == r["lang_pred"] for r in unseen]) >= 0.97
    # Honest probabilities: their mean is near the share of right predictions.
    assert abs(np.mean([r["score"] for r in unseen]) - 1) < 0.1


def test_language_of_odd_rows(docs_of):
    rows = [(i, "the cat and the dog of the house", "en") if i % 2 else (i, "der hund und die katze im haus", "de") for i in range(80)]
    odd = [(None, None, None), (901, "", "en"), (902, "12 34 !?", None), (903, "der " * 50000, None), (904, "DER HUND", None)]
    out = langid.language(docs_of(rows + odd))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert got[None] == got[901] == got[902] == ("und", 0.0)
    assert got[903][0] == got[904][0] == "de" and all(0 <= s <= 1 for _, s in got.values())
    assert out.columns.count("score") == 1
    untold = langid.language(docs_of([(1, "some text", None)])).first()
    assert (untold["lang_pred"], untold["score"]) == ("und", 0.0)
    assert langid.language(docs_of([])).count() == 0


def test_the_leader_keeps_useless_weights_at_zero():
    rng, leader = np.random.default_rng(0), langid.Leader(6, 2)
    for _ in range(400):
        y = int(rng.integers(2))
        leader.learn(np.array([y, 5]), np.array([1.0, rng.normal() * 1e-3]), y)
    w = leader.weights()
    assert (w[2:5] == 0).all() and w[0, 0] > 0.5 and w[1, 1] > 0.5


def test_temperature():
    z = np.array([[4.0, 0.0]] * 10)
    soft = langid.best_temperature([0] * 7 + [1] * 3, z)
    assert langid.soft_max(z / soft)[0, 0] == pytest.approx(0.7, abs=0.01)
    assert langid.best_temperature([], np.zeros((0, 2))) == 1.0


def brute_forward(model, seq):
    total = 0.0
    for path in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, s in zip(path, path[1:], seq[1:]):
            p *= model.steps[a, b] * model.emit[s, b]
        total += p
    return math.log10(total)


@pytest.fixture(scope="module")
def small_model():
    rng = np.random.default_rng(1)
    emit = rng.random((6, 3)) + 0.1
    steps = rng.random((3, 3)) + 0.1
    return hmm_lm.Model(np.array([0.2, 0.5, 0.3]), np.ones(3) / 3, steps / steps.sum(1, keepdims=True), emit / emit.sum(0))


def test_likelihood_is_the_sum_over_all_paths(small_model):
    seqs = [np.array(s, np.uint16) for s in ([0, 1, 2, 5], [5], [3, 3, 4, 1, 0, 5], [2, 5])]
    assert hmm_lm.likelihoods(small_model, seqs) == pytest.approx([brute_forward(small_model, s) for s in seqs])


def test_expected_counts_raise_the_likelihood(small_model):
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint16) for _ in range(40)]
    model, last = small_model, -np.inf
    for _ in range(6):
        sums = {"emit": np.zeros((6, 3)), "steps": np.zeros((3, 3)), "starts": np.zeros(3), "log": 0.0}
        hmm_lm.expected(model, seqs, [False] * 40, sums)
        assert sums["emit"].sum() == pytest.approx(sum(map(len, seqs)), rel=1e-4)
        assert sums["log"] == pytest.approx(hmm_lm.likelihoods(model, seqs).sum(), rel=1e-4) and sums["log"] >= last - 1e-3
        last = sums["log"]
        steps, emit = sums["steps"] + 1e-9, sums["emit"] + 1e-9
        model = hmm_lm.Model(sums["starts"] / sums["starts"].sum(), model.inner, steps / steps.sum(1, keepdims=True), emit / emit.sum(0))


def test_language_model_scores_against_brute_force(docs_of):
    rows = [(i, f"The cat{i % 7} sat on the mat {i}") for i in range(40)]
    rows += [(100, None), (101, ""), (None, "the  THE\tthe"), (3, "The cat3 sat on the mat 3"), (104, "the " * 30000)]
    out = hmm_lm.language_model_scores(docs_of(rows), states=2, rounds=2, symbols=12).collect()
    counts = Counter()
    for i, t in rows:
        if not held("" if i is None else i, 7):
            counts.update((t or "").encode().lower().split() + [b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        words = (t or "").encode().lower().split() + [b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want.append((i, held("" if i is None else i, 7), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(math.isfinite(r["score"]) for r in out)


def test_one_state_is_the_base_model(docs_of):
    rows = [(i, f"a b c{i % 5} d{i}") for i in range(30)]
    for r in hmm_lm.language_model_scores(docs_of(rows), states=1, rounds=0, symbols=6).collect():
        assert r["score"] == pytest.approx(r["base_score"], rel=1e-9)


def test_model_beats_the_base_on_held_out_texts(documents):
    out = [r for r in hmm_lm.language_model_scores(documents, rounds=4).collect() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_language_model_of_nothing(docs_of):
    assert hmm_lm.language_model_scores(docs_of([]), rounds=1).count() == 0
    unseen = next(i for i in range(100) if held(i, 7))
    row = hmm_lm.language_model_scores(docs_of([(unseen, "a b")]), rounds=1).first()
    assert (row["n_known"], row["train_tokens"]) == (0, 0) and math.isfinite(row["score"])


def test_slices():
    assert list(slices([3, 3, 9, 1], 6)) == [(0, 2), (2, 3), (3, 4)] and list(slices([], 5)) == []
