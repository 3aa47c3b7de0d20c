import numpy as np
import pytest
from pyspark.sql import functions as F

from agoralens.operators.encode import TfIdfEncoder
from agoralens.operators.epochs import Weights, read_weights, train_epochs, with_positions
from agoralens.operators.split import stratified_split

DIM = 30
KIND = "opinion_id int, type string, vector struct<indices:array<int>,values:array<double>>, extra string"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = []
    for i in range(240):
        y = i % 5 % 3
        f = np.unique(np.append(rng.integers(0, DIM, 4), y * 7 + rng.integers(0, 3)))
        out.append((i, "abc"[y], (f.tolist(), rng.uniform(0.2, 1, len(f)).tolist()), "e"))
    out += [(900, "a", None, "e"), (901, None, ([1], [1.0]), "e"), (902, "b", ([], []), "e")]
    return out


def loop(df, epochs, steps, rate, penalty):
    """The same in plain numpy over dense rows."""
    split = {r["opinion_id"]: r["is_validation"] for r in stratified_split(df.select("opinion_id", "type"), "type").collect()}
    number = F.pmod(F.xxhash64("opinion_id", F.lit(42)), F.lit(steps))
    data = [r for r in df.withColumn("n", number).collect() if r["opinion_id"] in split]
    x = np.zeros((len(data), DIM + 1))
    x[:, -1] = 1
    for row, r in zip(x, data):
        if r["vector"]:
            row[r["vector"]["indices"]] = r["vector"]["values"]
    labels = sorted({r["type"] for r in data})
    y = np.array([labels.index(r["type"]) for r in data])
    held = np.array([split[r["opinion_id"]] for r in data])
    slices = np.array([r["n"] for r in data])
    count = np.bincount(y[~held])
    w = (count.sum() / (len(labels) * count))[y]
    weight, squares = np.zeros((2, DIM + 1, len(labels)))

    def shares(at):
        e = np.exp(x[at] @ weight)
        return e / e.sum(axis=1, keepdims=True)

    history = []
    for epoch in range(1, epochs + 1):
        loss = hits = 0.0
        for s in range(steps):
            at = np.flatnonzero(~held & (slices == s))
            p = shares(at)
            loss += (-np.log(p[np.arange(len(at)), y[at]]) * w[at]).sum()
            hits += (np.round(p, 9).argmax(axis=1) == y[at]).sum()
            p[np.arange(len(at)), y[at]] -= 1
            g = x[at].T @ (p * w[at][:, None]) / w[at].sum()
            g[:-1] += penalty * weight[:-1]
            squares += g * g
            weight = weight - rate * g / np.sqrt(squares + 1e-8)
        p = shares(held)
        val = -np.log(p[np.arange(len(p)), y[held]]).mean()
        history.append((epoch, loss / w[~held].sum(), hits / (~held).sum(), val, (np.round(p, 9).argmax(1) == y[held]).mean()))
    return history, weight, labels


@pytest.mark.parametrize("steps", [1, 3])
def test_equals_a_plain_loop(spark, rows, steps):
    df = spark.createDataFrame(rows, KIND).repartition(5)
    run = train_epochs(df, DIM, epochs=4, steps=steps, rate=0.3, penalty=0.01)
    history, weight, labels = loop(df, 4, steps, 0.3, 0.01)
    got = sorted(tuple(r) for r in run.history.collect())
    assert [g[0] for g in got] == [1, 2, 3, 4] and np.allclose(np.array(got), np.array(history), atol=1e-9)
    model, last = read_weights(run.coefficients, labels, DIM)
    assert last == 4 and np.allclose(model.weight, weight, atol=1e-9)
    assert got[-1][1] < got[0][1] and got[-1][4] > 0.6
    assert run.split.count() == 242 and run.split.columns == ["opinion_id", "type", "is_validation"]


def test_a_stopped_run_goes_on(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, KIND)
    whole = train_epochs(df, DIM, epochs=4, steps=2)
    first = train_epochs(df, DIM, epochs=1, steps=2, path=str(tmp_path / "c"))
    second = train_epochs(df, DIM, epochs=3, steps=2, start=first.coefficients, path=str(tmp_path / "c"))
    parts = sorted(tuple(r) for r in first.history.unionByName(second.history).collect())
    assert np.allclose(np.array(parts), np.array(sorted(tuple(r) for r in whole.history.collect())), atol=1e-12)
    assert {r[0] for r in spark.read.parquet(f"{tmp_path}/c/*").select("epoch").distinct().collect()} == {1, 2, 3, 4}
    one, epoch = read_weights(whole.coefficients, "abc", DIM, epoch=2)
    two, _ = read_weights(second.coefficients, "abc", DIM, epoch=2)
    assert epoch == 2 and np.allclose(one.weight, two.weight, atol=1e-12) and np.abs(one.weight).max() > 0.1


def test_a_start_of_another_task_is_an_error(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    run = train_epochs(df, DIM, epochs=1)
    with pytest.raises(ValueError, match="another task"):
        read_weights(run.coefficients, ["a", "b"], DIM)
    with pytest.raises(ValueError, match="another task"):
        read_weights(run.coefficients, ["a", "b", "c"], 3)


def test_scores(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    run = train_epochs(df, DIM, epochs=3)
    out = with_positions(df, run.coefficients, ["c", "a", "b"], DIM).collect()
    model, _ = read_weights(run.coefficients, "abc", DIM)
    assert len(out) == len(rows) and out[0]["extra"] == "e"
    for r in out:
        x = np.zeros(DIM + 1)
        x[-1] = 1
        if r["vector"]:
            x[r["vector"]["indices"]] = r["vector"]["values"]
        e = np.exp(x @ model.weight)
        assert r["probabilities"] == pytest.approx((e / e.sum()).tolist())
        assert r["type_confidence"] == max(r["probabilities"]) and r["predicted_type"] == "abc"[int(np.argmax(r["probabilities"]))]


def test_equal_shares_choose_the_first_label(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    none = train_epochs(df, DIM, epochs=0)
    assert none.history.count() == none.coefficients.count() == 0
    assert {r["predicted_type"] for r in with_positions(df, none.coefficients, "abc", DIM).collect()} == {"a"}
    assert Weights.zero("ab", 3).table(1).num_rows == 0


def test_empty_and_single_class(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    assert train_epochs(df.limit(0), DIM).history.count() == 0
    assert train_epochs(df.filter("type is null"), DIM).split.count() == 0
    only = [tuple(r) for r in train_epochs(df.filter("type = 'a'"), DIM, epochs=2).history.collect()]
    assert [(r[2], r[4]) for r in only] == [(1.0, 1.0)] * 2


def test_hashed_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id AS opinion_id", "text", "lang AS type")
    rows = TfIdfEncoder.fit(docs, dim=1024)(docs)
    history = sorted(tuple(r) for r in train_epochs(rows, 1024, epochs=5, steps=2).history.collect())
    assert history[-1][4] >= 0.9 and history[-1][3] < history[0][3]
