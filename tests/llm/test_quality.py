import zlib

import numpy as np
import pytest

from agoralens.llm import quality_trees as Q

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_rows(tables):
    docs, labels = tables
    rows = Q.quality(docs, labels).join(labels, "doc_id").collect()
    unseen = [r for r in rows if held(r["doc_id"])]
    good = [r for r in unseen if r["quality"] == 1]
    assert np.mean([r["predicted"] == r["quality"] for r in unseen]) >= 0.95
    assert np.mean([r["predicted"] for r in good]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_labels_are_not_seen(tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - quality, quality) AS quality")
    some = docs.where("doc_id < 60")
    assert Q.with_quality(some, Q.train(docs, labels)).collect() == Q.with_quality(some, Q.train(docs, flipped)).collect()


def plain_walk(model, row):
    total = model.bias
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return total


def test_flat_trees_are_walked_as_one_by_one():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6)).round(1)
    y = (x[:, 0] * x[:, 1] + 0.3 * x[:, 2] > 0).astype(float)
    model = Q.boost(x, y, np.arange(300) % 5 == 0, trees=30, depth=3)
    assert len(model.leaf) > 5 and model.margins(x[:0]).tolist() == []
    assert model.margins(x) == pytest.approx([plain_walk(model, r) for r in x])
    assert ((model.scores(x) > 0.5) == y).mean() > 0.9


def brute_tree(x, g, h, depth):
    """The prediction of a tree grown by trying every value of every column."""
    if depth:
        best = (1e-9, None)
        for f in range(x.shape[1]):
            for value in np.unique(x[:, f])[:-1]:
                go = x[:, f] <= value
                if min(h[go].sum(), h[~go].sum()) >= Q.LEAST_CURVATURE:
                    gain = sum(g[m].sum() ** 2 / (h[m].sum() + Q.PENALTY) for m in (go, ~go))
                    best = max(best, (gain - g.sum() ** 2 / (h.sum() + Q.PENALTY), (f, value)), key=lambda b: b[0])
        if best[1]:
            f, value = best[1]
            go, out = x[:, f] <= value, np.zeros(len(x))
            out[go], out[~go] = brute_tree(x[go], g[go], h[go], depth - 1), brute_tree(x[~go], g[~go], h[~go], depth - 1)
            return out
    return np.full(len(x), -Q.RATE * g.sum() / (h.sum() + Q.PENALTY))


def test_a_tree_against_trying_every_split():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 20, (250, 4)).astype(float)  # fewer values than bins: every split is an edge
    p = rng.uniform(0.2, 0.8, 250)
    y = (x[:, 1] > 11) * 1.0
    edges = [np.unique(c)[:-1] for c in x.T]
    feature, threshold, leaf, node = Q.grow(Q.binned(x, edges), edges, p - y, p * (1 - p), 3)
    assert leaf[node] == pytest.approx(brute_tree(x, p - y, p * (1 - p), 3))
    model = Q.Trees(feature[None], threshold[None], leaf[None], 0.0)
    assert model.margins(x) == pytest.approx(leaf[node])


def test_statistics_of_a_text():
    got = dict(zip(Q.STATISTICS, Q.statistics("Ab ab ab 12.\n\nÄ|\nÄ|\n")))
    assert len(Q.statistics("x")) == len(Q.STATISTICS) == len(got)
    octets = len("Ab ab ab 12.\n\nÄ|\nÄ|\n".encode())
    want = {
        "bar_share": 2 / octets, "high_share": 4 / octets, "digit_share": 2 / octets, "word_mean": 13 / 6,
        "different_share": 4 / 6, "commonest_share": 2 / 6, "different_pair_share": 1.0, "adjacent_repeat_share": 2 / 5 * 5 / 6,
        "title_share": 3 / 6, "blank_line_share": 2 / 5, "ended_line_share": 1 / 3, "repeated_line_share": 1 / 3,
        "line_longest_share": 12 / 16, "words_per_stop": 3.0,
    }
    assert {k: got[k] for k in want} == pytest.approx(want)
    assert not any(Q.statistics("")) and all(np.isfinite(Q.statistics(t)).all() for t in (" ", "\n", "\x00", "𝄞" * 9, "a" * 10**6))


def test_odd_rows(spark, docs_of):
    rows = [(i, f"A plain sentence number {i}. It goes on." if i % 2 else f"x | {i} | y | z |") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, 0), (None, 1), (3, None), (7000, 1)], "doc_id int, quality int")
    odd = [(None, None), (901, ""), (902, "idle words. " * 50000), (903, "a | b | 5 | y |"), (903, "a | b | 5 | y |"), (4, "A doubled id.")]
    out = Q.quality(docs_of(rows + odd), labels)
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append((r["score"], r["predicted"]))
    assert out.count() == 86 and out.columns.count("score") == 1
    assert got[903][0] == got[903][1] and got[902][0][0] > got[903][0][0] and got[None] == got[901]
    only = Q.quality(docs_of(rows), labels.where("quality = 1 and doc_id <> 1"))
    assert {r["predicted"] for r in only.collect()} == {1}
    assert {r["score"] for r in Q.quality(docs_of(rows), labels.limit(0)).collect()} == {0.5}
    assert Q.quality(docs_of([]), labels).count() == 0
