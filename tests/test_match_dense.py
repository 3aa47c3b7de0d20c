import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from agoralens.operators import match, match_dense


def frames(spark, opinions, topics, ids=None):
    def row(x):
        return None if x is None else [float(v) for v in x]

    left = [(f"o{i:03}", row(x), "kept") for i, x in enumerate(opinions)]
    right = [(f"p{i:03}", ids[i] if ids else f"t{i:03}", row(x)) for i, x in enumerate(topics)]
    return (
        spark.createDataFrame(left, "opinion_id string, vector array<double>, extra string"),
        spark.createDataFrame(right, "point_id string, topic_id string, vector array<double>"),
    )


def clustered(rng, rows, centres):
    return list(centres[np.arange(rows) % len(centres)] + 0.1 * rng.normal(size=(rows, centres.shape[1])))


def brute(opinions, topics, ids, k):
    t = np.array(topics) / np.linalg.norm(topics, axis=1, keepdims=True)
    out = {}
    for i, o in enumerate(opinions):
        score = np.round(t @ o / np.linalg.norm(o), 9)
        out[f"o{i:03}"] = [(f"p{j:03}", ids[j]) for j in sorted(range(len(t)), key=lambda j: (-score[j], ids[j], j))[:k]]
    return out


@pytest.mark.parametrize("options", [{}, {"topic_rows": 11, "opinion_rows": 9}, {"n_cells": 3, "topic_rows": 30}])
def test_cells_give_the_hits_of_all_pairs(spark, options):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(15, 8))
    opinions, topics = clustered(rng, 70, centres), clustered(rng, 300, centres)
    topics[4] = topics[9] = topics[2] * 3
    ids = [f"t{i % 40:03}" for i in range(300)]
    left, right = frames(spark, opinions, topics, ids)
    got = match.topic_hits(left, right, k=5, plan="cells", keep=("extra",), **options)
    assert got.columns == ["opinion_id", "extra", "hits"]
    assert {r["opinion_id"]: [h[:2] for h in r["hits"]] for r in got.collect()} == brute(opinions, topics, ids, 5)


def test_auto_takes_the_cells_beyond_the_bound(spark, monkeypatch):
    rng = np.random.default_rng(2)
    left, right = frames(spark, list(rng.normal(size=(20, 5))), list(rng.normal(size=(30, 5))))
    asked = []
    monkeypatch.setattr(match_dense, "cell_hits", lambda *a: asked.append(a) or left)
    match.topic_hits(left, right, broadcast_bytes=64)
    assert len(asked) == 1


def test_fewer_pairs_and_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    left, right = frames(spark, clustered(rng, 200, centres), clustered(rng, 1000, centres))
    rows = {r["nprobe"]: r for r in match_dense.probe_report(left, right, 5, 16, (1, 8), topic_rows=100).collect()}
    assert rows[0]["recall"] == 1 and rows[0]["share"] < 1 / 3
    assert rows[8]["recall"] >= 0.95 and rows[8]["share"] < 0.4 and rows[1]["recall"] <= rows[8]["recall"]


def test_bounds_hold_and_leading_cells_come_first():
    rng = np.random.default_rng(4)
    t = rng.normal(size=(200, 6))
    t /= np.linalg.norm(t, axis=1, keepdims=True)
    cells = match_dense.Cells(t[:9] * 2)
    at = cells.angles(t).argmin(axis=1)
    for c in range(9):
        cells.sizes[c] = (at == c).sum()
        cells.radius[c] = cells.angles(t)[at == c, c].max()
    cells.sizes[3] = 0
    o = t[50:60]
    for i, row in enumerate(o):
        for c in range(9):
            assert (t[at == c] @ row <= cells.bounds(o)[i, c] + 1e-9).all() or c == 3
    lead = cells.leading(o, 40)
    for i in range(10):
        assert cells.sizes[lead[i]].sum() >= 40 and not lead[i, 3]
        assert cells.bounds(o)[i, lead[i]].min() >= cells.bounds(o)[i, ~lead[i]].max()
    assert (cells.nearest(o, 2).sum(axis=1) == 2).all()


def test_blocks_hold_all_rows():
    sizes = np.array([0, 5, 3, 40, 2, 2, 9])
    first, parts, blocks = match_dense.pack_cells(sizes, 10)
    assert parts.tolist() == [1, 1, 1, 4, 1, 1, 1]
    held = np.zeros(blocks)
    for c, n in enumerate(sizes):
        for p in range(parts[c]):
            held[first[c] + p] += n / parts[c]
    assert held.sum() == sizes.sum() and held.max() <= 13


def test_odd_tables(spark):
    odd = [[float("nan"), 1], [float("inf"), 1], [0, 0], None]
    left, right = frames(spark, [[1, 1], *odd], [[1, 0], *odd, [0, 1], [1, 0]])
    got = {r["opinion_id"]: r["hits"] for r in match.topic_hits(left, right, k=5, plan="cells").collect()}
    assert [h["point_id"] for h in got.pop("o000")] == ["p000", "p005", "p006"] and all(not h for h in got.values()) and len(got) == 4
    assert [r["hits"] for r in match.topic_hits(left, right.limit(0), plan="cells").collect()] == [None] * 5
    assert match.topic_hits(left.limit(0), right, plan="cells").count() == 0


def many_ties(rng, rows, dim):
    """Unit rows, half of them copies of a few."""
    x = rng.normal(size=(rows, dim))
    x[::2] = x[: rows // 2 : 4][rng.integers(0, len(x[: rows // 2 : 4]), len(x[::2]))]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_tiles_keep_the_best_of_all_and_their_ties(monkeypatch):
    rng = np.random.default_rng(5)
    unit, topics = many_ties(rng, 60, 4), many_ties(rng, 500, 4)
    monkeypatch.setattr(match, "TILE_COLUMNS", 37)
    monkeypatch.setattr(match, "TILE", 37 * 11)
    best = np.full((60, 5), match.LEAST)
    # Two matrices whose places lie between each other, as those of two cells.
    for at in (np.arange(1, 500, 3), np.setdiff1d(np.arange(500), np.arange(1, 500, 3))):
        match.keep_nearest(best, unit, topics[at], at, 500)
    score = np.rint(unit @ topics.T * match.SCALE)
    for i in range(60):
        assert (499 - best[i] % 500).tolist() == sorted(range(500), key=lambda j: (-score[i, j], j))[:5]


def test_small_blocks_grow_before_they_are_copied_often():
    assert match.block_rows(900, 256, 512) == 256
    for rows in (10_000, 100_000, 400_000):
        size = match.block_rows(rows, 256, 512)
        assert -(-rows // size) <= match.COPIES and 512 * size <= match.BLOCK_BYTES
    assert 512 * match.block_rows(10**8, 256, 512) == match.BLOCK_BYTES


def test_one_stored_row_for_the_visits_of_an_opinion(spark):
    rng = np.random.default_rng(6)
    left, right = frames(spark, list(rng.normal(size=(50, 8))), list(rng.normal(size=(400, 8))))
    file = match_dense.InvertedFile(right, 8, 10)
    visits = file.visits(match_dense.asked_rows(left), rows=400).collect()
    assert len(visits) == 50 and all(len(r["visits"]) == file.blocks for r in visits)
    assert {sum(v["pairs"] for v in r["visits"]) for r in visits} == {400}


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


class Sent:
    def __init__(self, value):
        self.value = value


def test_memory_of_a_batch_does_not_grow_with_the_cells():
    rng = np.random.default_rng(7)
    cells = match_dense.Cells(rng.normal(size=(1000, 4)))
    cells.sizes[:] = 5
    places = match_dense.pack_cells(cells.sizes, 500)[:2]
    batch = pa.RecordBatch.from_pydict({"o": np.arange(3000), "vector": list(rng.normal(size=(3000, 4)))})

    def run():
        for _ in match_dense._visits(Sent((cells, *places)), 4, 160, None, None)([batch]):
            pass

    assert peak_mb(run) < 100


def test_memory_of_a_block_does_not_grow_with_a_cell():
    rng = np.random.default_rng(8)
    n = 3000
    topics = pa.table({"point_id": [f"{i}" for i in range(n)], "topic_id": ["t"] * n, "vector": list(rng.normal(size=(n, 4))), "cell": [0] * n})
    visits = pa.table({"o": range(n), "vector": list(rng.normal(size=(n, 4))), "floor": [-2.0] * n, "cells": [[0]] * n})
    visits = visits.set_column(3, "cells", pa.array([[0]] * n, pa.list_(pa.int32())))
    assert peak_mb(lambda: match_dense._score_cells(4, 5)(visits, topics)) < 100
