import numpy as np
import pytest

from agoralens.llm.collision_ann import nearest

KIND = "vec_id bigint, embedding array<float>, score string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "s", 1) for i, v in rows], KIND)


def brute(rows, queries, k):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q in queries:
        scored = sorted((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=24) * rng.uniform(0.5, 2)) for i in range(1500)]
    df = frame(spark, rows)
    got = found(nearest(df, df.where("vec_id % 20 = 0"), 20, block=400, query_block=30))
    want = brute(rows, range(0, 1500, 20), 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    good = dict(rows)
    for q, best in got.items():
        assert [s for _, s in best] == sorted((s for _, s in best), reverse=True)
        for i, s in best:
            assert s == pytest.approx(float(np.float32(good[q]).astype(float) @ np.float32(good[i]).astype(float)), rel=1e-12)


def test_ties_and_copies_go_to_the_smaller_id(spark):
    rows = [(i, [1, 0, 0]) for i in range(300)] + [(i, [0.5, 0.5, 0.1]) for i in range(300, 320)]
    df = frame(spark, rows)
    got = found(nearest(df, df.where("vec_id % 20 = 0"), 20, block=64))
    assert [i for i, _ in got[0]] == list(range(1, 21))
    assert [i for i, _ in got[100]] == list(range(20))


def test_odd_vectors_take_no_part(spark):
    odd = [(20, None), (40, [0, 0]), (60, [1, None]), (80, [float("nan"), 1]), (100, [float("inf"), 1]), (120, [1, 2, 3]), (None, [1, 1]), (140, [])]
    rows = [(0, [1, 0]), (1, [0, 2]), (2, [-1, 0]), (3, [3, 3])]
    df = frame(spark, rows + odd)
    got = found(nearest(df, df.where("vec_id % 20 = 0"), 20))
    assert {q: [i for i, _ in best] for q, best in got.items()} == {0: [3, 1, 2]}
    assert nearest(df.limit(0), df, 5).count() == nearest(df, df.limit(0), 5).count() == 0


def test_lengths_are_searched_by_themselves(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=2 + i % 3)) for i in range(240)]
    df = frame(spark, rows)
    got = found(nearest(df, df.where("vec_id % 20 = 0"), 5))
    want = {}
    for size in (2, 3, 4):
        alike = [r for r in rows if len(r[1]) == size]
        want |= brute(alike, [i for i, _ in alike if i % 20 == 0], 5)
    assert got.keys() == want.keys()
    assert sum([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want) >= 0.9 * len(want)


def test_repeated_ids(spark):
    df = frame(spark, [(0, [1, 0]), (0, [0, 1]), (1, [3, 1]), (1, [3, 1]), (2, [1, 5])])
    got = found(nearest(df, df.where("vec_id = 0"), 5))
    assert got == {0: [(2, 5.0), (1, 1.0), (1, 1.0)]}  # asked with [0, 1], the least of its vectors
    assert found(nearest(df, df.where("vec_id = 0").limit(0), 5)) == {}
