import numpy as np
import pytest

from agoralens.llm import hard_negatives as H

KIND = "vec_id bigint, embedding array<float>, label int, rank string, goal int, block int"
SMALL = {"sample": 50, "cell_rows": 8, "block": 40}


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], y, "r", 1, 2) for i, v, y in rows], KIND
    )


def brute(rows, anchors, positives=5, negatives=5, low=80, high=100):
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows]
    out = set()
    for q, a, label in whole:
        if q not in anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, y) for i, v, y in whole if i != q and len(v) == len(a))
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and -low * minus <= -100 * s[0] <= -high * minus]
            out |= {(q, p, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fit[:negatives], 1)}
    return out


def mined(df, anchors, **options):
    found = [tuple(r) for r in H.hard_negatives(df, anchors, **options).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("clustered", [False, True])
def test_equals_comparing_all_rows(spark, clustered):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 10)) * clustered
    rows = [(i, centres[i % 12] + rng.normal(size=10) * 0.4, int(rng.integers(4))) for i in range(700)]
    df = frame(spark, rows)
    want = brute(rows, range(0, 700, 25))
    assert len(want) > 100
    assert mined(df, df.where("vec_id % 25 = 0"), **SMALL) == want


def test_pruning_visits_fewer_cells_and_loses_nothing():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(30, 8)) * 5, 20, axis=0) + rng.normal(size=(600, 8)) * 0.1
    near = [H.nearest_code(h, H.k_means(h, 12)) for h in H.halves(x)]
    books = [H.k_means(h, 12) for h in H.halves(x)]
    radii = [np.array([r[n == c].max(initial=0) for c in range(12)]) for n, r in near]
    cell = near[0][0] * 12 + near[1][0]
    rows = np.bincount(cell, minlength=144)
    directory = H.Directory(books, radii, rows, rows * 0, rows * 0 + 1)
    seen = 0
    for q in x[::40]:
        scores = x @ q
        low = np.sort(scores)[-5]
        cells = H.visited_cells(directory, q, low)
        assert set(cell[scores >= low]) <= set(cells)
        seen += rows[cells].sum()
    assert seen < 0.5 * len(x) * len(x[::40])


def test_pairs_come_in_descending_order():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=7), rng.normal(size=9)
    pairs = list(H.multi_sequence(a, b))
    assert {p[:2] for p in pairs} == {(i, j) for i in range(7) for j in range(9)} and len(pairs) == 63
    assert [p[2] for p in pairs] == sorted((a[i] + b[j] for i, j, _ in pairs), reverse=True)
    assert list(H.multi_sequence(a[:0], b)) == []


def test_copies_and_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1, 0, 0.5], i % 2) for i in range(300)] + [(i, [0.9, 0.1, 0.5], i % 3) for i in range(300, 330)]
    df = frame(spark, rows)
    assert mined(df, df.where("vec_id % 100 = 0"), **SMALL) == brute(rows, {0, 100, 200, 300})


def test_large_cells_are_cut_and_no_row_is_lost():
    counts = np.array([0, 3, 100, 5, 4, 0, 9])
    first, parts, blocks = H._blocks(counts, 10)
    held = np.zeros(blocks)
    for cell in np.flatnonzero(counts):
        for n in range(counts[cell]):
            held[first[cell] + n % parts[cell]] += 1
    assert held.sum() == counts.sum() and held.max() <= 20


def test_odd_rows_take_no_part(spark):
    odd = [(200, None, 1), (300, [1, None], 1), (400, [float("nan"), 1], 1), (500, [float("inf"), 1], 1), (600, [1, 1], None)]
    odd += [(None, [1, 1], 0), (700, [], 1), (800, [1e30, 1], 1)]
    rows = [(0, [1, 0], 0), (1, [1, 0.5], 0), (2, [0.9, 0], 1), (3, [0.1, 3], 1), (4, [-1, 0], 0), (5, [0, 0], 0), (6, [0, 1], 1)]
    df = frame(spark, rows + odd)
    assert mined(df, df.where("vec_id % 100 = 0")) == brute(rows, {0})
    assert mined(df.limit(0), df) == mined(df, df.limit(0)) == set()


def test_lengths_are_mined_by_themselves(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=2 + i % 3), int(rng.integers(2))) for i in range(150)]
    df = frame(spark, rows)
    assert mined(df, df.where("vec_id % 10 = 0"), **SMALL) == brute(rows, range(0, 150, 10))


def test_repeated_ids(spark):
    rows = [(0, [1, 0], 0), (0, [1, 0], 0), (1, [1, 0], 0), (1, [1, 0], 0), (2, [0.9, 0], 1), (2, [0.9, 0], 1)]
    df = frame(spark, rows)
    got = [tuple(r) for r in H.hard_negatives(df, df.where("vec_id = 0")).collect()]
    assert sorted(got) == sorted([(0, 1, rank, 2, 65536, 58880) for rank in (1, 2)] * 2)


def test_wide_components_keep_whole_scores(spark):
    rows = [(0, [70000.0, 3.0], 0), (1, [70001.0, 5.0], 0), (2, [69999.0, 7.0], 1), (3, [70000.0, 1.0], 1)]
    df = frame(spark, rows)
    assert mined(df, df.where("vec_id = 0")) == brute(rows, {0})
