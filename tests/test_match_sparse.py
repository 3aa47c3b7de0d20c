import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from agoralens.operators import encode, match, match_sparse
from agoralens.plans import match_queries

DIM = 40
VECTOR = "vector struct<indices:array<int>,values:array<double>>"


def sparse(x):
    if x is None:
        return None
    f = np.flatnonzero(x)
    return (f.tolist(), x[f].tolist())


def frames(spark, opinions, topics, ids=None):
    left = [(f"o{i:03}", sparse(x), "kept") for i, x in enumerate(opinions)]
    right = [(f"p{i:03}", ids[i] if ids else f"t{i:03}", sparse(x)) for i, x in enumerate(topics)]
    return (
        spark.createDataFrame(left, f"opinion_id string, {VECTOR}, extra string"),
        spark.createDataFrame(right, f"point_id string, topic_id string, {VECTOR}"),
    )


def skewed(rng, rows):
    """Rows whose buckets are drawn by a steep law, with one bucket that all of them share."""
    share = 1 / np.arange(1, DIM + 1) ** 1.1
    out = np.zeros((rows, DIM))
    for x in out:
        at = rng.choice(DIM, 6, p=share / share.sum(), replace=False)
        x[at] = rng.uniform(0.1, 1, 6) * np.log(2 + at)
        x[0] = 0.05
    return list(out)


def hits_of(df):
    return {r["opinion_id"]: [tuple(h) for h in r["hits"]] if r["hits"] is not None else None for r in df.collect()}


def brute(opinions, topics, ids, k):
    unit = [None if x is None or not np.any(x) or not np.isfinite(x).all() else x / np.linalg.norm(x) for x in topics]
    out = {}
    for i, o in enumerate(opinions):
        if o is None or not np.any(o) or not np.isfinite(o).all():
            out[f"o{i:03}"] = None
            continue
        o = o / np.linalg.norm(o)
        scored = sorted((-round(float(o @ t), 9), ids[j], f"p{j:03}") for j, t in enumerate(unit) if t is not None)
        out[f"o{i:03}"] = [(p, t, -s) for s, t, p in scored[:k]]
    return out


def agree(got, want):
    assert got.keys() == want.keys()
    for key, hits in want.items():
        if hits is None:
            assert got[key] is None
        else:
            assert [h[:2] for h in got[key]] == [h[:2] for h in hits], key
            assert [h[2] for h in got[key]] == pytest.approx([h[2] for h in hits], abs=2e-9)


@pytest.mark.parametrize("k", [1, 5])
def test_lists_give_the_hits_of_all_pairs(spark, k):
    rng = np.random.default_rng(k)
    opinions, topics = skewed(rng, 90), skewed(rng, 120)
    topics[7] = topics[3] * 2  # a tie
    topics[9], topics[10], opinions[4], opinions[5] = np.zeros(DIM), None, None, np.zeros(DIM)
    opinions[6] = np.full(DIM, np.nan)
    ids = [f"t{i % 11:03}" for i in range(120)]
    left, right = frames(spark, opinions, topics, ids)
    got = match.topic_hits(left, right, k=k, dim=DIM, plan="lists", keep=("extra",), topic_rows=16, opinion_rows=20)
    assert got.columns == ["opinion_id", "extra", "hits"]
    agree(hits_of(got), brute(opinions, topics, ids, k))


def test_bounds_are_met_and_spare_most_pairs(spark):
    rng = np.random.default_rng(8)
    # Each row is in a small group of its own buckets and holds one bucket that all share.
    def rows(n):
        out = np.zeros((n, DIM))
        for i, x in enumerate(out):
            x[1 + 3 * (i % 13) : 4 + 3 * (i % 13)] = rng.uniform(0.5, 1, 3)
            x[0] = 0.02
        return list(out)

    opinions, topics = rows(104), rows(260)
    left, right = frames(spark, opinions, topics)
    report = match_sparse.pair_report(left, right, 5, DIM).first()
    assert report["pairs"] == 104 * 260 and report["entries"] == 104 * (260 + 3 * 20)
    assert report["entries_read"] <= 104 * 3 * 20  # the shared bucket is not read
    assert report["pairs_scored"] <= 0.1 * report["pairs"]
    agree(hits_of(match.topic_hits(left, right, k=5, dim=DIM, plan="lists")), brute(opinions, topics, [f"t{i:03}" for i in range(260)], 5))


def test_frequent_buckets_are_cut_in_blocks(spark):
    rng = np.random.default_rng(9)
    opinions, topics = skewed(rng, 60), skewed(rng, 70)
    left, right = frames(spark, opinions, topics)
    lists = match_sparse.Lists(right, DIM, champions=2)
    asked = match_sparse.asked_rows(left, lists, 5, ["opinion_id"])
    whole = match_sparse.candidate_pairs(asked, lists, 3)
    cut = match_sparse.candidate_pairs(asked, lists, 3, list_rows=4, readers=5)
    key = ("o", "t", "block")
    assert sorted(whole.select(*key).collect()) == sorted(cut.select(*key).collect()) and whole.count() > 60


def test_reached_scores_are_lower_bounds():
    rng = np.random.default_rng(10)
    topics, x = np.array(skewed(rng, 80)), np.array(skewed(rng, 30))
    topics /= np.linalg.norm(topics, axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    start, topic, weight = [0], [], []
    for b in range(DIM):
        best = np.argsort(-topics[:, b], kind="stable")[:6]
        best = best[topics[best, b] > 0]
        topic += best.tolist()
        weight += topics[best, b].tolist()
        start.append(len(topic))
    most = topics.max(axis=0)
    rows, buckets = np.nonzero(x)
    lists = (np.array(start), np.array(topic), np.array(weight), most)
    reached = match_sparse.reached_scores(rows, buckets, x[rows, buckets], 30, lists, 5, leading=4)
    exact = x @ topics.T
    assert (reached <= np.sort(exact, axis=1)[:, -5] + 1e-12).all() and (reached > 0).any()
    need, rest = match_sparse.needed_buckets(rows, buckets, x[rows, buckets], reached, most)
    for i in range(30):
        spared = buckets[(rows == i) & ~need]
        assert rest[i] == pytest.approx((x[i, spared] * most[spared]).sum()) and rest[i] < max(reached[i], 1e-12)
        for t in np.flatnonzero(exact[i] >= reached[i]):
            assert x[i, buckets[(rows == i) & need]] @ topics[t, buckets[(rows == i) & need]] + rest[i] >= reached[i] - 1e-9


def test_few_topics_and_rows_that_share_no_bucket(spark):
    unit = np.eye(DIM)
    opinions, topics = [unit[0], unit[5], unit[0] + unit[1]], [unit[2], unit[1], unit[0], unit[3]]
    left, right = frames(spark, opinions, topics)
    ids = [f"t{i:03}" for i in range(4)]
    for k in (1, 3, 9):
        agree(hits_of(match.topic_hits(left, right, k=k, dim=DIM, plan="lists")), brute(opinions, topics, ids, k))
    none = match.topic_hits(left, right.limit(0), k=3, dim=DIM, plan="lists").collect()
    assert [r["hits"] for r in none] == [None] * 3
    assert match.topic_hits(left.limit(0), right, k=3, dim=DIM, plan="lists").count() == 0


def test_weights_below_zero_take_the_blocks(spark):
    rng = np.random.default_rng(11)
    opinions, topics = ([x * rng.choice([-1, 1], DIM) for x in skewed(rng, 20)] for _ in range(2))
    left, right = frames(spark, opinions, topics)
    agree(hits_of(match.topic_hits(left, right, k=4, dim=DIM, broadcast_bytes=8)), brute(opinions, topics, [f"t{i:03}" for i in range(20)], 4))


def test_no_cross_join_and_no_pair_of_all_blocks(spark):
    left, right = frames(spark, skewed(np.random.default_rng(1), 9), skewed(np.random.default_rng(2), 9))
    lists = match_sparse.Lists(right, DIM)
    pairs = match_sparse.candidate_pairs(match_sparse.asked_rows(left, lists, 2, ["opinion_id"]), lists, 2)
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


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


def wide(rng, rows, entries):
    """A column of sparse vectors."""
    at = pa.array(np.arange(rows + 1, dtype=np.int32) * entries)
    flat = [pa.array(np.tile(np.arange(entries, dtype=np.int32), rows)), pa.array(rng.uniform(0.1, 1, rows * entries))]
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(at, x) for x in flat], names=["indices", "values"])


def test_memory_does_not_grow_with_the_postings_that_a_batch_reads():
    rng = np.random.default_rng(12)
    column = wide(rng, 2000, 40)
    matrix = match.Postings(wide(rng, 150, 40), 40)
    names = pa.array([f"{i:03}" for i in range(150)])
    hits = []
    assert peak_mb(lambda: hits.append(match._hits(column, names, names, matrix, 5))) < 60  # 12 million products
    assert hits[0].slice(700, 9).to_pylist() == match._hits(column.slice(700, 9), names, names, matrix, 5).to_pylist()


def test_memory_does_not_grow_with_the_champions_that_a_batch_meets():
    rng = np.random.default_rng(13)
    lists = (np.arange(41) * 32, rng.integers(0, 500, 1280), rng.uniform(0.1, 1, 1280), np.ones(40))
    column = wide(rng, 6000, 40)
    batch = pa.RecordBatch.from_arrays([column.field(0), column.field(1)], names=["f", "w"])
    parts = []
    assert peak_mb(lambda: parts.extend(match_sparse._asked(Sent(lists), 5)([batch]))) < 100
    assert sum(p.num_rows for p in parts) == 6000


def test_memory_does_not_grow_with_the_words_of_a_batch():
    words = pa.array([[f"w{(i * j) % 97}" for j in range(700)] for i in range(3000)] + [None, []])
    whole = encode.count_buckets(words, DIM)
    got = []
    assert peak_mb(lambda: got.extend(encode.count_buckets(p, DIM) for p in encode.word_slices(words))) < 30
    assert [x.tolist() for x in whole[1:]] == [np.concatenate([g[i] for g in got]).tolist() for i in (1, 2)]
    assert sum(len(p) for p in encode.word_slices(words)) == 3002


def python_steps(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("MapInArrow") + plan.count("ArrowEvalPython")


@pytest.mark.parametrize("name", ["text_match_pairs", "study_tables", "text_match_lists", "text_match_best"])
def test_a_task_has_one_python_worker(spark, tmp_path, monkeypatch, name):
    docs = [(i, f"wort{i % 7} und {'x' * (i % 5 + 1)}" if i % 6 else None, "de", f"s{i % 3}") for i in range(30)]
    docs += docs[:4] + [(None, "und wort1", None, None)]
    items = [(i, f"wort{i} {'x' * i}" if i else None) for i in range(5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    steps = []

    def kept(real):
        return lambda df, label="step": (steps.append((label, python_steps(df))), real(df, label))[1]

    for module in (match_sparse, match_queries):
        monkeypatch.setattr(module, "settled", kept(module.settled))
    real = match._broadcast_hits
    found = lambda *a: (lambda df: (steps.append(("hits", python_steps(df))), df)[1])(real(*a))
    monkeypatch.setattr(match, "_broadcast_hits", found)
    rows = getattr(match_queries, name)(spark, str(tmp_path))
    assert rows.count() > 0
    steps = dict(steps)
    assert steps.get("match-asked", 1) == steps.get("hits", 1) == steps["text-opinions"] == 1
    assert "match-asked" in steps or "hits" in steps


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_not_shuffled_and_vectors_are_stored_once(spark):
    left, right = frames(spark, skewed(np.random.default_rng(3), 40), skewed(np.random.default_rng(4), 30))
    lists = match_sparse.Lists(right, DIM)
    asked = match_sparse.asked_rows(left, lists, 2, ["opinion_id"])
    assert [c for c, kind in asked.dtypes if kind.startswith("array")] == ["f", "w"]
    for blocks in (1, 3):
        pairs = match_sparse.candidate_pairs(asked, lists, blocks)
        assert not {"Exchange", "Join", "Sort"} & set(re.findall("Exchange|Join|Sort", plan_of(pairs)))
        assert pairs.count() > 40 and pairs.select("block").distinct().count() == blocks


def test_pair_counts_do_not_depend_on_the_blocks(spark, monkeypatch):
    rng = np.random.default_rng(14)
    opinions, topics = skewed(rng, 60), skewed(rng, 90)
    opinions[3], topics[5], topics[6] = None, np.zeros(DIM), topics[7]
    left, right = frames(spark, opinions, topics)
    left = left.unionAll(left.limit(5))
    whole = match_sparse.pair_report(left, right, 3, DIM).first()
    monkeypatch.setattr(match_sparse, "BLOCK_BYTES", 1500)
    sent = []
    real = match_sparse.Lists.sent_block
    monkeypatch.setattr(match_sparse.Lists, "sent_block", lambda *a: (sent.append(a[1]), real(*a))[1])
    assert match_sparse.pair_report(left, right, 3, DIM).first() == whole
    assert len(sent) > 3 and all(a[1] + 1 == b[0] for a, b in zip(sent, sent[1:]))
    some = [x for x in topics if np.any(x)]
    held = np.array([sum(x[b] > 0 for x in some) for b in range(DIM)])
    asked = [x for x in [*opinions, *opinions[:5]] if x is not None]
    assert whole["pairs"] == len(asked) * 89 and whole["entries"] == sum(held[x > 0].sum() for x in asked)
    assert 0 < whole["entries_read"] <= whole["entries"] and 0 < whole["pairs_scored"] <= whole["pairs"]


def test_memory_does_not_grow_with_the_postings_that_opinions_read():
    rng = np.random.default_rng(15)
    names, right, left = pa.array([f"{i:03}" for i in range(150)]), wide(rng, 150, 40), wide(rng, 6000, 40)
    topics = pa.table({"t": pa.array(np.arange(150)), "point_id": names, "topic_id": names, "f": right.field(0), "w": right.field(1)})
    block = match_sparse.ListBlock(topics, 40, 64)
    zero = pa.array(np.zeros(6000))
    need = pa.array(np.full(6000, 40, np.int32))
    batch = pa.RecordBatch.from_arrays([left.field(0), left.field(1), need, zero, zero], names=["f", "w", "need", "reached", "rest"])
    found = []
    assert peak_mb(lambda: found.extend(len(x[2]) for x in match_sparse._visits([batch], block, 4096))) < 100  # 36 million products
    assert sum(found) == 6000 * 150


def test_hits_of_one_block_are_made_without_a_shuffle(spark):
    rng = np.random.default_rng(16)
    opinions, topics = skewed(rng, 40), skewed(rng, 30)
    left, right = frames(spark, opinions, topics)
    got = match.topic_hits(left, right, k=3, dim=DIM, plan="lists", keep=("extra",))
    assert not re.findall("Exchange|Join|Sort|CoGroups", plan_of(got))
    agree(hits_of(got), brute(opinions, topics, [f"t{i:03}" for i in range(30)], 3))


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_blocks_of_topics_store_the_k_best(spark, monkeypatch, block):
    rng = np.random.default_rng(17)
    opinions, topics = skewed(rng, 30), skewed(rng, 14)
    opinions[2], topics[3], topics[8], topics[11] = None, np.zeros(DIM), topics[1], topics[1] * 2
    ids = [None if i in (1, 5) else f"t{i % 4}" for i in range(14)]
    left, right = frames(spark, opinions, topics, ids)
    stored, sent = [], []
    real = match_sparse.settled
    monkeypatch.setattr(match_sparse, "settled", lambda df, name: (out := real(df, name), stored.append((name, out)))[0])
    kept = match_sparse.Lists.sent_block
    monkeypatch.setattr(match_sparse.Lists, "sent_block", lambda *a: (out := kept(*a), sent.append(out))[0])
    got = match.topic_hits(left, right, k=2, dim=DIM, plan="lists", topic_rows=block)
    want = brute(opinions, topics, [x or "" for x in ids], 2)
    got = {o: hits and [(p, t or "", s) for p, t, s in hits] for o, hits in hits_of(got).items()}
    agree(got, want)
    hits = [df for name, df in stored if name == "match-hits"]
    assert len(hits) == (0 if block == 1000 else len(sent)) and len(sent) == (1 if block == 1000 else -(-13 // block))
    assert all(df.columns == ["o", "found"] and df.filter("size(found) > 2").isEmpty() for df in hits)


def test_text_match_lists_gives_the_rows_of_text_match_topk_without_a_shuffle(spark, tmp_path):
    docs = [(i, f"wort{i % 7} und {'x' * (i % 5 + 1)} wort{i % 4}" if i % 6 else None, "de", f"s{i % 3}") for i in range(40)]
    docs += docs[:4] + [(None, "und wort1", None, None)]
    items = [(i, f"wort{i} {'x' * i}" if i else None) for i in range(12)] + [(3, "wort3 xxx")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got, want = match_queries.text_match_lists(spark, str(tmp_path)), match_queries.text_match_topk(spark, str(tmp_path))
    assert not re.findall("Exchange|Join|Sort|CoGroups", plan_of(got))
    rows = [sorted((r["opinion_id"] or "", r["rank"], r["topic_id"], round(r["score"], 8)) for r in df.collect()) for df in (got, want)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
