import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from agoralens.llm import exact_dedup, simhash
from agoralens.llm.components import components

TEXTS = ["a b", "a  b", "a\tb", " a b", "a b ", None, "", "A b", "x " * 20000, "é", "é x", "a b"]


def rows_of(texts):
    return [(i * 3, t) for i, t in enumerate(texts)]


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept_once = False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), i == keep and not kept_once, sha))
            kept_once = True
    return sorted(out, key=str)


def exact_rows(df):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.mark.parametrize("hash_bits", [64, 1])
def test_exact_groups_against_brute_force(docs_of, hash_bits):
    rows = rows_of(TEXTS) + [(0, "a b"), (None, "a b"), (None, None), (None, "only")]
    assert exact_rows(exact_dedup.exact_groups(docs_of(rows), hash_bits=hash_bits)) == brute_exact(rows)


def test_exact_groups_on_overflow_pages(docs_of, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_BYTES", 200)
    rng = random.Random(1)
    rows = [(i, "copy of one text" if i % 2 else f"text {rng.randint(0, 60)}") for i in range(600)]
    groups = exact_dedup.exact_groups(docs_of(rows))
    assert exact_rows(groups) == brute_exact(rows)
    kept = exact_dedup.exact_kept(docs_of(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _, _, k, _ in brute_exact(rows) if k)
    assert kept.columns == docs_of(rows).columns


def test_exact_groups_of_nothing(docs_of):
    assert exact_dedup.exact_groups(docs_of([])).count() == exact_dedup.exact_kept(docs_of([])).count() == 0


def test_directory_doubling():
    depth, bucket, pages = exact_dedup.double_directory({0: 100, 1: 1, 5: 1, 6: 10, 7: 10}, 3, 20)
    assert depth == 3
    # The first prefix cannot be split further and gets pages; light prefixes share a bucket.
    assert pages[0] == 5 and bucket[0] != bucket[1]
    assert bucket[2] == bucket[3] and bucket[4] == bucket[5] != bucket[6] == bucket[7]
    assert exact_dedup.double_directory({}, 2, 20) == (0, [0], [1])


def test_native_plan(docs_of):
    plan = exact_dedup.exact_groups(docs_of(rows_of(TEXTS)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    out = 0
    for b in range(64):
        if parts and 2 * sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) > len(parts):
            out |= 1 << b
    return out


def brute_groups(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if bin(prints[i] ^ prints[j]).count("1") <= radius and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def test_near_groups_against_brute_force(docs_of):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(150)] for _ in range(12)]
    texts = list(TEXTS) + ["one", "one two", "One  TWO", "one two three"]
    for b in base:
        texts.append(" ".join(b))
        for _ in range(5):
            c = list(b)
            c[rng.randrange(len(c))] = "new"
            texts.append(" ".join(c))
    rows = rows_of(texts)
    got = simhash.near_groups(docs_of(rows + rows[:2])).collect()
    prints = {i: plain_print(t) for i, t in rows}
    want = brute_groups(prints, 2)
    assert len(got) == len(rows) + 2
    for r in got:
        assert r["fp"] % 2**64 == prints[r["doc_id"]] and r["component_id"] == want[r["doc_id"]]
    kept = simhash.near_kept(docs_of(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({*want.values()})


def test_near_groups_of_nothing_and_null_ids(docs_of):
    assert simhash.near_groups(docs_of([])).count() == 0
    got = simhash.near_groups(docs_of([(None, "a b c"), (7, "a b c"), (None, "z")])).collect()
    assert sorted(str(r["component_id"]) for r in got) == ["7", "7", "None"]
    assert simhash.near_kept(docs_of([(None, "a"), (3, "a"), (2, "a")])).count() == 2


def test_large_groups_are_cut_and_lose_no_link(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 3, dtype=np.uint64)
    bits = np.uint64(1) << rng.integers(0, 64, (2, 300)).astype(np.uint64)
    values = np.unique(np.concatenate([centre[rng.integers(0, 3, 300)] ^ bits[0] ^ bits[1], centre]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    label = np.arange(len(values))
    for _ in range(10):
        label = np.array([label[near[i]].min() for i in range(len(values))])
    roots = components(simhash.near_edges(frame, 2, lanes=16)).collect()
    found = {int(v): int(v) for v in values.view(np.int64)} | {r["node"]: r["root"] for r in roots}
    classes, wanted = defaultdict(set), defaultdict(set)
    for v, c in zip(values.view(np.int64), label):
        classes[found[int(v)]].add(int(v))
        wanted[c].add(int(v))
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7])
def test_bit_planes_count_differences(radius):
    rng = np.random.default_rng(radius)
    v = rng.integers(0, 2**63, 5, dtype=np.uint64)
    v = np.unique(v[rng.integers(0, 5, 130)] ^ (np.uint64(7) << rng.integers(0, 60, 130).astype(np.uint64)))
    near = simhash.lanes_within(simhash.bit_planes(v), v, radius)
    got = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(v)].astype(bool)
    assert (got == (np.bitwise_count(v[:, None] ^ v[None, :]) <= radius)).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}
