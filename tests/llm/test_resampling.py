import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from agoralens.llm import target_resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=5, least=20, buckets=10000):
    bucket = {}

    def of(f):
        if f not in bucket:
            bucket[f] = zlib.crc32(f.encode()) % buckets
        return bucket[f]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(of, features(text)[1]))
    for text in target:
        t.update(map(of, features(text)[1]))
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in s}
    rows = []
    for i, text in docs:
        n, found = features(text)
        weight = sum(gain[of(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    may = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = [(r, i) for i, r in enumerate(may[: percent * len(may) // 100], 1)]
    return sorted([(*r[:4], i) for r, i in ranks] + [(*r[:4], None) for r in rows], key=str), ranks


def agree(df, docs, target, **options):
    got = [tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    want, ranks = brute(docs, target, **options)
    drawn = [g for g in got if g[4]]
    assert sorted(drawn, key=lambda g: g[4]) == [(*r[:4], i) for r, i in ranks]
    assert sorted((g[:4] for g in got), key=str) == sorted((w[:4] for w in want if w[4] is None), key=str)


def test_against_brute_force_on_whole_tables(spark):
    docs, target = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    agree(R.resample(docs, target), rows, [r["text"] for r in target.collect()])


ODD = [
    (None, "a b c " * 20), (1, None), (2, ""), (3, " .,!\t\n"), (4, "É é x ÀB Zz9 " * 9), (5, "w" * 5000 + " tail " + "v" * 30),
    (6, "the cat " * 20000), (7, "same text " * 12), (7, "same text " * 12), (8, "same text " * 12), (9, "x\x00y z_a-b𝄞c" * 30),
]


@pytest.mark.parametrize("head", [{}, {"words": 5, "pairs": 3}, {"words": 0, "pairs": 0}])
def test_odd_texts_whatever_the_head(spark, docs_of, head):
    rows = ODD + [(i, f"plain words number {i} of the cat set " * (i % 7)) for i in range(20, 120)]
    target = [(1, "the cat set of words"), (2, None), (3, "same text")]
    agree(R.resample(docs_of(rows), docs_of(target), percent=30, **head), rows, [t for _, t in target], percent=30)


def test_buckets_are_those_of_the_bytes():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 40)).astype(np.uint8)) for _ in range(60)]
    texts = [b" ".join(words[j] for j in rng.integers(0, 60, n)) for n in (0, 1, 2, 3, 50, 400)]
    for head in (R.make_head(words[:30], [(words[i], words[j]) for i in range(40) for j in range(9)]), R.make_head([], [])):
        orders, of, sizes = R.buckets_of(head, texts)
        assert sizes.tolist() == [0, 1, 2, 3, 50, 400]
        for n, found, text in zip((1, 2, 3), orders, of):
            want = []
            for t in texts:
                w = t.split()
                want += [R.bucket_of(w[i : i + n]) for i in range(len(w) - n + 1)]
            assert found.tolist() == want and np.bincount(text, minlength=6).tolist() == [max(0, s - n + 1) for s in sizes]


def test_head_keeps_the_frequent_ones_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(R, "COUNTED", 50)
    kept = R._Frequent()
    for i in range(2000):
        kept.add([b"often", b"again", b"rare%d" % i])
    assert len(kept.counts) <= 53 and {w for w, _ in kept.most(2)} == {b"often", b"again"}


def test_repeated_words_and_pairs_are_counted_within_texts():
    words, pairs = R._Frequent(), R._Frequent()
    R.count_frequent([b"The cat the CAT", b"the cat sat", b"", b"sat once " + b"x" * 99], words, pairs)
    assert dict(words.counts) == {b"the": 3, b"cat": 3, b"sat": 2} and dict(pairs.counts) == {b"the cat": 3}
    R.count_frequent([], words, pairs)
    R.count_frequent([b"the cat the cat"], words, pairs)
    assert words.counts[b"the"] == 5 and pairs.counts == {b"the cat": 5}


def test_empty_tables(docs_of):
    assert R.resample(docs_of([]), docs_of([(1, "a b")])).count() == 0
    rows = [(i, "some words here " * 10) for i in range(40)]
    agree(R.resample(docs_of(rows), docs_of([])), rows, [])
