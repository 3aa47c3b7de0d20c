"""The toxicity model again in plain Python, on some short rows."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from agoralens.llm import toxicity
from agoralens.llm.ngrams import all_grams


def plain_fit(rows, labels):
    """A function from a text to its score: counts, ratios, the test, and the regression by hand."""
    text = dict(rows)
    learned = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 4 != 2 and i in text}
    toxic = sum(learned.values())
    clean = len(learned) - toxic
    found = {i: set(all_grams(text[i], toxicity.ORDERS, toxicity.BUCKET_BITS).tolist()) for i in learned}
    counts = defaultdict(lambda: [0, 0])
    for i, y in learned.items():
        for g in found[i]:
            counts[g][y] += 1
    share = toxic / (toxic + clean)
    ratios = {}
    for g, (c, t) in counts.items():
        n = c + t
        ratio = math.log((t + 1) / (toxic + 2)) - math.log((c + 1) / (clean + 2))
        gain = 2 * sum(x * math.log(x / (n * s)) for x, s in ((t, share), (c, 1 - share)) if x)
        if n >= toxicity.LEAST_DOCS and gain >= toxicity.LEAST_GAIN and abs(ratio) >= toxicity.LEAST_RATIO:
            ratios[g] = float(np.float32(ratio))
    examples = sorted((str(i), y, sorted(g for g in found[i] if g in ratios)) for i, y in learned.items())
    weights, seen = dict.fromkeys(ratios, 0.0), dict.fromkeys(ratios, 1e-6)
    bias, order = math.log(share / (1 - share)), np.random.default_rng(7)
    for _ in range(toxicity.EPOCHS):
        for at in order.permutation(len(examples)):
            _, y, features = examples[at]
            z = bias + sum(weights[g] * ratios[g] for g in features)
            error = 1 / (1 + math.exp(-z)) - y
            for g in features:
                slope = error * ratios[g] + 1e-4 * weights[g]
                seen[g] += slope * slope
                weights[g] -= 0.3 * slope / math.sqrt(seen[g])
            bias -= 0.02 * error

    def score(t):
        grams = set(all_grams(t or "", toxicity.ORDERS, toxicity.BUCKET_BITS).tolist())
        return 1 / (1 + math.exp(-bias - sum(weights[g] * ratios[g] for g in grams if g in ratios)))

    return score


def test_scores_equal_a_plain_fit(spark, docs_of):
    rng = np.random.default_rng(1)
    good, bad = "good day lovely friend thanks welcome".split(), "idiot moron stupid".split()
    rows, labels = [], {}
    for i in range(60):
        y = i % 2
        words = [*rng.choice(good, 3), *[w for w in bad if y and rng.random() < 0.75]]
        rows.append((i, " ".join(map(str, words))))
        labels[i] = y
    score = plain_fit(rows, labels)
    table = spark.createDataFrame(list(labels.items()), "doc_id int, toxic int")
    odd = [(900, None), (901, ""), (902, "a vile idiot and a lovely friend")]
    out = toxicity.toxicity(docs_of(rows + odd), table).collect()
    assert len(out) == 63 and len({round(r["score"], 4) for r in out}) >= 4
    for r in out:
        assert r["score"] == pytest.approx(score(r["text"]), abs=1e-5)


def test_repeated_documents_take_one_place(spark, docs_of):
    rows = [(7, "b text")] * 40 + [(7, "a text"), (8, "c text"), (9, None)]
    labels = spark.createDataFrame([(7, 0), (7, 1), (8, 0), (9, 1)], "doc_id int, toxic int")
    found = {r["_id"]: (r["y"], r["text"]) for r in toxicity.labelled_sample(docs_of(rows), labels).collect()}
    held = {i for i in (7, 8) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert found == {i: v for i, v in {7: (1, "a text"), 8: (0, "c text")}.items() if i not in held}
