"""Quality by histogram gradient-boosted trees over document statistics.

A text becomes a row of statistics of its bytes, words, lines and repetitions. Their values are cut
into bins at quantiles; a tree grows level by level from the sums of gradients and curvatures in
each bin of each node. All trees are complete and lie in flat arrays, so a block of texts walks down
all of them with one indexing step for each level.

Fitted on a bounded sample: the ``sample`` labelled rows with the smallest hash of their id, whose
statistics (not texts) come to the driver. A part of the sample is kept from growing and chooses the
number of trees. Statistics are taken from whole texts.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agoralens.llm.common import remainder, slices, wider

SAMPLE = 20000
BINS = 64
DEPTH = 5
TREES = 120
PATIENCE = 20
RATE = 0.1
PENALTY = 2.0
LEAST_CURVATURE = 4.0
VALIDATE = 5  # one row in so many chooses the number of trees
GROUP_CHARS = 4_000_000

_ASCII = [chr(b) for b in range(128)]
#: Groups of bytes whose share of a text is a statistic.
GROUPS = {
    "lower": [c for c in _ASCII if c.islower()],
    "upper": [c for c in _ASCII if c.isupper()],
    "digit": [c for c in _ASCII if c.isdigit()],
    "blank": [" ", "\t"],
    "line_end": ["\n", "\r"],
    "control": [c for c in _ASCII if ord(c) < 32 and c not in "\t\n\r"],
    "full_stop": ["."],
    "comma": [","],
    "ending": ["!", "?"],
    "colon": [":", ";"],
    "quote": ['"', "'", "`"],
    "dash": ["-", "_"],
    "bar": ["|"],
    "bracket": list("()[]{}"),
    "angle": ["<", ">"],
    "slash": ["/", "\\"],
    "sign": list("@#$%&*+=~^"),
}
_SHARES = np.zeros((256, len(GROUPS) + 1))
for _i, _group in enumerate(GROUPS.values()):
    _SHARES[[ord(c) for c in _group], _i] = 1
_SHARES[128:, -1] = 1

STATISTICS = (
    ["log_bytes", *(f"{g}_share" for g in GROUPS), "high_share", "entropy"]
    + ["log_words", "word_mean", "word_deviation", "word_longest", "short_share", "title_share", "letter_share"]
    + ["different_share", "commonest_share", "different_pair_share", "adjacent_repeat_share"]
    + ["log_lines", "line_mean", "line_deviation", "line_longest_share", "blank_line_share", "short_line_share"]
    + ["ended_line_share", "repeated_line_share", "words_per_stop"]
)


def statistics(text):
    """The statistics of one whole text, in the order of ``STATISTICS``; all zero for the empty text."""
    octets = text.encode("utf-8", "replace")
    if not octets:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(octets, np.uint8), minlength=256)
    shares = counts / len(octets)
    met = shares[shares > 0]
    out = [np.log1p(len(octets)), *(shares @ _SHARES).tolist(), float(-(met * np.log2(met)).sum())]

    words = text.split()
    n = len(words)
    if n:
        lengths = np.fromiter(map(len, words), np.int64, n)
        frequency = Counter(words)
        different = len(frequency)
        pairs = len(set(zip(words, words[1:])))
        same = sum(map(str.__eq__, words, words[1:]))
        out += [
            np.log1p(n),
            lengths.mean(),
            lengths.std(),
            np.log1p(lengths.max()),
            (lengths <= 3).mean(),
            sum(c for w, c in frequency.items() if w[0].isupper()) / n,
            sum(c for w, c in frequency.items() if w[0].isalpha()) / n,
            different / n,
            max(frequency.values()) / n,
            pairs / max(1, n - 1),
            same / n,
        ]
    else:
        out += [0.0] * 11

    lines = [line.strip() for line in text.split("\n")]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    filled = [line for line in lines if line]
    many = max(1, len(filled))
    out += [
        np.log1p(len(lines)),
        np.log1p(sizes.mean()),
        np.log1p(sizes.std()),
        sizes.max() / max(1, sizes.sum()),
        1 - len(filled) / len(lines),
        (sizes[sizes > 0] < 20).sum() / many,
        sum(line[-1] in ".!?" for line in filled) / many,
        1 - len(set(filled)) / many if filled else 0.0,
        n / (1 + counts[ord(".")]),
    ]
    return [float(x) for x in out]


@dataclass
class Trees:
    """Complete trees of one depth in flat arrays; node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    bias: float
    cut: float = 0.3

    def margins(self, x):
        """The sum of the leaves that each row reaches, and the bias."""
        count, inner = self.feature.shape
        rows, tree = np.arange(len(x))[:, None], np.arange(count)
        at = np.zeros((len(x), count), np.int64)
        for _ in range(inner.bit_length()):
            at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.threshold[tree, at])
        return self.bias + self.leaf[tree, at - inner].sum(axis=1)

    def scores(self, x):
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def bin_edges(x, bins=BINS):
    """For each column the edges between its bins: quantiles, each value once."""
    ranks = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, ranks, method="lower")) for column in x.T]


def binned(x, edges):
    """The number of edges below each value: a value is above edge b if its bin is above b."""
    return np.column_stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)]).astype(np.int64)


def grow(bins, edges, gradient, curvature, depth=DEPTH, size=BINS):
    """One tree: features, thresholds and leaves, and the leaf of each row."""
    rows, columns = bins.shape
    feature, threshold = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
    node = np.zeros(rows, np.int64)
    offsets = np.arange(columns) * size
    # An edge exists for the bins below the last one of a column.
    edge = np.concatenate([np.arange(size) < len(e) for e in edges])
    for level in range(depth):
        nodes = 1 << level
        at = (node[:, None] * (columns * size) + offsets + bins).ravel()
        sums = [
            np.bincount(at, np.repeat(values, columns), nodes * columns * size).reshape(nodes, columns, size)
            for values in (gradient, curvature)
        ]
        left = [s.cumsum(axis=2) for s in sums]
        total = [s[:, :, -1:] for s in left]
        right = [t - s for t, s in zip(total, left)]
        value = [g * g / (h + PENALTY) for g, h in (left, right, total)]
        gain = np.where((left[1] >= LEAST_CURVATURE) & (right[1] >= LEAST_CURVATURE), value[0] + value[1] - value[2], 0.0)
        gain = np.where(edge, gain.reshape(nodes, -1), 0.0)
        best = gain.argmax(axis=1)
        split = np.flatnonzero(gain[np.arange(nodes), best] > 1e-9)
        first = nodes - 1
        feature[first + split] = best[split] // size
        threshold[first + split] = [edges[b // size][b % size] for b in best[split].tolist()]
        cut = np.full(nodes, size)
        cut[split] = best[split] % size
        node = 2 * node + (bins[np.arange(rows), feature[first + node]] > cut[node])
    g, h = (np.bincount(node, values, 1 << depth) for values in (gradient, curvature))
    return feature, threshold, -RATE * g / (h + PENALTY), node


def log_loss(y, margin):
    return float(np.logaddexp(0, np.where(y == 1, -margin, margin)).mean()) if len(y) else 0.0


def boost(x, y, check, trees=TREES, depth=DEPTH):
    """Trees for the rows where ``check`` is false; the others choose how many of them stay."""
    share = np.clip(y[~check].mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    edges = bin_edges(x[~check])
    bins, target = binned(x[~check], edges), y[~check]
    margin, held = np.full(len(target), bias), np.full(int(check.sum()), bias)
    grown, best, least = [], 0, log_loss(y[check], held)
    for i in range(trees):
        p = 1 / (1 + np.exp(-margin))
        feature, threshold, leaf, node = grow(bins, edges, p - target, p * (1 - p), depth)
        grown.append((feature, threshold, leaf))
        margin += leaf[node]
        held += Trees(feature[None], threshold[None], leaf[None], 0.0).margins(x[check])
        loss = log_loss(y[check], held)
        if loss < least or not check.any():
            best, least = i + 1, loss
        elif i + 1 - best >= PATIENCE:
            break
    kept = [np.array(a) for a in zip(*grown[:best])] if best else [np.zeros((0, (1 << depth) - 1), np.int64)] * 2 + [np.zeros((0, 1 << depth))]
    return Trees(*kept, bias)


def _with_statistics(text_at, names):
    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            others = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            found = [statistics(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays([*others, pa.array(found, pa.list_(pa.float64()))], names=names)

    return run


def labelled_statistics(docs, labels, divisor=5, held=0, sample=SAMPLE, id_col="doc_id", text_col="text", label_col="quality"):
    """``(_id, y, x)`` of the sample. Rows with a null id or label take no part, a null text is empty.

    A repeated label counts once, the larger one holds; a repeated document counts once as well.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (remainder(id_col, divisor) != held))
    ids = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(ids), "_id").select("_id", "y", "_text")  # `sample` pairs of numbers
    kinds = wider(rows.drop("_text").schema, x="array<double>")
    return rows.mapInArrow(_with_statistics(2, kinds.names), kinds).groupBy("_id", "y").agg(F.min("x").alias("x"))


def train(docs, labels, threshold=0.3, **options) -> Trees:
    """Fit on a labelled sample; ``options`` go to ``labelled_statistics``.

    Without a row of either class there are no trees, and the score of any text is the share of
    rows of class 1, one half without any row.
    """
    rows = sorted(labelled_statistics(docs, labels, **options).collect(), key=lambda r: r["_id"])
    y = np.array([r["y"] for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        bias = 0.0 if not len(y) else 30.0 if y[0] else -30.0
        return Trees(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), bias, threshold)
    x = np.array([r["x"] for r in rows])
    check = np.random.default_rng(5).permutation(len(y)) % VALIDATE == 0
    if len(set(y[~check].tolist())) < 2:
        check[:] = False
    model = boost(x, y, check)
    model.cut = threshold
    return model


def with_quality(docs, model, text_col="text", score_name="score", label_name="predicted"):
    """``docs`` with the score and the predicted class of each text; columns of these names go.

    Null counts as the empty text, which is scored by its statistics like any other.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kept = [c for c in docs.columns if c not in (score_name, label_name)]
    rows = docs.select(*[docs[c] for c in kept])

    def run(batches):
        trees = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column(kept.index(text_col)).to_pylist()]
            for a, b in slices([len(t) for t in texts], GROUP_CHARS):
                scores = trees.scores(np.array([statistics(t) for t in texts[a:b]]))
                labels = (scores >= trees.cut).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.array(scores), pa.array(labels)],
                    names=[*kept, score_name, label_name],
                )

    return rows.mapInArrow(run, wider(rows.schema, **{score_name: "double", label_name: "int"}))


def quality(docs, labels, divisor=5, held=0, threshold=0.3, **options):
    """Train on ``labels`` and score all of ``docs``: its columns, ``score`` and ``predicted``.

    Only rows whose id has another remainder than ``held`` modulo ``divisor`` are learned from. Rows
    with a null id are scored; repeated rows get equal scores; an empty table gives an empty result.
    """
    return with_quality(docs, train(docs, labels, threshold, divisor=divisor, held=held, **options))
