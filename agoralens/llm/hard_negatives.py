"""Hard negatives by an inverted multi-index.

Vectors become whole numbers, so every score is an exact integer inner product. Each half of the
space has a codebook; a row belongs to the cell of its two nearest codes. Over all rows a code has a
radius, the largest distance of its members, which bounds the half-score of any member:
``q . c + |q| * radius``. For an anchor, the multi-sequence heap gives the cells in descending order
of the two bounds' sum. Once the sum is below a score, every row with that score or a higher one has
been seen: the window of scores above it is certified.

A search has goals: the k best rows of the same label, or of other labels with a score inside of a
window. A first pass visits the leading cells of each anchor and raises the goals' lower ends to the
k-th score found; the full pass visits cells until the bound falls below the lowest end. Both are
exact for what they see, so the result is that of comparing all rows, whatever the codebooks.

Cells lie in stored blocks of bounded size, small neighbouring cells together and large cells cut.
An anchor travels to the blocks that hold cells it visits; a block travels once for each bounded
group of anchors.
"""

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from agoralens.session import settled

SAMPLE = 20000  # rows that the codebooks are fitted on; all rows are indexed
ROUNDS = 8
CELL_ROWS = 256  # the mean number of rows in a cell, until there are MOST_CODES codes
MOST_CODES = 256
BLOCK = 8192
GROUP = 16384  # anchors that meet a block at once
FIRST = 1024  # rows that the first pass looks at
LOWEST, HIGHEST = -(1 << 62), 1 << 62
HITS = "anchor_id bigint, goal int, vec_id bigint, score bigint"
OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def largest_component(size):
    """The largest whole component for which 100 times any score fits 64 bits."""
    return min((1 << 31) - 1, math.isqrt((1 << 55) // size))


def whole_vectors(rows, id_col, label_col, vector_col, scale):
    """``(_id, label, v)``: rows with an id, a label and finite components, each ``floor(scale * x)``.

    Components so large that a score could leave 64 bits take their row out.
    """
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    rows = rows.where("_id is not null and label is not null and x is not null and size(x) > 0")
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    rows = rows.select("_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    most = F.floor(F.sqrt(F.lit(float(1 << 55)) / F.size("v")))
    return rows.where(F.forall("v", lambda c: F.abs(c) <= F.least(most, F.lit((1 << 31) - 1))))


def matrix(column, size):
    return np.asarray(column.combine_chunks().flatten(), np.int64).reshape(-1, size)


def unpacked(octets, size):
    return np.frombuffer(octets, np.int32).reshape(-1, size).astype(np.float64)


def halves(x):
    """The two halves of each row; the first may be one component longer."""
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def nearest_code(x, codes):
    """For each row its nearest code and the distance to it."""
    squares = (x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)
    near = squares.argmin(axis=1)
    return near, np.sqrt(((x - codes[near]) ** 2).sum(axis=1))


def k_means(points, count, rounds=ROUNDS):
    """Codes for some points; fewer than ``count`` where there are fewer different points."""
    different = np.unique(points, axis=0)
    codes = different[np.random.default_rng(count).permutation(len(different))[:count]].astype(np.float64)
    for _ in range(rounds):
        near, _ = nearest_code(points, codes)
        sums = np.zeros_like(codes)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=len(codes))
        codes[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return codes


@dataclass
class Directory:
    """Codebooks, radii and the rows and blocks of each cell: of bounded size, whatever the table."""

    books: list
    radii: list
    rows: np.ndarray  # of each cell
    first: np.ndarray  # block of each cell
    parts: np.ndarray  # neighbouring blocks of each cell

    def half_bounds(self, vector):
        """The largest score that each code's members can have with the halves of one vector."""
        out = []
        for half, codes, radius in zip(halves(vector[None]), self.books, self.radii):
            norm = np.sqrt((half * half).sum())
            bound = (codes @ half[0]) + norm * radius
            out.append(bound + 1e-9 * (np.abs(bound) + norm) + 0.5)  # rounding never hides a row
        return out


def multi_sequence(first, second):
    """The pairs of two lists of bounds in descending order of their sum: ``(i, j, sum)``."""
    if not len(first) or not len(second):
        return
    left, right = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[left].tolist(), second[right].tolist()
    left, right = left.tolist(), right.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield left[i], right[j], -total
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def visited_cells(directory, vector, lowest, rows=None):
    """Cells in the heap's order until all rows that score ``lowest`` or more are seen, or ``rows`` rows."""
    width, cells, seen = len(directory.books[1]), [], 0
    for i, j, bound in multi_sequence(*directory.half_bounds(vector)):
        if bound < lowest or (rows is not None and seen >= rows):
            break
        cell = i * width + j
        if directory.rows[cell]:
            cells.append(cell)
            seen += int(directory.rows[cell])
    return cells


def _assign(books, size):
    def run(batches):
        number = 0
        for batch in batches:
            whole = matrix(pa.chunked_array([batch.column("v")]), size)
            near = [nearest_code(h, c) for h, c in zip(halves(whole.astype(np.float64)), books)]
            cell = near[0][0] * len(books[1]) + near[1][0]
            octets = whole.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("label"),
                    pa.array([row.tobytes() for row in octets], pa.binary()),
                    pa.array(cell.astype(np.int32)),
                    pa.array(near[0][1], pa.float64()),
                    pa.array(near[1][1], pa.float64()),
                    pa.array(np.arange(number, number + len(cell), dtype=np.int64)),
                ],
                names=["_id", "label", "v", "cell", "r0", "r1", "n"],
            )
            number += len(cell)

    return run


def _blocks(counts, block):
    """The first block of each cell and in how many it is cut, in cell order; the number of blocks."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at = filled = 0
    for cell in np.flatnonzero(counts):
        n = int(counts[cell])
        if filled and filled + n > block:
            at, filled = at + 1, 0
        first[cell], parts[cell] = at, max(1, math.ceil(n / block))
        filled += n
        if filled >= block:
            at, filled = at + int(parts[cell]), 0
    return first, parts, at + bool(filled)


def _pack(key, table):
    """A stored row for a block: its rows in cell order."""
    order = np.argsort(np.asarray(table["cell"]), kind="stable")
    octets = np.array(table["v"].to_pylist(), object)[order]
    return pa.table(
        {
            "block": pa.array([key[0].as_py()], pa.int64()),
            "ids": [np.asarray(table["_id"])[order].tobytes()],
            "labels": [np.asarray(table["label"])[order].tobytes()],
            "cells": [np.asarray(table["cell"])[order].tobytes()],
            "vectors": [b"".join(octets)],
        }
    )


def build_index(rows, size, sample=SAMPLE, cell_rows=CELL_ROWS, block=BLOCK):
    """The stored blocks of all ``rows``, of which there is one at least, and their directory."""
    total = rows.count()
    few = rows.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("v").toArrow()
    points = halves(matrix(few["v"], size).astype(np.float64))
    count = min(MOST_CODES, max(2, math.ceil(math.sqrt(total / cell_rows))))
    books = [k_means(p, count) for p in points]
    kinds = "_id bigint, label bigint, v binary, cell int, r0 double, r1 double, n bigint"
    rows = settled(rows.mapInArrow(_assign(books, size), kinds), "negatives-rows")
    found = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.max("r0").alias("r0"), F.max("r1").alias("r1"))
    found = found.toPandas()  # MOST_CODES ** 2 cells at most
    width = len(books[1])
    counts = np.zeros(len(books[0]) * width, np.int64)
    counts[found["cell"]] = found["c"]
    radii = [np.zeros(len(books[0])), np.zeros(width)]
    np.maximum.at(radii[0], found["cell"] // width, found["r0"])
    np.maximum.at(radii[1], found["cell"] % width, found["r1"])
    first, parts, _ = _blocks(counts, block)
    directory = Directory(books, radii, counts, first, parts)
    used = np.flatnonzero(counts)
    places = rows.sparkSession.createDataFrame(
        list(zip(used.tolist(), first[used].tolist(), parts[used].tolist())), "cell int, first long, parts long"
    )
    placed = rows.join(F.broadcast(places), "cell").withColumn("block", F.col("first") + F.col("n") % F.col("parts"))
    packed = placed.select("block", "_id", "label", "v", "cell").groupBy("block")
    index = packed.applyInArrow(_pack, "block bigint, ids binary, labels binary, cells binary, vectors binary")
    return settled(index, "negatives-index"), directory


def _visits(directory, size, rows):
    """A row for each anchor and block that holds cells it visits."""

    def run(batches):
        known = directory.value
        for batch in batches:
            at, blocks, cells = [], [], []
            vectors = batch.column("v").to_pylist()
            for i, low in enumerate(batch.column("low").to_pylist()):
                where = {}
                for cell in visited_cells(known, unpacked(vectors[i], size)[0], min(low, default=HIGHEST), rows):
                    for part in range(known.parts[cell]):
                        where.setdefault(int(known.first[cell]) + part, []).append(cell)
                at += [i] * len(where)
                blocks += where
                cells += [sorted(c) for c in where.values()]
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(cells, pa.list_(pa.int32())), *taken.columns],
                names=["block", "visited", *batch.schema.names],
            )

    return run


def _runs(cells, visited):
    """Ranges of rows of the visited cells; neighbouring ranges are one."""
    low, high = np.searchsorted(cells, visited, "left"), np.searchsorted(cells, visited, "right")
    out = []
    for a, b in zip(low.tolist(), high.tolist()):
        if out and out[-1][1] == a:
            out[-1][1] = b
        elif b > a:
            out.append([a, b])
    return out


def scores_of(vectors, query):
    """Exact inner products of whole numbers: in doubles where these cannot round."""
    if len(query) * max(np.abs(vectors).max(initial=0), 1) * max(np.abs(query).max(initial=0), 1) < 2**53:
        return (vectors @ query).astype(np.int64)
    return vectors.astype(np.int64) @ query.astype(np.int64)


def k_best(ids, scores, k):
    """Positions of the k highest scores, ties by smaller id."""
    at = np.arange(len(ids))
    if len(at) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _search(size, k):
    def run(asked, index):
        out = [[], [], [], []]
        for row in index.to_pylist():
            ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
            cells, vectors = np.frombuffer(row["cells"], np.int32), unpacked(row["vectors"], size)
            for a in asked.to_pylist():
                spans = _runs(cells, np.array(a["visited"]))
                query = unpacked(a["v"], size)[0]
                at = np.concatenate([np.arange(*s) for s in spans])
                scores = np.concatenate([scores_of(vectors[b:e], query) for b, e in spans])
                like, other = labels[at] == a["label"], ids[at] != a["_id"]
                for goal, (same, low, high) in enumerate(zip(a["same"], a["low"], a["high"])):
                    fits = np.flatnonzero((like == same) & other & (scores >= low) & (scores <= high))
                    best = fits[k_best(ids[at[fits]], scores[fits], k)]
                    out[0] += [a["_id"]] * len(best)
                    out[1] += [goal] * len(best)
                    out[2] += ids[at[best]].tolist()
                    out[3] += scores[best].tolist()
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ("anchor_id", "goal", "vec_id", "score")
        return pa.table({name: pa.array(x, kind) for name, x, kind in zip(names, out, kinds)})

    return run


class Index:
    """An inverted multi-index of vectors of one length."""

    def __init__(self, rows, size, **options):
        self.size = size
        self.blocks, self.directory = build_index(rows, size, **options)

    def _hits(self, asked, groups, k, rows=None):
        """The k best hits of each goal among the cells that the heap visits."""
        spark = asked.sparkSession
        sent = spark.sparkContext.broadcast(self.directory)
        kinds = "block bigint, visited array<int>, _id bigint, label bigint, v binary, same array<boolean>, "
        kinds += "low array<bigint>, high array<bigint>"
        visits = asked.mapInArrow(_visits(sent, self.size, rows), kinds)
        group = F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int")
        visits = settled(visits.withColumn("g", group), "negatives-visits")
        asking = visits.select(F.col("block").alias("to"), F.col("g").alias("set")).distinct()
        met = self.blocks.join(asking, F.col("block") == F.col("to")).drop("block")
        found = visits.groupBy("block", "g").cogroup(met.groupBy("to", "set")).applyInArrow(_search(self.size, k), HITS)
        order = Window.partitionBy("anchor_id", "goal").orderBy(F.desc("score"), "vec_id")
        found = settled(found, "negatives-hits").withColumn("rank", F.row_number().over(order))
        return found.where(F.col("rank") <= k)

    def best(self, asked, k, first=FIRST, group=GROUP):
        """``(anchor_id, goal, vec_id, score, rank)``: the k best rows of each goal of each anchor.

        ``asked`` holds ``_id, label, v`` and for each goal ``same`` (label like the anchor's or
        not) and the ends ``low`` and ``high`` of its window. Ids of anchors do not repeat.
        """
        groups = max(1, math.ceil(asked.count() / group))
        reached = self._hits(asked, groups, k, first).where(F.col("rank") == k)
        reached = reached.groupBy("anchor_id").agg(
            F.map_from_entries(F.collect_list(F.struct("goal", "score"))).alias("reached")
        )
        raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.col("reached")[i], x)))
        asked = asked.join(reached, asked["_id"] == reached["anchor_id"], "left")
        asked = asked.select("_id", "label", "v", "same", raised.alias("low"), "high")
        return settled(self._hits(settled(asked, "negatives-asked"), groups, k), "negatives-best")


def _one_length(rows, anchors, size, positives, negatives, low, high, options):
    index = Index(rows, size, **options)
    asked = anchors.groupBy("_id").agg(F.min(F.struct("label", "v")).alias("a"))  # one row of a repeated id
    octets = F.col("a.v")
    asked = asked.select("_id", "a.label", octets.alias("v")).mapInArrow(_to_octets(size), "_id bigint, label bigint, v binary")
    asked = settled(asked, "negatives-anchors")
    goal = {"same": F.array(F.lit(True)), "low": F.array(F.lit(LOWEST)), "high": F.array(F.lit(HIGHEST))}
    near = index.best(asked.withColumns(goal), positives)
    near = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank")
    # 80 * p <= 100 * n <= 100 * p in whole numbers: no score fits below zero.
    share = F.ceil(F.col("positive_score").cast("decimal(38,0)") * low / 100).cast("bigint")
    top = F.floor(F.col("positive_score").cast("decimal(38,0)") * high / 100).cast("bigint")
    window = near.select("*", share.alias("low"), top.alias("high")).where("low <= high")
    goals = window.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))
    asked = asked.join(goals, asked["_id"] == goals["anchor_id"]).select(
        "_id",
        "label",
        "v",
        F.transform("w", lambda x: F.lit(False)).alias("same"),
        F.col("w.low").alias("low"),
        F.col("w.high").alias("high"),
    )
    hard = index.best(settled(asked, "negatives-windows"), negatives)
    order = Window.partitionBy("anchor_id").orderBy("rank")
    numbered = window.withColumn("goal", F.row_number().over(order) - 1)
    return hard.join(numbered.drop("rank"), ["anchor_id", "goal"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _to_octets(size):
    def run(batches):
        for batch in batches:
            whole = matrix(pa.chunked_array([batch.column("v")]), size).astype(np.int32)
            octets = pa.array([row.tobytes() for row in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("label"), octets], names=["_id", "label", "v"])

    return run


def hard_negatives(
    rows, anchors, positives=5, negatives=5, low=80, high=100, scale=256,
    id_col="vec_id", label_col="label", vector_col="embedding", **options,
):
    """For each anchor and positive, the best rows of other labels within a window of scores.

    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``. Positives are
    the ``positives`` best other rows of the anchor's label; negatives are the ``negatives`` best
    rows of another label whose score is ``low`` to ``high`` per cent of the positive's. Higher
    scores come first, ties go to the smaller id; a positive below zero has no window. ``anchors``
    holds rows of the same kind.

    Ids and labels are integers. Rows without an id or a label, and vectors that are null, empty or
    not all finite, take no part; nor do components beyond ``largest_component``. Vectors of
    different lengths are never compared: each length is mined by itself. A repeated id gives a
    candidate for each of its rows; as an anchor it is asked once, with its least label and vector,
    and no row of its own id is its positive or negative. An empty table gives an empty result.
    ``options`` go to ``build_index``.
    """
    rows, anchors = (whole_vectors(t, id_col, label_col, vector_col, scale) for t in (rows, anchors))
    rows = settled(rows, "negatives-whole")  # read by the sample, the codes and each length
    out = None
    lengths = [t.select(F.size("v").alias("d")).distinct() for t in (rows, anchors)]
    for size in sorted(r["d"] for r in lengths[0].intersect(lengths[1]).collect()):
        alike = [t.where(F.size("v") == size) for t in (rows, anchors)]
        found = _one_length(*alike, size, positives, negatives, low, high, options)
        out = found if out is None else out.union(found)
    return rows.sparkSession.createDataFrame([], OUT) if out is None else out
