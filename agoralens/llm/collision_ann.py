"""Nearest neighbours by inner product through collision counting.

Every vector is projected onto a fixed number of random directions. The index is cut into blocks;
each holds, for every direction, its vectors sorted by their projection. A search opens a window
around the query's projection in each sorted array and counts, for each vector, in how many windows
it lies. Windows grow from level to level (virtual rehashing: nothing is rebuilt), vectors whose
count reaches the threshold are verified on their original values. The search of a block ends when
a vector as far as the k-th best one found has by then reached the threshold with high probability.

Largest inner product becomes smallest distance by one more coordinate: it lifts every vector to
the largest norm, and a query is scaled to that norm. All blocks are searched for all queries, in
blocks of queries; a block gives k hits for a query, which are merged by a window.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from agoralens.session import settled

DIRECTIONS = 48
SHARE = 0.75  # of the directions in which a vector must collide
SURE = 1.3  # standard deviations by which the k-th best must be beyond the threshold
FIRST, GROWTH = 0.8, 1.25  # half a window, in units of the largest norm, and its growth
BLOCK = 8192
QUERY_BLOCK = 4096


def usable(vectors, id_col, vector_col):
    """``(_id, v)``: rows with an id and a vector without null, infinite or NaN components that is not zero."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where("_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(fine & F.exists("v", lambda x: x != 0))


def _matrix(column, size):
    return np.asarray(column.combine_chunks().flatten(), np.float64).reshape(-1, size)


def directions(size, count=DIRECTIONS):
    return np.random.default_rng(size).standard_normal((size + 1, count))


def build_index(rows, size, largest, block=BLOCK, count=DIRECTIONS):
    """A stored row for each block: ids, vectors, and the sorted projections with their order."""
    blocks = max(1, math.ceil(rows.count() / block))
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int"))

    def build(key, table):
        x = _matrix(table["v"], size)
        lift = np.sqrt(np.maximum(largest**2 - (x * x).sum(axis=1), 0))
        projected = np.ascontiguousarray((np.column_stack([x, lift]) @ directions(size, count)).T)
        order = np.argsort(projected, axis=1, kind="stable")
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int32()),
                "ids": [np.asarray(table["_id"]).astype(np.int64).tobytes()],
                "vectors": [x.tobytes()],
                "order": [order.astype(np.int32).tobytes()],
                "sorted": [np.take_along_axis(projected, order, axis=1).tobytes()],
            }
        )

    kinds = "block int, ids binary, vectors binary, order binary, sorted binary"
    return settled(keyed.groupBy("block").applyInArrow(build, kinds), "ann-index"), blocks


def search_block(ids, vectors, order, placed, query_ids, queries, largest, k):
    """The k best of one block for each query: positions of queries, ids and scores.

    ``order`` and ``placed`` have a row for each direction.
    """
    count, n = order.shape
    least = math.ceil(SHARE * count)
    norms = np.sqrt((queries * queries).sum(axis=1))
    scaled = np.column_stack([queries * (largest / norms)[:, None], np.zeros(len(queries))])
    projected = scaled @ directions(vectors.shape[1], count)
    widest = max(np.abs(projected).max(), np.abs(placed).max()) * 2 + largest
    levels = [FIRST * largest]
    while levels[-1] < widest:
        levels.append(levels[-1] * GROWTH)
    levels[-1] = np.inf
    # What share of directions a vector of that distance needs a window for, as a multiple of it.
    share = np.linspace(0.001, 0.9999, 4000)
    certain = share[np.argmax(count * share - SURE * np.sqrt(count * share * (1 - share)) >= least)]
    reach = _half_width(certain)

    edges = {}

    def windows(level):
        if level not in edges:
            w = levels[level]
            low = [np.searchsorted(placed[j], projected[:, j] - w, "left") for j in range(count)]
            high = [np.searchsorted(placed[j], projected[:, j] + w, "right") for j in range(count)]
            edges[level] = np.array(low).T.tolist(), np.array(high).T.tolist()
        return edges[level]

    at, found, scores = [], [], []
    for i, query in enumerate(queries):
        hits = np.zeros(n, np.int64)
        verified = ids == query_ids[i]  # never its own candidate
        product = np.full(n, -np.inf)
        inner_low = inner_high = None
        for level in range(len(levels)):
            low, high = (x[i] for x in windows(level))
            if inner_low is None:
                ring = [order[j, low[j] : high[j]] for j in range(count)]
            else:
                ring = [order[j, low[j] : inner_low[j]] for j in range(count)]
                ring += [order[j, inner_high[j] : high[j]] for j in range(count)]
            hits += np.bincount(np.concatenate(ring), minlength=n)
            inner_low, inner_high = low, high
            new = np.flatnonzero((hits >= least) & ~verified)
            if len(new):
                verified[new] = True
                product[new] = vectors[new] @ query
            if np.isfinite(levels[level]):
                ready = int(verified.sum()) - 1
                if ready < k:
                    continue
                best = np.partition(product, n - k)[n - k]
                if not np.isfinite(best):
                    continue
                distance = np.sqrt(max(0.0, 2 * largest**2 - 2 * best * largest / norms[i]))
                if levels[level] >= reach * distance:
                    break
        take = np.flatnonzero(np.isfinite(product))
        if len(take) > k:
            edge = np.partition(product[take], len(take) - k)[len(take) - k]
            take = take[product[take] >= edge - 1e-9 * (abs(edge) + largest * norms[i])]
        exact = (vectors[take] * query).sum(axis=1)
        chosen = np.lexsort((ids[take], -exact))[:k]
        at.append(np.full(len(chosen), i))
        found.append(ids[take][chosen])
        scores.append(exact[chosen])
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)


def _half_width(share):
    """How many standard deviations around the mean hold that share of a normal variable."""
    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if math.erf(middle / math.sqrt(2)) < share else (low, middle)
    return high


def _search(largest, size, k):
    def run(table):
        out = []
        for row in table.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            order = np.frombuffer(row["order"], np.int32).reshape(-1, len(ids)).astype(np.int64)
            placed = np.frombuffer(row["sorted"], np.float64).reshape(order.shape)
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), size)
            query_ids = np.frombuffer(row["query_ids"], np.int64)
            queries = np.frombuffer(row["queries"], np.float64).reshape(-1, size)
            at, found, scores = search_block(ids, vectors, order, placed, query_ids, queries, largest, k)
            out.append(pa.table({"query_id": query_ids[at], "vec_id": found, "score": scores}))
        return pa.concat_tables(out)

    return run


def _pack_queries(size):
    def run(key, table):
        return pa.table(
            {
                "part": pa.array([key[0].as_py()], pa.int32()),
                "query_ids": [np.asarray(table["_id"]).astype(np.int64).tobytes()],
                "queries": [_matrix(table["v"], size).tobytes()],
            }
        )

    return run


HITS = "query_id bigint, rank int, vec_id bigint, score double"


def nearest(vectors, queries, k=20, id_col="vec_id", vector_col="embedding", block=BLOCK, query_block=QUERY_BLOCK):
    """``(query_id, rank, vec_id, score)``: the k rows of ``vectors`` found nearest to each query.

    Nearest first by inner product in double precision, ties to the smaller id; a query is never
    its own hit. ``queries`` holds rows of the same kind. Ids are integers. Null ids, and vectors
    that are null, zero or not all finite, take no part. Vectors of different lengths have no inner
    product: each length is searched by itself. A repeated id is a candidate with each of its rows,
    and asks once, with its least vector. An empty table gives an empty result. With fewer than k
    candidates, all are returned. The index holds every vector.
    """
    rows, asked = (usable(t, id_col, vector_col) for t in (vectors, queries))
    lengths = [t.select(F.size("v").alias("d")).distinct() for t in (rows, asked)]
    out = None
    for size in sorted(r["d"] for r in lengths[0].intersect(lengths[1]).collect()):
        alike = [t.where(F.size("v") == size) for t in (rows, asked)]
        found = _nearest(*alike, size, k, block, query_block)
        out = found if out is None else out.union(found)
    return vectors.sparkSession.createDataFrame([], HITS) if out is None else out


def _nearest(rows, asked, size, k, block, query_block):
    """The hits among rows of one length."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    largest = rows.agg(F.max(norm)).first()[0]
    index, blocks = build_index(rows, size, largest, block)
    asked = asked.groupBy("_id").agg(F.min("v").alias("v"))
    parts = max(1, math.ceil(asked.count() / query_block))
    part = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(parts)).cast("int")
    packed = asked.withColumn("part", part).groupBy("part")
    packed = packed.applyInArrow(_pack_queries(size), "part int, query_ids binary, queries binary")
    packed = settled(packed, "ann-queries")
    spread = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = spread.join(index.hint("shuffle_merge"), "block")
    hits = pairs.groupBy("part", "block").applyInArrow(
        _search(largest, size, k), "query_id bigint, vec_id bigint, score double"
    )
    hits = settled(hits, "ann-hits")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
