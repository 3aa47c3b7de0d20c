"""The nearest-topic join: every opinion meets its k most similar topics by cosine.

Opinions have ``opinion_id`` (unique) and ``vector``. Topics have ``point_id`` (unique),
``topic_id`` (may repeat) and ``vector``. A vector is dense, ``ARRAY<number>``, or sparse,
``STRUCT<indices, values>``. Hits are ordered by score, then topic id, then point id.

Scores are cosines rounded to nine digits, so that equal vectors tie whatever the order of a
sum; thresholds are compared with the rounded score. Vectors without a finite length meet nothing.

Sparse vectors are never made dense: topics are kept as postings, the (topic, weight) pairs of each
bucket, and an opinion adds up the postings of its own buckets.

Four plans give the same result:

* broadcast: topic vectors whose measured size is within a bound go to every worker, and
  opinions stream past them without a shuffle; beyond the bound it gives way to the others;
* lists: sparse vectors meet through the inverted lists of ``match_sparse``, which score only
  the pairs that can be among the k best;
* cells: dense vectors are clustered first, and an opinion visits only the cells that can still
  hold one of its k best topics, by the triangle inequality (``match_dense``);
* blocked: topics and opinions are cut into blocks of bounded size, and each pair of blocks is
  one small task that keeps k hits per opinion.

Inside a task scores are computed in tiles of bounded size, whatever the batch or block.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens import fixed_values as fv
from agoralens.functions import vectors
from agoralens.functions.vectors import CHUNK_BYTES, SCORE_DIGITS, slices

SCALE = 10**SCORE_DIGITS
TILE, TILE_COLUMNS = 1 << 20, 2048  # scores of dense vectors at once
LEAST = -(1 << 62)
BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 16 << 20
COPIES = 16  # of a side, before its blocks grow beyond the asked size
SPARSE_NUMBERS = 512  # that a sparse vector counts as, if it has more dimensions
HITS = "array<struct<point_id:string,topic_id:string,score:double>>"
HIT_TYPE = pa.list_(
    pa.struct([("point_id", pa.string()), ("topic_id", pa.string()), ("score", pa.float64())])
)


# --- inside a task: numpy on Arrow batches ------------------------------------------------


def _unit_rows(column, dim):
    """The vectors of a column as unit rows of a matrix, and which rows have one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    valid = np.asarray(column.is_valid())
    out = np.zeros((rows, dim))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != valid.sum() * dim:
        raise ValueError(f"every vector must have {dim} numbers")
    out[valid] = flat.reshape(-1, dim)
    length = np.linalg.norm(out, axis=1)
    valid &= np.isfinite(length) & (length > 0)
    out[~valid] = 0
    out[valid] /= length[valid, None]
    return out, valid


def _best(scores, k):
    """Positions and rounded scores of the k best columns per row, ties by position.

    Score and position are packed into one integer, so the choice is exact also in ties.
    """
    n = scores.shape[1]
    key = np.rint(scores * SCALE).astype(np.int64) * n + (n - 1 - np.arange(n))
    k = min(k, n)
    if k < n:
        key = np.partition(key, n - k, axis=1)[:, n - k :]
    key = -np.sort(-key, axis=1)
    whole = key // n
    return n - 1 - (key - whole * n), whole / SCALE


def keep_nearest(best, unit, matrix, place, n, floor=None):
    """Put the scores of ``unit @ matrix.T`` into ``best``, the highest keys of each row, falling.

    A key packs a rounded score and a place in tie order, so the choice is exact also in ties. ``place``
    rises and says which of the ``n`` topics are the rows of the matrix. Scores are made in tiles; those
    that do not reach the last key of their row, or its ``floor``, are not looked at again.
    """
    k, width = best.shape[1], min(TILE_COLUMNS, max(1, len(matrix)))
    step = max(1, TILE // width)
    for a in range(0, len(unit), step):
        rows, top = unit[a : a + step], best[a : a + step]
        for b in range(0, len(matrix), width):
            score, spot = rows @ matrix[b : b + width].T, place[b : b + width]
            last = top[:, -1]
            whole = last // n
            ahead = n - 1 - (last - whole * n) < spot[0]  # wins a tie with every column
            limit = (whole + np.where(ahead, 0.4, -0.6)) / SCALE
            if floor is not None:
                limit = np.maximum(limit, floor[a : a + step])
            i, j = np.nonzero(score > limit[:, None])
            if len(i) > score.size // 8:
                key = np.rint(score * SCALE).astype(np.int64) * n + (n - 1 - spot)
                key[score <= limit[:, None]] = LEAST
                key = np.concatenate([top, key], axis=1)
                top[:] = -np.sort(-np.partition(key, key.shape[1] - k, axis=1)[:, -k:], axis=1)
            elif len(i):
                key = np.rint(score[i, j] * SCALE).astype(np.int64) * n + (n - 1 - spot[j])
                met = np.unique(i)
                i, key = np.append(np.repeat(met, k), i), np.append(top[met].ravel(), key)
                order = np.lexsort((-key, i))
                first = np.searchsorted(i[order], met)
                top[met] = key[order][first[:, None] + np.arange(k)]


class DenseTopics:
    """Unit vectors of topics as the rows of a matrix."""

    def __init__(self, column, dim):
        matrix, self.valid = _unit_rows(column, dim)
        self.matrix = matrix[self.valid]

    def __len__(self):
        return len(self.matrix)

    def slices(self, column):
        return slices(np.full(len(column), 4 * self.matrix.shape[1]))

    def nearest(self, column, k):
        """Positions and rounded scores of the k best topics of each row with a vector, and which rows have one."""
        block, valid = _unit_rows(column, self.matrix.shape[1])
        n = len(self)
        key = np.full((int(valid.sum()), min(k, n)), LEAST)
        keep_nearest(key, block[valid], self.matrix, np.arange(n), n)
        whole = key // n
        return n - 1 - (key - whole * n), whole / SCALE, valid


class Postings:
    """Unit vectors of topics by bucket: for each bucket its topics and their weights."""

    def __init__(self, column, dim):
        rows, buckets, values, self.valid = _unit_entries(column)
        place = np.cumsum(self.valid) - 1
        order = np.argsort(buckets, kind="stable")
        self.topic, self.weight = place[rows[order]], values[order]
        self.start = np.searchsorted(buckets[order], np.arange(dim + 1))
        self.width = int(self.valid.sum())

    def __len__(self):
        return self.width

    def slices(self, column):
        """Ranges of rows that read a bounded number of postings."""
        rows, buckets, _, _ = _unit_entries(column)
        size = self.start[buckets + 1] - self.start[buckets]
        return slices(5 * np.bincount(rows, weights=size, minlength=len(column)) + 4 * self.width)

    def nearest(self, column, k):
        """Positions and rounded scores of the k best topics of each row with a vector, and which rows have one."""
        rows, buckets, values, valid = _unit_entries(column)
        place = np.cumsum(valid) - 1
        first = self.start[buckets]
        size = self.start[buckets + 1] - first
        entry = np.repeat(np.arange(len(rows)), size)
        at = np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size) + first[entry]
        cell = place[rows[entry]] * len(self) + self.topic[at]
        count = int(valid.sum())
        total = np.bincount(cell, weights=values[entry] * self.weight[at], minlength=count * len(self))
        return *_best(total.reshape(count, len(self)), k), valid


def _unit_entries(column):
    """Row, bucket and weight of each entry of sparse unit vectors, and which rows have a length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    valid = np.asarray(column.is_valid())
    indices, values = (column.field(i).filter(column.is_valid()) for i in (0, 1))
    sizes = np.zeros(rows, dtype=np.int64)
    sizes[valid] = np.diff(indices.offsets.to_numpy())
    at = np.repeat(np.arange(rows), sizes)
    buckets, weights = indices.flatten().to_numpy(), values.flatten().to_numpy()
    length = np.sqrt(np.bincount(at, weights=weights * weights, minlength=rows))
    valid &= np.isfinite(length) & (length > 0)
    keep = valid[at]
    return at[keep], buckets[keep].astype(np.int64), weights[keep] / length[at[keep]], valid


def entry_slices(batch, *columns, cost=16, row=1):
    """A batch in slices of bounded size for the entries of its sparse vectors.

    ``cost`` and ``row`` tell how many numbers a step needs for an entry and a row.
    """
    sizes = np.full(batch.num_rows, row)
    for c in columns:
        vector = batch.column(c)
        indices = vector.field(0) if pa.types.is_struct(vector.type) else vector
        valid = np.asarray(vector.is_valid()) & np.asarray(indices.is_valid())
        sizes = sizes + cost * np.where(valid, np.diff(indices.offsets.to_numpy()), 0)
    for start, stop in slices(sizes):
        yield batch.slice(start, stop - start)


def _topic_matrix(table, dim):
    """Topic ids, point ids and unit vectors in tie order, topics without a vector left out."""
    order = sorted(
        range(table.num_rows),
        key=lambda i, t=table.column("topic_id").to_pylist(), p=table.column("point_id").to_pylist(): (t[i] or "", p[i]),
    )
    table = table.take(pa.array(order, pa.int64()))
    column = table.column("vector")
    kind = Postings if pa.types.is_struct(column.type) else DenseTopics
    matrix = kind(column, dim)
    keep = pa.array(np.flatnonzero(matrix.valid))
    ids = [table.column(c).combine_chunks().take(keep) for c in ("point_id", "topic_id")]
    return ids[0], ids[1], matrix


def _hits(vector_column, points, topic_ids, matrix, k):
    """One list of hits per row of a batch; null where the row or every topic lacks a vector."""
    if not len(matrix):
        return pa.nulls(len(vector_column), HIT_TYPE)
    offsets, positions, scores, mask = [0], [], [], []
    for start, stop in matrix.slices(vector_column):
        where, score, valid = matrix.nearest(vector_column.slice(start, stop - start), k)
        mask.append(~valid)
        positions.append(where.ravel())
        scores.append(score.ravel())
        offsets.extend(offsets[-1] + np.cumsum(np.where(valid, where.shape[1], 0)))
    at = pa.array(np.concatenate(positions) if positions else np.empty(0, np.int64))
    score = pa.array(np.concatenate(scores) if scores else np.empty(0))
    hit = pa.StructArray.from_arrays(
        [points.take(at), topic_ids.take(at), score], fields=list(HIT_TYPE.value_type)
    )
    mask = pa.array(np.concatenate(mask) if mask else np.empty(0, bool), pa.bool_())
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), hit, type=HIT_TYPE, mask=mask if len(mask) else None
    )


# --- plans --------------------------------------------------------------------------------


def _measure(topics, dim):
    """Row count, vector length and stored bytes of the topics that have a vector."""
    sparse = isinstance(topics.schema["vector"].dataType, T.StructType)
    size = F.size("vector.indices") * 12 if sparse else F.size("vector") * 8
    ids = F.coalesce(F.length("point_id"), F.lit(0)) + F.coalesce(F.length("topic_id"), F.lit(0))
    length = F.lit(dim) if dim else F.max(F.size("vector"))
    row = topics.agg(F.count("*").alias("n"), length.alias("d"), F.sum((size + ids).cast("long")).alias("b")).first()
    return row["n"], max(1, row["d"] or 1), row["b"] or 0


def _vector_dim(df, dim):
    if dim is None and isinstance(df.schema["vector"].dataType, T.StructType):
        raise ValueError("sparse vectors need dim")
    return dim


def _broadcast_hits(opinions, topics, k, keep, dim):
    spark = topics.sparkSession
    table = topics.select("point_id", "topic_id", "vector").toArrow()
    shared = spark.sparkContext.broadcast(_topic_matrix(table, dim))
    names = ["opinion_id", *keep]

    def attach(batches):
        points, topic_ids, matrix = shared.value
        for batch in batches:
            hits = _hits(batch.column("vector"), points, topic_ids, matrix, k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [hits], names=names + ["hits"]
            )

    rows = opinions.select(*names, "vector")
    schema = T.StructType([rows.schema[n] for n in names] + [_field("hits", HITS)])
    return rows.mapInArrow(attach, schema)


def _field(name, ddl):
    return T.StructType.fromDDL(f"{name} {ddl}")[0]


def _block_hits(left, right, k, dim):
    """k hits per opinion and pair of blocks; both sides carry ``cell, chunk, block``."""
    keys = ("cell", "chunk", "block")

    def score(opinion_block, topic_block):
        points, topic_ids, matrix = _topic_matrix(topic_block, dim)
        column = opinion_block.column("vector").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        hits = _hits(column, points, topic_ids, matrix, k)
        return pa.table({"opinion_id": opinion_block.column("opinion_id"), "hits": hits})

    schema = T.StructType([left.schema["opinion_id"], _field("hits", HITS)])
    lists = (
        left.select("opinion_id", "vector", *keys)
        .groupBy(*keys)
        .cogroup(right.select("point_id", "topic_id", "vector", *keys).groupBy(*keys))
        .applyInArrow(score, schema)
    )
    return lists.filter("hits is not null")


def block_rows(rows, asked, width):
    """Rows of a block of a side whose rows take ``width`` bytes.

    As many as asked for; more, within ``BLOCK_BYTES``, where the number of blocks would pass ``COPIES``: the
    other side is copied as often as there are blocks.
    """
    return max(asked, min(-(-rows // COPIES), max(1, BLOCK_BYTES // max(1, width))))


def ordered_hits(hits, k):
    """The k best of a list of hits, best first."""
    keyed = F.transform(hits, lambda h: F.struct((-h["score"]).alias("s"), h["topic_id"], h["point_id"]))
    return F.transform(
        F.slice(F.array_sort(keyed), 1, k),
        lambda h: F.struct(h["point_id"].alias("point_id"), h["topic_id"].alias("topic_id"), (-h["s"]).alias("score")),
    )


def merged_hits(hits, k):
    """The k best of the few hits that the blocks kept for each opinion."""
    order = F.struct((-F.col("score")).alias("s"), "topic_id", "point_id")
    best = F.slice(F.array_sort(F.collect_list(order)), 1, k)
    as_hit = F.transform(
        best,
        lambda h: F.struct(
            h["point_id"].alias("point_id"), h["topic_id"].alias("topic_id"), (-h["s"]).alias("score")
        ),
    )
    return hits.groupBy("opinion_id").agg(as_hit.alias("hits"))


def _blocks(rows, size):
    return max(1, -(-rows // size))


def _hash(column, n):
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _each(count):
    return F.explode(F.sequence(F.lit(0), count - 1))


def _blocked_hits(opinions, topics, k, keep, dim, topic_rows, opinion_rows):
    width = 8 * (min(dim, SPARSE_NUMBERS) if isinstance(topics.schema["vector"].dataType, T.StructType) else dim)
    n_topics, n_opinions = topics.count(), opinions.count()
    n_blocks = _blocks(n_topics, block_rows(n_topics, topic_rows, width))
    n_chunks = _blocks(n_opinions, block_rows(n_opinions, opinion_rows, width))
    left = opinions.select(
        "opinion_id",
        "vector",
        F.lit(0).alias("cell"),
        _hash("opinion_id", n_chunks).alias("chunk"),
        _each(F.lit(n_blocks)).alias("block"),
    )
    right = topics.select(
        "point_id",
        "topic_id",
        "vector",
        F.lit(0).alias("cell"),
        _hash("point_id", n_blocks).alias("block"),
        _each(F.lit(n_chunks)).alias("chunk"),
    )
    lists = _block_hits(left, right, k, dim).groupBy("opinion_id").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    best = lists.select("opinion_id", ordered_hits(F.col("hits"), k).alias("hits"))
    return opinions.select("opinion_id", *keep).join(best, "opinion_id", "left")


def topic_hits(
    opinions: DataFrame,
    topics: DataFrame,
    k=fv.TOP_K,
    keep=(),
    dim: int | None = None,
    plan="auto",
    broadcast_bytes=BROADCAST_BYTES,
    topic_rows: int | None = None,
    opinion_rows: int | None = None,
    n_cells: int | None = None,
    nprobe: int | None = None,
    seed=fv.SPLIT_SEED,
) -> DataFrame:
    """``opinion_id``, the ``keep`` columns and ``hits``, best first, null without a hit.

    ``plan`` is ``broadcast``, ``lists``, ``blocked``, ``cells`` or ``auto``. The topic vectors are
    measured as they are stored; ``auto`` and ``broadcast`` send them to every worker within
    ``broadcast_bytes`` and else take ``lists`` for sparse and ``cells`` for dense vectors, with
    the same rows. Weights below zero take ``blocked`` in place of ``lists``. ``cells`` makes
    ``n_cells`` cells, the square root of the topics unless told otherwise; with ``nprobe`` an
    opinion visits only so many of them and may miss hits. Blocks of ``topic_rows``
    topics and ``opinion_rows`` opinions hold 16 MiB of vectors unless told otherwise: the
    larger the blocks, the fewer copies of either side are shuffled, so smaller ones grow up to that
    size where a side of dense vectors would be copied more than 16 times. ``lists`` shuffles neither
    side: its blocks of topics are sent to all tasks one after the other. ``dim`` is needed for
    sparse vectors, which ``cells`` does not take.
    """
    opinions = opinions.withColumn("opinion_id", F.col("opinion_id").cast("string"))
    topics = topics.withColumns({c: F.col(c).cast("string") for c in ("point_id", "topic_id")})
    topics = topics.filter("vector is not null")
    n, dim, stored = _measure(topics, _vector_dim(topics, dim))
    sparse = isinstance(topics.schema["vector"].dataType, T.StructType)
    if plan in ("auto", "broadcast"):
        plan = "broadcast" if stored <= broadcast_bytes else "lists" if sparse else "cells"
    block = max(1, BLOCK_BYTES * max(1, n) // max(1, stored))
    topic_rows, opinion_rows = topic_rows or block, opinion_rows or max(1, BLOCK_BYTES // (8 * (min(dim, SPARSE_NUMBERS) if sparse else dim)))
    if plan == "broadcast":
        return _broadcast_hits(opinions, topics, k, keep, dim)
    if plan == "lists":
        from agoralens.operators.match_sparse import listed_hits  # built on this module

        found = listed_hits(opinions, topics, k, keep, dim, topic_rows, opinion_rows)
        if found is not None:
            return found
        plan = "blocked"
    if plan == "blocked":
        return _blocked_hits(opinions, topics, k, keep, dim, topic_rows, opinion_rows)
    if plan == "cells":
        from agoralens.operators.match_dense import cell_hits  # built on this module

        return cell_hits(opinions, topics, k, keep, dim, topic_rows, opinion_rows, n_cells, seed, nprobe)
    raise ValueError(f"unknown plan {plan}")


def match_topics(opinions, topics, threshold=fv.MATCH_THRESHOLD, **options) -> DataFrame:
    """One row per opinion: best topic, its score, a confidence flag and the top k.

    Opinions that meet no topic stay, with a null match and ``confidence`` false.
    """
    hits = topic_hits(opinions, topics, **options)
    best = F.get("hits", F.lit(0))
    pairs = F.transform("hits", lambda h: F.struct(h["topic_id"], h["score"]))
    return hits.select(
        *[c for c in hits.columns if c != "hits"],
        best["topic_id"].alias("matched_topic_id"),
        best["score"].alias("similarity_score"),
        F.coalesce(best["score"] >= threshold, F.lit(False)).alias("confidence"),
        pairs.cast("array<struct<topic_id:string,score:double>>").alias("top_k_matches"),
    )


def with_matches(opinions: DataFrame, matches: DataFrame, true_topic="topic_id") -> DataFrame:
    """The opinions with match, score and correctness, joined on the opinion id."""
    found = matches.select("opinion_id", "matched_topic_id", "similarity_score")
    joined = opinions.withColumn("opinion_id", F.col("opinion_id").cast("string")).join(
        found, "opinion_id", "left"
    )
    return joined.withColumn("is_correct", is_correct("matched_topic_id", true_topic))


def is_correct(predicted, true):
    """True where both agree; a missing prediction is not correct."""
    return F.coalesce(F.col(predicted) == F.col(true), F.lit(False))


def similar_topics(queries: DataFrame, topics: DataFrame, **options) -> DataFrame:
    """The most similar topics of each query with their texts: one row per hit."""
    hits = topic_hits(queries, topics, **options).select(
        "opinion_id", F.posexplode("hits").alias("pos", "hit")
    )
    texts = topics.select(F.col("point_id").cast("string").alias("point_id"), "topic_text")
    flat = hits.select(
        "opinion_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("hit.point_id").alias("point_id"),
        F.col("hit.topic_id").alias("topic_id"),
        F.col("hit.score").alias("score"),
    )
    return flat.join(texts, "point_id", "left").drop("point_id")


def pair_similarity(pairs: DataFrame, left="left_vector", right="right_vector", dim=None) -> DataFrame:
    """Each pair of vectors with its cosine ``similarity``; null where one has no length."""
    if not isinstance(pairs.schema[left].dataType, T.StructType):
        return pairs.withColumn("similarity", vectors.stable_score(vectors.cosine(left, right)))
    if dim is None:
        raise ValueError("sparse vectors need dim")

    def score(batches):
        for batch in (part for whole in batches for part in entry_slices(whole, left, right)):
            a, b = _unit_entries(batch.column(left)), _unit_entries(batch.column(right))
            # Both sides have a key for each row and bucket; equal keys meet.
            keys = [rows * dim + buckets for rows, buckets, _, _ in (a, b)]
            _, at_a, at_b = np.intersect1d(*keys, assume_unique=True, return_indices=True)
            total = np.bincount(a[0][at_a], weights=a[2][at_a] * b[2][at_b], minlength=batch.num_rows)
            values = pa.array(np.rint(total * SCALE) / SCALE, mask=~(a[3] & b[3]))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "similarity"])

    return pairs.mapInArrow(score, T.StructType(pairs.schema.fields + [_field("similarity", "double")]))


def ranked_hits(hits: DataFrame) -> DataFrame:
    """Long form of ``top_k_matches``: opinion_id, rank, topic_id, score."""
    flat = hits.select("opinion_id", F.posexplode("top_k_matches").alias("pos", "hit"))
    return flat.select("opinion_id", (F.col("pos") + 1).alias("rank"), "hit.topic_id", "hit.score")
