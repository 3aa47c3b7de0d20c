"""Nearest topics of dense vectors through an inverted file, for topics of any size.

A coarse quantiser cuts the unit topics into cells, about as many as the square root of their number.
A cell knows the largest angle between its centre and a member. By the triangle inequality on the
sphere no member is nearer to an opinion than the angle to the centre less that radius, which
bounds all scores of the cell.

An opinion first visits the cells with the best bounds until a share of the topics is seen. Its k-th
score so far then ends the visits: only cells whose bound reaches it are read in the second round. The
hits are those of comparing all pairs, however the cells are cut. With ``nprobe`` an opinion
visits that number of nearest centres and no more, and hits may be missed.

Cells lie in blocks of bounded size, small ones together and large ones cut. An opinion travels once
to each block that it visits, whatever the number of its cells there; its visits are stored as one row.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens.functions import vectors
from agoralens.functions.vectors import slices
from agoralens.operators.match import LEAST, SCALE, _each, _field, _hash, _unit_rows, block_rows, keep_nearest, merged_hits
from agoralens.session import settled

MOST_CELLS = 4096
SAMPLE = 64  # topics for each cell that the centres are fitted on; all topics are placed
FIRST_SHARE = 1 / 32  # of the topics that the first round sees
MARGIN = 2.0 / SCALE
HIT = "opinion_id bigint, point_id string, topic_id string, score double"


def pack_cells(sizes, rows):
    """The first block of each cell, in how many it is cut, and the number of blocks.

    Neighbouring cells share a block while it holds ``rows`` topics or fewer.
    """
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block = used = 0
    for cell, n in enumerate(sizes.tolist()):
        parts[cell] = max(1, -(-n // rows))
        if used and used + n > rows:
            block, used = block + 1, 0
        first[cell] = block
        if parts[cell] > 1:
            block, used = block + int(parts[cell]), 0
        else:
            used += n
    return first, parts, block + 1


class Cells:
    """Centres, radii, sizes and places of all cells; of bounded size whatever the table."""

    def __init__(self, centres):
        length = np.linalg.norm(centres, axis=1, keepdims=True)
        self.centres = centres / np.where(length > 0, length, 1)
        self.radius = np.zeros(len(centres))
        self.sizes = np.zeros(len(centres), np.int64)

    def angles(self, unit):
        return np.arccos(np.clip(unit @ self.centres.T, -1, 1))

    def bounds(self, unit, angles=None):
        """The best score that a member of each cell can have with each unit row."""
        angles = self.angles(unit) if angles is None else angles
        gap = np.maximum(angles - self.radius - 1e-9, 0)
        return np.where(self.sizes > 0, np.cos(np.minimum(gap, np.pi)), -2.0)

    def leading(self, unit, rows):
        """For each row the cells with the best bounds, nearest centres first among equals, until ``rows`` are seen."""
        angles = self.angles(unit)
        order = np.lexsort((angles, -self.bounds(unit, angles)), axis=1)
        seen = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, seen < rows, axis=1)
        return out & (self.sizes > 0)

    def nearest(self, unit, count):
        """For each row the ``count`` nearest centres of cells that are not empty."""
        angles = np.where(self.sizes > 0, self.angles(unit), np.inf)
        out = np.zeros(angles.shape, bool)
        np.put_along_axis(out, np.argsort(angles, axis=1, kind="stable")[:, :count], True, axis=1)
        return out & (self.sizes > 0)


class InvertedFile:
    """All topics with a finite length, placed in cells and blocks."""

    def __init__(self, topics: DataFrame, dim: int, topic_rows: int, n_cells=None, seed=42):
        self.dim, self.spark = dim, topics.sparkSession
        unit = topics.select("point_id", "topic_id", vectors.l2_normalise("vector").alias("vector"))
        known = settled(unit.filter("vector is not null"), "unit-topics")
        self.rows = known.count()
        wanted = n_cells or min(MOST_CELLS, max(1, round(self.rows**0.5)))
        if not self.rows:
            return
        share = min(1.0, SAMPLE * wanted / self.rows)
        some = known.filter(F.pmod(F.xxhash64("point_id", F.lit(seed)), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
        points = (some if not some.isEmpty() else known).select(array_to_vector("vector").alias("features"))
        model = KMeans(k=wanted, seed=seed, maxIter=5, initMode="random").fit(points)
        self.cells = Cells(np.array(model.clusterCenters()))
        sent = self.spark.sparkContext.broadcast(self.cells)
        kinds = [*known.schema.fields, _field("cell", "int"), _field("angle", "double")]
        placed = settled(known.mapInArrow(_place(sent, dim), T.StructType(kinds)), "topic-cells")
        # One row for each cell.
        for s in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("r")).collect():
            self.cells.sizes[s["cell"]], self.cells.radius[s["cell"]] = s["n"], s["r"]
        self.first, self.parts, self.blocks = pack_cells(self.cells.sizes, block_rows(self.rows, topic_rows, 8 * dim))
        places = [(c, int(self.first[c]), int(self.parts[c])) for c in np.flatnonzero(self.cells.sizes).tolist()]
        places = F.broadcast(self.spark.createDataFrame(places, "cell int, first int, parts int"))
        part = F.pmod(F.xxhash64("point_id"), F.col("parts"))
        self.topics = placed.join(places, "cell").select(
            "point_id", "topic_id", "vector", "cell", (F.col("first") + part).cast("int").alias("block")
        )

    def visits(self, asked: DataFrame, rows=None, nprobe=None, reached=None) -> DataFrame:
        """``(o, vector, floor, visits)``, stored: the blocks that an opinion visits, with its cells there.

        Leading cells until ``rows`` topics are seen, the nearest ``nprobe`` cells, or with ``reached``
        all others whose bound reaches that column. A score below ``floor`` is none of the k best.
        """
        sent = self.spark.sparkContext.broadcast((self.cells, self.first, self.parts))
        kinds = "o bigint, vector array<double>, floor double, visits array<struct<block:int,cells:array<int>,pairs:bigint>>"
        columns = ["o", "vector", *([reached] if reached else [])]
        return settled(asked.select(*columns).mapInArrow(_visits(sent, self.dim, rows, nprobe, reached), kinds), "match-visits")

    def hits(self, visits: DataFrame, k: int, opinion_rows: int, opinions: int) -> DataFrame:
        """The k best of the visited cells for each opinion and block, stored."""
        chunks = max(1, -(-opinions // block_rows(opinions, opinion_rows, 8 * self.dim)))
        left = visits.select("o", "vector", "floor", F.inline("visits")).drop("pairs").withColumn("chunk", _hash("o", chunks))
        right = self.topics.withColumn("chunk", _each(F.lit(chunks)))
        found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
        return settled(found.applyInArrow(_score_cells(self.dim, k), HIT), "match-hits")


def _parts(batch, cells):
    """A batch in slices of bounded size for arrays of its rows by cells."""
    for start, stop in slices(np.full(batch.num_rows, 8 * len(cells.centres) + 1)):
        yield batch.slice(start, stop - start)


def _place(sent, dim):
    def run(batches):
        for batch in (part for whole in batches for part in _parts(whole, sent.value)):
            unit, _ = _unit_rows(batch.column("vector"), dim)
            angles = sent.value.angles(unit)
            cell = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])],
                names=[*batch.schema.names, "cell", "angle"],
            )

    return run


def _lists(wanted, cells, first, parts):
    """The blocks of the wanted cells of each row, with the cells and the pairs in each."""
    row, cell = np.nonzero(wanted)
    size = parts[cell]
    at = np.repeat(np.arange(len(cell)), size)
    part = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    row, cell = row[at], cell[at]
    block = first[cell] + part  # rises within a row
    # A cut cell counts once, with its first block.
    pairs = np.append(0, np.cumsum(np.where(part == 0, cells.sizes[cell], 0)))
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    edges = np.append(new, len(row))
    found = pa.StructArray.from_arrays(
        [
            pa.array(block[new].astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(cell.astype(np.int32))),
            pa.array(np.diff(pairs[edges])),
        ],
        names=["block", "cells", "pairs"],
    )
    counts = np.bincount(row[new], minlength=len(wanted))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), found)


def _visits(sent, dim, rows, nprobe, reached):
    def run(batches):
        cells, first, parts = sent.value
        for batch in (part for whole in batches for part in _parts(whole, cells)):
            unit, valid = _unit_rows(batch.column("vector"), dim)
            if nprobe:
                wanted = cells.nearest(unit, nprobe)
            else:
                wanted = cells.leading(unit, rows)
            floor = np.full(len(unit), -2.0)
            if reached:
                floor = batch.column(reached).to_numpy() - MARGIN
                wanted = ~wanted & (cells.bounds(unit) >= floor[:, None]) & (cells.sizes > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("o"),
                    batch.column("vector"),
                    pa.array(floor),
                    _lists(wanted & valid[:, None], cells, first, parts),
                ],
                names=["o", "vector", "floor", "visits"],
            )

    return run


def _score_cells(dim, k):
    """The k best topics of the visited cells of a block, a matrix product for each cell."""

    def run(visits, topics):
        empty = pa.table({"opinion_id": pa.array([], pa.int64())} | {c: pa.array([], pa.string()) for c in ("point_id", "topic_id")} | {"score": pa.array([], pa.float64())})
        if not visits.num_rows or not topics.num_rows:
            return empty
        order = sorted(
            range(topics.num_rows),
            key=lambda i, t=topics["topic_id"].to_pylist(), p=topics["point_id"].to_pylist(): (t[i] or "", p[i]),
        )
        topics = topics.take(pa.array(order, pa.int64()))  # positions are in tie order
        of, n = topics["cell"].to_numpy(), topics.num_rows
        matrix, _ = _unit_rows(topics["vector"], dim)
        unit, _ = _unit_rows(visits["vector"], dim)
        lists = visits["cells"].combine_chunks()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        cell = lists.flatten().to_numpy()
        by_cell = np.argsort(cell, kind="stable")
        met, start = np.unique(cell[by_cell], return_index=True)
        floor = visits["floor"].to_numpy()
        best = np.full((len(unit), k), LEAST)
        for c, at in zip(met.tolist(), np.split(by_cell, start[1:])):
            who, members = row[at], np.flatnonzero(of == c)
            if len(members):
                top = best[who]
                keep_nearest(top, unit[who], matrix[members], members, n, floor[who])
                best[who] = top
        i, j = np.nonzero(best > LEAST)
        key = best[i, j]
        score = key // n
        at = pa.array(n - 1 - (key - score * n), pa.int64())
        return pa.table(
            {
                "opinion_id": visits["o"].take(pa.array(i, pa.int64())),
                "point_id": topics["point_id"].take(at),
                "topic_id": topics["topic_id"].take(at),
                "score": score / SCALE,
            }
        )

    return run


def asked_rows(opinions: DataFrame, keep=()) -> DataFrame:
    """The stored opinions with a row number ``o``."""
    rows = opinions.select("opinion_id", *keep, F.col("vector").cast("array<double>").alias("vector"))
    return settled(rows.withColumn("o", F.monotonically_increasing_id()), "match-asked")


def rounds(file: InvertedFile, asked: DataFrame, k: int, opinion_rows: int, nprobe=None):
    """The visits and the hits of each round."""
    count = asked.count()
    first = file.visits(asked, rows=max(8 * k, file.rows * FIRST_SHARE), nprobe=nprobe)
    found = file.hits(first, k, opinion_rows, count)
    if nprobe:
        return [first], [found]
    # The k-th best so far, over all blocks; below every score where there are fewer.
    kth = merged_hits(found, k).select(
        F.col("opinion_id").alias("o"),
        F.when(F.size("hits") >= k, F.element_at("hits", -1)["score"]).otherwise(F.lit(-2.0)).alias("kth"),
    )
    second = file.visits(
        asked.join(kth, "o", "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0))),
        rows=max(8 * k, file.rows * FIRST_SHARE),
        reached="kth",
    )
    return [first, second], [found, file.hits(second, k, opinion_rows, count)]


def cell_hits(opinions, topics, k, keep, dim, topic_rows, opinion_rows, n_cells=None, seed=42, nprobe=None) -> DataFrame:
    """``opinion_id``, the ``keep`` columns and ``hits``, as ``match.topic_hits`` gives them."""
    file = InvertedFile(topics, dim, topic_rows, n_cells, seed)
    asked = asked_rows(opinions, keep)
    if not file.rows:
        return asked.select("opinion_id", *keep, F.lit(None).cast("array<struct<point_id:string,topic_id:string,score:double>>").alias("hits"))
    _, found = rounds(file, asked, k, opinion_rows, nprobe)
    hits = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    best = merged_hits(hits, k).withColumnRenamed("opinion_id", "o")
    return asked.drop("vector").join(best, "o", "left").drop("o")


def probe_report(opinions, topics, k, dim, probes, topic_rows=1 << 15, opinion_rows=1 << 15, n_cells=None, seed=42) -> DataFrame:
    """For each number of probed cells, and for the exact plan (0): pairs scored, their share, recall.

    Recall is the share of the exact hits that are found, over all opinions.
    """
    file = InvertedFile(topics, dim, topic_rows, n_cells, seed)
    asked = asked_rows(opinions)
    pairs = asked.filter(vectors.l2_normalise("vector").isNotNull()).count() * file.rows
    exact, out = None, []
    for probe in (0, *probes):
        visits, found = rounds(file, asked, k, opinion_rows, probe or None)
        hits = merged_hits(found[0] if probe else found[0].unionByName(found[1]), k)
        hits = settled(hits.select("opinion_id", F.explode("hits.point_id").alias("point_id")), "match-found")
        exact = hits if exact is None else exact
        scored = sum(v.select(F.inline("visits")).agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0] for v in visits)
        right = hits.join(exact.withColumnRenamed("point_id", "p"), "opinion_id").filter("point_id = p").count()
        out.append((probe, scored, scored / max(1, pairs), right / max(1, exact.count())))
    return opinions.sparkSession.createDataFrame(out, "nprobe int, pairs_scored long, share double, recall double")
