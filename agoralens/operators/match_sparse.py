"""Nearest topics of sparse vectors through inverted lists, for topics of any size.

Weights are not negative, so a part of a score never exceeds the score. The inverted list of a
bucket holds the topics with a weight in it; its largest weight bounds what the bucket can add.

1. The few largest weights of each bucket (its champions) are sent to all tasks. Summed over the
   buckets that promise most, they give each opinion a score that its k-th best topic reaches.
2. An opinion's buckets are ordered by what they can add. Those at the end that together stay below
   that score need not be read: a topic which shares only these is not among the k best.
3. The other buckets are looked up in their lists, and the parts of a score are summed by pair. Pairs
   that cannot reach the score with the rest go.
4. The pairs that are left are scored on whole vectors.

The stored opinions stay where they are: the topics come to their tasks in blocks of bounded size, one
block and one pass after the other, and 3 and 4 are one step of a task, in tiles of bounded size. No
pair and no part of a score is shuffled or stored; with more than one block, the few hits of each are.

The driver holds sums over buckets (their number is fixed) and one block of topics at a time. No pair
that counts is dropped: the hits are those of comparing all pairs.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralens.functions.vectors import CHUNK_BYTES, slices
from agoralens.operators.match import BLOCK_BYTES, HIT_TYPE, HITS, SCALE, _blocks, _field, _unit_entries, entry_slices, ordered_hits
from agoralens.session import settled

CHAMPIONS = 32  # of each bucket
LEADING = 32  # buckets of an opinion whose champions are summed
LIST_ROWS = 1024  # topics in one part of a block's lists
READERS = 4096  # opinions that read a part of the lists at once
ENTRY_BYTES = 12
MARGIN = 10.0 / SCALE
CHAMPION = "f int, t bigint, w double"


def _units(names):
    """Batches with the columns ``names`` and the unit vector as ``f``, ``w``; null without a finite length."""

    def run(batches):
        for batch in (part for whole in batches for part in entry_slices(whole, "vector")):
            at, buckets, weights, valid = _unit_entries(batch.column("vector"))
            some = weights != 0
            sizes = np.bincount(at[some], minlength=batch.num_rows)
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(x[some]), mask=pa.array(~valid))
                for x in (buckets.astype(np.int32), weights)
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *lists], names=[*names, "f", "w"])

    return run


def _unit_fields(df, names):
    return [*[df.schema[n] for n in names], _field("f", "array<int>"), _field("w", "array<double>")]


def unit_rows(df: DataFrame, names) -> DataFrame:
    """The columns ``names`` and the unit vector as ``f``, ``w``; null without a finite length."""
    return df.select(*names, "vector").mapInArrow(_units(names), T.StructType(_unit_fields(df, names)))


class Lists:
    """The inverted lists of stored topics: postings, and for each bucket size, bound and champions."""

    def __init__(self, topics: DataFrame, dim: int, champions=CHAMPIONS):
        units = unit_rows(topics, ("point_id", "topic_id")).filter("f is not null")
        self.dim = dim
        self.topics = settled(units.withColumn("t", F.monotonically_increasing_id()), "match-topics")
        self.postings = settled(self.topics.select("t", F.inline(F.arrays_zip("f", "w"))), "match-postings")
        # One row for each bucket, and ``champions`` rows for each at most.
        sums = self.postings.groupBy("f").agg(F.count("*").alias("n"), F.max("w").alias("most")).toPandas()
        self.size, self.most = np.zeros(dim, np.int64), np.zeros(dim)
        self.size[sums["f"]], self.most[sums["f"]] = sums["n"], sums["most"]
        order = Window.partitionBy("f").orderBy(F.desc("w"), "t")
        best = self.postings.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= champions)
        best = best.select("f", "t", "w").toPandas().sort_values("f", kind="stable")
        self.start = np.searchsorted(best["f"].to_numpy(), np.arange(dim + 1))
        _, self.topic = np.unique(best["t"].to_numpy(), return_inverse=True)
        self.weight = best["w"].to_numpy()
        self.rows = self.topics.count()

    def ranges(self, count):
        """First and last number of the topics of each block: ``count`` blocks or fewer with about as many postings."""
        step = max(1, self.rows // (32 * count))
        sums = self.topics.groupBy(F.expr(f"t div {step}").alias("g")).agg(F.sum(F.size("f")).alias("n"))
        sums = sums.toPandas().sort_values("g")  # about 32 rows for each block
        if not len(sums):
            return []
        sizes = sums["n"].to_numpy(np.int64)
        ahead = np.cumsum(sizes) - sizes
        first = np.unique(ahead * count // sizes.sum(), return_index=True)[1]
        edges = (sums["g"].to_numpy(np.int64)[first] * step).tolist()
        return list(zip(edges, [*(e - 1 for e in edges[1:]), (1 << 63) - 1]))

    def sent_block(self, numbers, list_rows=LIST_ROWS):
        """The topics between two numbers, sent to all tasks."""
        table = self.topics.filter(F.col("t").between(*numbers)).select("t", "point_id", "topic_id", "f", "w").toArrow()
        return self.topics.sparkSession.sparkContext.broadcast(ListBlock(table, self.dim, list_rows))


class ListBlock:
    """Some topics in tie order: their vectors, and their inverted lists in parts of ``list_rows`` topics."""

    def __init__(self, table, dim, list_rows=LIST_ROWS):
        order = sorted(
            range(table.num_rows),
            key=lambda i, t=table["topic_id"].to_pylist(), p=table["point_id"].to_pylist(): (t[i] or "", p[i] or ""),
        )
        table = table.take(pa.array(order, pa.int64()))
        self.numbers, self.points, self.topic_ids, f, w = (
            table[c].combine_chunks() for c in ("t", "point_id", "topic_id", "f", "w")
        )
        self.dim, self.sizes = dim, np.diff(f.offsets.to_numpy()).astype(np.int64)
        self.start = np.append(0, np.cumsum(self.sizes))
        self.buckets, self.weights = f.flatten().to_numpy(), w.flatten().to_numpy()
        self.listed = np.bincount(self.buckets, minlength=dim)  # topics in each list
        self.parts = []
        for a in range(0, len(self.sizes), list_rows):
            b = min(a + list_rows, len(self.sizes))
            own = slice(self.start[a], self.start[b])
            by_bucket = np.argsort(self.buckets[own], kind="stable")
            start = np.searchsorted(self.buckets[own][by_bucket], np.arange(dim + 1))
            topic = np.repeat(np.arange(b - a), self.sizes[a:b])[by_bucket]
            self.parts.append((a, b - a, start, topic, self.weights[own][by_bucket]))

    def pairs(self, rows, buckets, values, reached, rest):
        """Rows and topics that share an entry and whose parts of a score reach, with the rest, that of the row."""
        out = [], []
        for ahead, width, start, topic, weight in self.parts:
            entry, at = _runs(start[buckets], start[buckets + 1])
            cell = rows[entry] * width + topic[at]
            total = np.bincount(cell, weights=values[entry] * weight[at], minlength=len(reached) * width)
            met = np.zeros(len(total), bool)
            met[cell] = True
            met &= (total.reshape(-1, width) + rest[:, None] >= reached[:, None] - MARGIN).ravel()
            found = np.flatnonzero(met)
            out[0].append(found // width)
            out[1].append(found % width + ahead)
        return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)

    def scores(self, vectors, rows, topics):
        """The whole scores of pairs, in units of the last digit, for dense rows of opinions."""
        out = [np.zeros(0)]
        for a, b in slices(5 * self.sizes[topics]):
            t = topics[a:b]
            pair, at = _runs(self.start[t], self.start[t + 1])
            parts = vectors[rows[a:b][pair], self.buckets[at]] * self.weights[at]
            out.append(np.rint(np.bincount(pair, weights=parts, minlength=b - a) * SCALE))
        return np.concatenate(out)


def _runs(first, last):
    """The numbers from ``first`` to before ``last`` of each run, one run after the other, with the place of their run."""
    size = last - first
    run = np.repeat(np.arange(len(size)), size)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + first[run]


def _ranks(rows, order):
    """The place of each entry within its row, for entries put in ``order`` with rows together."""
    sorted_rows = rows[order]
    first = np.append(True, sorted_rows[1:] != sorted_rows[:-1]) if len(order) else np.zeros(0, bool)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return place


def reached_scores(rows, buckets, values, count, lists, k, leading=LEADING):
    """For each row a score that its k-th best topic reaches, zero where that is not known."""
    start, topic, weight, most = lists
    gain = values * most[buckets]
    lead = _ranks(rows, np.lexsort((-gain, rows))) < leading
    rows, buckets, values = rows[lead], buckets[lead], values[lead]
    size = start[buckets + 1] - start[buckets]
    entry = np.repeat(np.arange(len(rows)), size)
    at = np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size) + start[buckets][entry]
    width = int(topic.max(initial=0)) + 1
    pair, where = np.unique(rows[entry] * width + topic[at], return_inverse=True)
    total = np.bincount(where, weights=values[entry] * weight[at], minlength=len(pair))
    of = pair // width
    kth = _ranks(of, np.lexsort((-total, of))) == k - 1
    out = np.zeros(count)
    out[of[kth]] = total[kth]
    return out


def needed_buckets(rows, buckets, values, reached, most):
    """Which entries must be read, and for each row the most that the others can add."""
    gain = values * most[buckets]
    order = np.lexsort((gain, rows))
    ahead = np.cumsum(gain[order])
    first = np.searchsorted(rows[order], np.arange(len(reached)))
    before = np.append(0, ahead)[first]
    upto = np.empty(len(order))
    upto[order] = ahead - before[rows[order]]
    need = upto >= reached[rows] - MARGIN
    rest = np.zeros(len(reached))
    np.maximum.at(rest, rows[~need], upto[~need])
    return need & (most[buckets] > 0), rest


def _asked(sent, k):
    """Opinions with the score they reach, the buckets to read ahead of the others, their number and the bound of the others."""

    def run(batches):
        lists = sent.value
        champions = 8 * LEADING * int(np.diff(lists[0]).max(initial=0))
        for batch in (part for whole in batches for part in entry_slices(whole, "f", row=champions)):
            rows, buckets, values = _flat(batch)
            reached = reached_scores(rows, buckets, values, batch.num_rows, lists, k)
            need, rest = needed_buckets(rows, buckets, values, reached, lists[3])
            order = np.lexsort((~need, rows))
            known = batch.column("f").is_valid()
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(rows, minlength=batch.num_rows))).astype(np.int32))
            vector = [
                pa.ListArray.from_arrays(offsets, pa.array(x[order]), mask=pc.invert(known))
                for x in (buckets.astype(np.int32), values)
            ]
            names = [n for n in batch.schema.names if n not in ("f", "w")]
            count = np.bincount(rows[need], minlength=batch.num_rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *vector, pa.array(count), pa.array(reached), pa.array(rest)],
                names=[*names, "f", "w", "need", "reached", "rest"],
            )

    return run


def _flat(batch):
    """Row, bucket and weight of each entry of the unit vectors of a batch."""
    f, w = batch.column("f"), batch.column("w")
    sizes = np.where(f.is_valid(), np.diff(f.offsets.to_numpy()), 0)
    return np.repeat(np.arange(batch.num_rows), sizes), f.flatten().to_numpy().astype(np.int64), w.flatten().to_numpy()


def asked_rows(opinions: DataFrame, lists: Lists, k: int, names) -> DataFrame:
    """The stored opinions with what step 1 and 2 say of them and a row number ``o``.

    The first ``need`` entries of ``f`` and ``w`` must be read; vectors are stored once.
    """
    sent = opinions.sparkSession.sparkContext.broadcast((lists.start, lists.topic, lists.weight, lists.most))
    kinds = [
        *_unit_fields(opinions, names),
        _field("need", "int"),
        _field("reached", "double"),
        _field("rest", "double"),
    ]
    units, ask = _units(names), _asked(sent, k)
    # One pass: each step of its own would hold a Python worker and a batch more in every task.
    rows = opinions.select(*names, "vector").mapInArrow(lambda batches: ask(units(batches)), T.StructType(kinds))
    return settled(rows.withColumn("o", F.monotonically_increasing_id()), "match-asked")


def _visits(batches, block, readers):
    """Slices of batches whose sums are of bounded size: the slice, its entries, and its candidates in the block."""
    for batch in (part for whole in batches for part in entry_slices(whole, "f")):
        rows, buckets, values = _flat(batch)
        need, reached, rest = (batch.column(c).to_numpy() for c in ("need", "reached", "rest"))
        first = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        read = np.arange(len(rows)) - first[rows] < need[rows]
        cost = 5 * np.bincount(rows[read], weights=block.listed[buckets[read]], minlength=batch.num_rows)
        cost += 4 * max((width for _, width, *_ in block.parts), default=0) + block.dim
        for a, b in slices(np.maximum(cost, CHUNK_BYTES // 8 / readers)):
            own = slice(first[a], first[b])
            entries = rows[own] - a, buckets[own], values[own]
            asked = (x[read[own]] for x in entries)
            yield batch.slice(a, b - a), entries, *block.pairs(*asked, reached[a:b], rest[a:b])


def _pairs_of(asked, sent, number, readers=READERS):
    """``(o, block, t)``: the pairs of a block of topics that can be among the k best."""

    def run(batches):
        block = sent.value
        for batch, _, rows, topics in _visits(batches, block, readers):
            o, t = batch.column("o").take(pa.array(rows)), block.numbers.take(pa.array(topics))
            yield pa.RecordBatch.from_arrays([o, pa.array(np.full(len(rows), number, np.int32)), t], names=["o", "block", "t"])

    return asked.select("o", "f", "w", "need", "reached", "rest").mapInArrow(run, "o bigint, block int, t bigint")


def candidate_pairs(asked: DataFrame, lists: Lists, topic_blocks: int, list_rows=LIST_ROWS, readers=READERS) -> DataFrame:
    """``(o, block, t)``: the pairs that can be among the k best, ``block`` the block of the topic."""
    parts = [
        _pairs_of(asked, lists.sent_block(numbers, list_rows), i, readers)
        for i, numbers in enumerate(lists.ranges(topic_blocks))
    ]
    if not parts:
        return asked.select("o", F.lit(0).alias("block"), F.col("o").alias("t")).limit(0)
    return reduce(DataFrame.unionAll, parts)


def _hits_of(asked, sent, k, names, readers):
    """The columns ``names`` and ``found``: the k best candidates in a block of topics, null without a vector."""

    def run(batches):
        block = sent.value
        for batch, (at, buckets, values), rows, topics in _visits(batches, block, readers):
            vectors = np.zeros((batch.num_rows, block.dim))
            vectors[at, buckets] = values
            score = block.scores(vectors, rows, topics)
            order = np.lexsort((topics, -score, rows))
            best = order[_ranks(rows, order)[order] < k]
            j = pa.array(topics[best])
            hit = pa.StructArray.from_arrays(
                [block.points.take(j), block.topic_ids.take(j), pa.array(score[best] / SCALE)],
                fields=list(HIT_TYPE.value_type),
            )
            offsets = np.append(0, np.cumsum(np.bincount(rows[best], minlength=batch.num_rows)))
            known = batch.column("f").is_valid()
            found = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), hit, type=HIT_TYPE, mask=pc.invert(known))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], found], names=[*names, "found"])

    columns = dict.fromkeys([*names, "f", "w", "need", "reached", "rest"])
    kinds = T.StructType([*[asked.schema[n] for n in names], _field("found", HITS)])
    return asked.select(*columns).mapInArrow(run, kinds)


def _found(asked, lists, k, names, topic_rows, readers):
    """The columns ``names`` and ``found``, the k best candidates in all blocks of topics, null without a vector."""
    ranges = lists.ranges(_blocks(lists.rows, topic_rows))
    if len(ranges) == 1:
        return _hits_of(asked, lists.sent_block(ranges[0]), k, names, readers)
    none = F.when(F.col("f").isNotNull(), F.array().cast(HITS))
    parts = []
    for numbers in ranges:
        sent = lists.sent_block(numbers)
        # Stored, so that the tasks need one block at a time.
        parts.append(settled(_hits_of(asked, sent, k, ["o"], readers).filter(F.size("found") > 0), "match-hits"))
        sent.destroy()
    if not parts:
        return asked.select(*names, none.alias("found"))
    best = reduce(DataFrame.unionAll, parts).groupBy("o").agg(F.flatten(F.collect_list("found")).alias("all"))
    best = best.select("o", ordered_hits(F.col("all"), k).alias("best"))
    rows = asked.select(*names, "o", none.alias("none")).join(best, "o", "left")
    return rows.select(*names, F.coalesce("best", "none").cast(HITS).alias("found"))


def listed_hits(opinions, topics, k, keep, dim, topic_rows, opinion_rows) -> DataFrame:
    """``opinion_id``, the ``keep`` columns and ``hits``, as ``match.topic_hits`` gives them.

    None where a weight is below zero, since a part of a score then says nothing of the score.
    """
    lists = Lists(topics, dim)
    names = ["opinion_id", *keep]
    asked = asked_rows(opinions, lists, k, names)
    if any((df.agg(F.min(F.array_min("w"))).first()[0] or 0) < 0 for df in (lists.topics, asked)):
        return None
    rows = _found(asked, lists, k, names, topic_rows, opinion_rows)
    # Where fewer than k topics share a bucket, the first ones in tie order follow with no score.
    first = lists.topics.orderBy(F.coalesce("topic_id", F.lit("")), "point_id").limit(k)
    first = [(r["point_id"], r["topic_id"], 0.0) for r in first.select("point_id", "topic_id").collect()]
    none = F.lit(None).cast(HITS)
    if first:
        none = F.array(*[F.struct(F.lit(p).alias("point_id"), F.lit(t).alias("topic_id"), F.lit(s).alias("score")) for p, t, s in first])
    others = F.filter(none, lambda h: ~F.exists("found", lambda x: x["point_id"] == h["point_id"]))
    filled = ordered_hits(F.concat("found", others.cast(HITS)), k)
    hits = F.when(F.size("found") >= k, F.col("found")).when(F.col("found").isNotNull(), filled)
    return rows.select(*names, hits.cast(HITS).alias("hits"))


def pair_report(opinions: DataFrame, topics: DataFrame, k: int, dim: int) -> DataFrame:
    """How many pairs there are, how many entries of the lists are read and how many pairs are scored."""
    topics = topics.filter("vector is not null")
    lists = Lists(topics, dim)
    asked = asked_rows(opinions, lists, k, ["opinion_id"])
    known = asked.filter("f is not null")
    sizes = [(b, int(n)) for b, n in enumerate(lists.size)]
    sizes = F.broadcast(opinions.sparkSession.createDataFrame(sizes, "f int, n long"))
    met = known.select("need", F.posexplode("f").alias("place", "f")).join(sizes, "f")
    read = F.when(F.col("place") < F.col("need"), F.col("n"))
    entries = met.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in ("n", read)]).first()
    scored = 0
    for i, numbers in enumerate(lists.ranges(_blocks(int(lists.size.sum()) * ENTRY_BYTES, BLOCK_BYTES))):
        sent = lists.sent_block(numbers)
        scored += _pairs_of(asked, sent, i).count()
        sent.destroy()
    counts = (known.count() * lists.rows, *entries, scored)
    return opinions.sparkSession.createDataFrame([counts], "pairs long, entries long, entries_read long, pairs_scored long")
