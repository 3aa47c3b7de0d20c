"""Near-duplicates by SimHash, compared on bit planes.

Fingerprints are computed per text on Arrow batches. Equal fingerprints are merged first. Two
different ones within the radius agree on at least one of ``radius + 1`` stretches of their bits,
so they meet in the group of that stretch. A group that is still large is cut by the same argument
on its remaining bits, again and again: a group that shares all but r bits has ``2 ** r`` members
at most, so this ends, and no pair is lost or capped.

In a group the fingerprints are stored as vertical bit planes, 64 lanes to a word. A query
fingerprint is compared with all lanes at once: the differing bits of each plane are added into
carry-save counters, and words whose lanes are all beyond the radius are left out from then on. A
group gives the edges of a spanning forest, never all its pairs.
"""

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from agoralens.llm.common import ascii_words, portions
from agoralens.llm.components import components, smallest_kept
from agoralens.session import settled

SEED = 42
BITS = 64
LANES = 4096
TILE = 256
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text, words=3):
    """The SimHash of one text: a bit is set if more than half of the shingle hashes have it."""
    tokens = ascii_words(text)
    if not tokens:
        return 0
    shingles = [b" ".join(tokens)] if len(tokens) < words else map(b" ".join, zip(*[tokens[i:] for i in range(words)]))
    n = max(1, len(tokens) - words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, 8192):
        octets = hashes[start : start + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs, text_col="text", words=3, others=("doc_id",)):
    """The columns ``others`` with ``fp``, the fingerprint as a signed number of 64 bits."""
    rows = docs.select(*others, F.col(text_col).alias("_text"))

    def run(batches):
        for batch in portions(batches):
            values = [fingerprint(t.as_py(), words) for t in batch.column(batch.num_columns - 1)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values, pa.int64())], names=[*others, "fp"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_text").schema)
    return rows.mapInArrow(run, f"{kinds}, fp bigint")


def bit_planes(values):
    """Vertical bit planes: row b holds bit b of all values, packed into words of 64 lanes."""
    width = -(-len(values) // 64) * 64
    padded = np.zeros(width, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(width, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def lanes_within(planes, queries, radius, every=8):
    """For each query a row of words: the lanes that differ from it in ``radius`` bits at most.

    Saturating carry-save counters of as many bits as the radius needs: ``counter[i]`` holds bit i
    of the counts of 64 lanes, ``over`` the lanes that have left the range. After ``every`` planes
    the words in which no lane is left are abandoned.
    """
    size = int(radius + 1).bit_length()
    words = planes.shape[1]
    row, word = (x.ravel() for x in np.meshgrid(np.arange(len(queries)), np.arange(words), indexing="ij"))
    near = np.zeros(len(row), np.uint64)
    at = np.arange(len(row))
    counter = np.zeros((size, len(row)), np.uint64)
    over = np.zeros(len(row), np.uint64)
    # Counts start so high that passing the radius carries out of the counter.
    start = (1 << size) - (radius + 1)
    for i in range(size):
        counter[i] = ALL if start >> i & 1 else 0
    for b in range(BITS):
        flip = np.where(queries >> np.uint64(b) & np.uint64(1), ALL, np.uint64(0))
        carry = planes[b][word] ^ flip[row]
        for i in range(size):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        over |= carry
        if b % every == every - 1 and b < BITS - 1:
            left = np.flatnonzero(over != ALL)
            if len(left) < 0.8 * len(over):
                counter, over, row, word, at = counter[:, left], over[left], row[left], word[left], at[left]
                if not len(left):
                    break
    near[at] = ~over
    return near.reshape(len(queries), words)


def forest(labels, a, b):
    """Labels after joining the classes of the lanes a[i] and b[i]; a label is a smallest lane."""
    while len(a):
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, labels):
            break
        labels = new
    return labels


def block_edges(values, keys, radius):
    """Edges of a spanning forest of the values that are near each other and have one key."""
    planes = bit_planes(values)
    labels = np.arange(len(values))
    for start in range(0, len(values), TILE):
        queries = values[start : start + TILE]
        near = lanes_within(planes, queries, radius)
        q, lane = np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(values)])
        q += start
        right = (lane > q) & (keys[lane] == keys[q])
        labels = forest(labels, q[right], lane[right])
    moved = np.flatnonzero(labels != np.arange(len(values)))
    return values[moved].view(np.int64), values[labels[moved]].view(np.int64)


def _near_in_groups(radius, lanes):
    """Rows sorted by group, cut between groups into blocks of about ``lanes`` rows."""

    def flush(fps, keys):
        u, v = block_edges(fps.view(np.uint64), keys, radius)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches):
        fps, keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            fps = np.concatenate([fps, batch.column("fp").to_numpy()])
            keys = np.concatenate([keys, batch.column("g").to_numpy()])
            while len(fps) > lanes:
                cuts = np.flatnonzero(np.diff(keys)) + 1
                if not len(cuts):
                    break
                fit = cuts[cuts <= lanes]
                cut = fit[-1] if len(fit) else cuts[0]
                yield flush(fps[:cut], keys[:cut])
                fps, keys = fps[cut:], keys[cut:]
        if len(fps):
            yield flush(fps, keys)

    return run


def _stretches(bits, parts):
    """``bits`` positions cut into ``parts`` neighbouring stretches."""
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:])]


def _value(column, bits):
    """The value of neighbouring bits of a number."""
    return F.shiftrightunsigned(column, bits[0]).bitwiseAND(F.lit((1 << len(bits)) - 1).cast("bigint"))


def near_edges(distinct, radius=2, lanes=LANES):
    """``(u, v)`` edges that connect all of ``distinct`` fingerprints (``fp``) within the radius.

    Every level holds the groups ``(path, fp)`` that are still to be compared. Groups of ``lanes``
    fingerprints or fewer are compared, larger ones are cut by each stretch of the bits that they
    do not share yet. ``path`` names the stretches taken; the shared values follow from the
    fingerprint, so the group key is a hash of both and is never wrong by more than an extra
    comparison.
    """
    parts = radius + 1
    level = [((), tuple(range(BITS)))]
    out = None
    rows = distinct.select("fp", F.lit(0).alias("path"))
    while level:
        taken, narrowed = [], {}
        for number, (shared, free) in enumerate(level):
            for stretch in _stretches(free, parts):
                if stretch:
                    narrowed[len(taken)] = number
                    taken.append(((*shared, stretch), tuple(b for b in free if b not in stretch)))

        def key(path):
            pieces = [_value(F.col("fp"), list(run)) for s in taken[path][0] for run in _runs(s)]
            return F.struct(F.lit(path).alias("path"), F.xxhash64(F.lit(path), *pieces).alias("g"))

        keyed = None
        for number in range(len(level)):
            ways = [p for p in narrowed if narrowed[p] == number]
            cut = rows.where(F.col("path") == number).select("fp", F.explode(F.array(*[key(p) for p in ways])).alias("k"))
            keyed = cut if keyed is None else keyed.union(cut)
        keyed = settled(keyed.select("fp", "k.path", "k.g"), "simhash-groups")
        sizes = settled(keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes")
        largest = sizes.agg(F.max("n")).first()[0] or 0
        grouped = keyed.join(sizes, "g")
        small = grouped.where(F.col("n") <= lanes).select("g", "fp").repartition("g").sortWithinPartitions("g")
        edges = settled(small.mapInArrow(_near_in_groups(radius, lanes), "u bigint, v bigint"), "simhash-edges")
        out = edges if out is None else out.union(edges)
        if largest <= lanes:
            break
        rows = grouped.where(F.col("n") > lanes).select("fp", "path")
        level = taken
    return out


def _runs(bits):
    """Neighbouring runs of ascending positions."""
    runs = [[bits[0]]]
    for b in bits[1:]:
        if b == runs[-1][-1] + 1:
            runs[-1].append(b)
        else:
            runs.append([b])
    return runs


def near_groups(docs, id_col="doc_id", text_col="text", words=3, radius=2, lanes=LANES):
    """One row per document: id, ``fp`` and ``component_id``, the smallest id it reaches.

    A link is a distance of ``radius`` bits or fewer; links chain. Null and blank texts have
    fingerprint zero and are linked like any other; texts shorter than a shingle count as one.
    Repeated rows stay, with one component. Null ids never become a component id unless all ids
    of the component are null. An empty table gives an empty result. Other columns are ignored.
    """
    prints = settled(fingerprints(docs.select(F.col(id_col).alias("_id"), text_col), text_col, words, ("_id",)), "simhash")
    classes = settled(prints.groupBy("fp").agg(F.min("_id").alias("least")), "simhash-classes")
    roots = components(near_edges(classes, radius, lanes))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = settled(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settled(rooted.join(ids, "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select(F.col("_id").alias(id_col), "fp", "component_id")


def hex_digits(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_kept(docs, id_col="doc_id", text_col="text", words=3, radius=2):
    """The rows of ``docs`` that stay: of near-duplicates the one with the smallest id.

    Rows without an id stay, and so do all rows of an id of which one stays.
    """
    groups = near_groups(docs.where(F.col(id_col).isNotNull()), id_col, text_col, words, radius)
    return smallest_kept(docs, groups, id_col)
