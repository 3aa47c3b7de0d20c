"""Importance resampling towards a target collection on hashed word n-grams.

Features are the runs of one to three words of a text; each falls into the bucket of its CRC-32.
The vocabulary has a head and a tail. For the frequent words the CRC states of the word and of the
word behind a space are broadcast, and for the frequent pairs of words their states and buckets.
The state of a longer run follows from those of its parts: a CRC is linear, so the state of ``ab`` is
that of ``a`` moved over the length of ``b``, combined with that of ``b``. Runs of head words are
thus computed on arrays. A run with a word of the tail takes the direct CRC of its bytes, or goes on
from it. Either way gives the exact bucket, so the choice of the head never changes a result.

The texts are read three times: for the head, for the totals of each bucket, for the weights. All
texts are read whole, and what a task holds is bounded.
"""

import heapq
import math
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agoralens.llm.common import slices
from agoralens.session import settled

BUCKETS = 10000
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 16
PAIR_SLOTS = 1 << 19
LONGEST = 24  # bytes of a word of the head, and of what a state is moved over at once
COUNTED = 200_000  # words or pairs that a task counts at once
SENT = 1 << 15  # words or pairs that a task reports
GROUP_CHARS = 4_000_000
POLYNOMIAL = 0xEDB88320  # reflected CRC-32

#: Lower case for A-Z, itself for other bytes of words, a space for all others.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text):
    """The words of the bytes of a text: runs of ASCII letters and digits and of all other code points."""
    return text.translate(WORD_BYTES).split()


def bucket_of(run, buckets=BUCKETS):
    """The direct way: the bucket of one run of words."""
    return zlib.crc32(b" ".join(run)) % buckets


def _moves(longest):
    """For each number of bytes, four tables that move a CRC state over so many bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    octets = np.arange(256, dtype=np.uint32)
    tables = [np.stack([octets << np.uint32(8 * i) for i in range(4)])]
    for _ in range(longest):
        last = tables[-1]
        tables.append(step[last & np.uint32(255)] ^ (last >> np.uint32(8)))
    return np.stack(tables)


MOVES = _moves(LONGEST + 1)


def joined(state, tail, length):
    """The CRCs of ``ab`` from those of ``a`` and ``b`` and the length of ``b``, on arrays."""
    out = tail.copy()
    for i in range(4):
        out ^= MOVES[length, i, state >> np.uint32(8 * i) & np.uint32(255)]
    return out


@dataclass
class Head:
    """Frequent words with their CRC states, frequent pairs with theirs; of fixed size."""

    numbers: dict  # of words
    states: np.ndarray  # CRC of the word
    spaced: np.ndarray  # CRC of a space and the word
    lengths: np.ndarray  # bytes of a space and the word
    pairs: np.ndarray  # pair of each slot, or -1
    pair_states: np.ndarray
    pair_buckets: np.ndarray


def _slot(pairs):
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (PAIR_SLOTS.bit_length() - 1))


def make_head(words, pairs, buckets=BUCKETS):
    """A head of the given words and pairs of words, most frequent first.

    Of two pairs with one slot the more frequent one stays; the other is computed from its words.
    """
    words = [w for w in words if len(w) <= LONGEST]
    numbers = {w: i for i, w in enumerate(words)}
    states = np.array([zlib.crc32(w) for w in words], np.uint32)
    spaced = np.array([zlib.crc32(b" " + w) for w in words], np.uint32)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    found = [(a, b) for a, b in pairs if a in numbers and b in numbers]
    keys = np.array([numbers[a] * len(words) + numbers[b] for a, b in found], np.int64)
    crc = np.array([zlib.crc32(a + b" " + b) for a, b in found], np.uint32)
    held, held_states = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, np.uint32)
    slots = _slot(keys)[::-1]
    held[slots], held_states[slots] = keys[::-1], crc[::-1]
    return Head(numbers, states, spaced, lengths, held, held_states, (held_states % buckets).astype(np.int64))


def buckets_of(head, texts, buckets=BUCKETS):
    """The buckets of all features of some texts (bytes), one array for each order, with the text of each."""
    words, sizes = [], []
    for text in texts:
        found = words_of(text)
        words += found
        sizes.append(len(found))
    sizes = np.array(sizes, np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    n = len(words)
    if not n:
        return [np.zeros(0, np.int64)] * 3, [of] * 3, sizes
    number = np.fromiter(map(head.numbers.get, words, [-1] * n), np.int64, n)
    tail = np.flatnonzero(number < 0)
    known = np.maximum(number, 0)
    nothing = not len(head.states)
    state = np.zeros(n, np.uint32) if nothing else head.states[known]
    spaced = np.zeros(n, np.uint32) if nothing else head.spaced[known]
    length = np.zeros(n, np.int64) if nothing else head.lengths[known]
    # The tail: direct CRC of its bytes.
    state[tail] = [zlib.crc32(words[i]) for i in tail.tolist()]
    spaced[tail] = [zlib.crc32(b" " + words[i]) for i in tail.tolist()]
    length[tail] = [len(words[i]) + 1 for i in tail.tolist()]
    long = length > LONGEST + 1

    one = (state % buckets).astype(np.int64)
    two_at = np.flatnonzero(of[1:] == of[:-1])
    pair, two = _extended(head, number, state, spaced, length, long, words, two_at, buckets)
    three_at = np.flatnonzero(of[2:] == of[:-2])
    whole = np.zeros(n, np.uint32)
    whole[two_at] = pair
    three = _moved(whole[three_at], three_at + 2, spaced, length, long, words)
    return [one, two, (three % buckets).astype(np.int64)], [of, of[two_at], of[three_at]], sizes


def _moved(state, last, spaced, length, long, words):
    """The CRCs of runs one word longer: arrays for most words, the bytes of very long ones."""
    out = joined(state, spaced[last], np.minimum(length[last], LONGEST + 1))
    for i in np.flatnonzero(long[last]).tolist():
        out[i] = zlib.crc32(b" " + words[last[i]], int(state[i]))
    return out


def _extended(head, number, state, spaced, length, long, words, at, buckets):
    """The CRCs and buckets of the pairs that start at some words; frequent ones are looked up."""
    first, second = number[at], number[at + 1]
    key = np.where((first >= 0) & (second >= 0), first * len(head.numbers) + second, -2)
    slot = _slot(key)
    hit = head.pairs[slot] == key
    crc, bucket = head.pair_states[slot], head.pair_buckets[slot]
    rest = np.flatnonzero(~hit)
    crc[rest] = _moved(state[at[rest]], at[rest] + 1, spaced, length, long, words)
    bucket[rest] = crc[rest] % buckets
    return crc, bucket


def _texts(batch):
    """The texts of a batch as bytes, null as none, in groups of bounded size."""
    values = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
    for a, b in slices([len(t) for t in values], GROUP_CHARS):
        yield a, b, values[a:b]


class _Frequent:
    """Counts of frequent things in bounded memory: the rarer part goes when there are too many."""

    def __init__(self):
        self.counts = Counter()

    def add(self, things):
        self.counts.update(things)
        if len(self.counts) > COUNTED:
            self.counts = Counter(dict(self.most(COUNTED // 4)))

    def most(self, n):
        return heapq.nlargest(n, self.counts.items(), key=lambda x: x[1])


def _repeated(keys):
    """The keys that occur more than once, at most ``SENT`` of the most frequent, and how often."""
    found, counts = np.unique(keys, return_counts=True)
    often = np.flatnonzero(counts > 1)
    if len(often) > SENT:
        often = often[np.argpartition(counts[often], len(often) - SENT)[-SENT:]]
    return found[often].tolist(), counts[often].tolist()


def count_frequent(texts, words, pairs):
    """Add the words and the pairs of words that some texts repeat to both counts."""
    number = defaultdict(count().__next__)  # a word met for the first time gets the next number
    parts = [np.array([-1])]
    for text in texts:
        found = words_of(text)
        parts.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
        parts.append(np.array([-1]))  # no pair reaches over the end of a text
    ids, names = np.concatenate(parts), list(number)
    short = np.append([len(w) <= LONGEST for w in names], False).astype(bool)
    some, times = _repeated(ids[short[ids]])
    words.add({names[i]: n for i, n in zip(some, times)})
    often = np.zeros(len(names) + 1, bool)
    often[some] = True
    first, second = ids[:-1], ids[1:]
    both = often[first] & often[second]
    some, times = _repeated(first[both] * len(names) + second[both])
    pairs.add({b"%b %b" % (names[k // len(names)], names[k % len(names)]): n for k, n in zip(some, times)})


def _frequent(batches):
    words, pairs = _Frequent(), _Frequent()
    for batch in batches:
        for _, _, texts in _texts(batch):
            count_frequent(texts, words, pairs)
    for order, counted in ((1, words), (2, pairs)):
        most = counted.most(SENT)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([order] * len(most), pa.int32()),
                pa.array([w for w, _ in most], pa.binary()),
                pa.array([n for _, n in most], pa.int64()),
            ],
            names=["n_words", "run", "n"],
        )


def frequent_head(texts, words=HEAD_WORDS, pairs=HEAD_PAIRS, buckets=BUCKETS):
    """The head over all ``texts``: what tasks found frequent, summed. Only speed depends on it."""
    counted = texts.mapInArrow(_frequent, "n_words int, run binary, n bigint").groupBy("n_words", "run")
    counted = settled(counted.agg(F.sum("n").alias("n")), "resampling-head")

    def most(order, limit):
        rows = counted.where(F.col("n_words") == order).orderBy(F.desc("n"), "run").limit(limit).collect()
        return [bytes(r["run"]) for r in rows]

    return make_head(most(1, words), [p.split(b" ") for p in most(2, pairs)], buckets)


def _totals(head, buckets):
    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in _texts(batch):
                for found in buckets_of(head.value, texts, buckets)[0]:
                    sums += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(sums[met])], names=["bucket", "n"])

    return run


def bucket_totals(texts, head, buckets=BUCKETS):
    """How many features of all ``texts`` fall into each bucket, exactly. One row a bucket is sent."""
    counted = texts.mapInArrow(_totals(head, buckets), "bucket bigint, n bigint").groupBy("bucket")
    out = np.zeros(buckets, np.int64)
    for row in counted.agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source, target):
    """``floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B))))`` of each bucket, in doubles."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(source.astype(float).tolist(), target.astype(float).tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], np.int64)


def _weights(head, gains, buckets):
    def run(batches):
        for batch in batches:
            for a, b, texts in _texts(batch):
                weight, features = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                orders, of, words = buckets_of(head.value, texts, buckets)
                for found, text in zip(orders, of):
                    # Sums of gains in doubles are exact: a text's sum is far below 2 ** 53.
                    weight += np.bincount(text, weights=gains[found], minlength=b - a).astype(np.int64)
                    features += np.bincount(text, minlength=b - a)
                ids = batch.column("doc_id").slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(features), pa.array(weight), pa.array(words)],
                    names=["doc_id", "n_features", "weight", "n_words"],
                )

    return run


def ranked(rows, percent, least_words):
    """``rows`` with their place among those with enough words, by descending score, null beyond the draw.

    The rows are sorted by range once and stored; a row's place is its number inside of its
    partition plus the rows of the partitions before it, so no task sees all rows.
    """
    may = F.col("n_words") >= least_words
    placed = rows.repartitionByRange(may.desc(), F.desc("score"), F.col("doc_id").asc_nulls_last())
    placed = placed.sortWithinPartitions(may.desc(), F.desc("score"), F.col("doc_id").asc_nulls_last())
    placed = settled(placed.withColumn("_at", F.monotonically_increasing_id()), "resampling-ranked")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_if(may).alias("may")).collect()
    drawn = percent * sum(r["may"] for r in sizes) // 100
    before, rows_before = [], 0
    for r in sorted(sizes, key=lambda r: r["p"]):
        before.append((r["p"], rows_before))
        rows_before += r["n"]
    starts = rows.sparkSession.createDataFrame(before, "p bigint, rows_before bigint")  # one row a partition
    place = F.col("rows_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = placed.join(F.broadcast(starts), part == F.col("p"))
    return placed.withColumn("rank", F.when(may & (place <= drawn), place)).drop("p", "rows_before", "_at")


def resample(docs, target, percent=5, least_words=20, seed=42, buckets=BUCKETS, id_col="doc_id", text_col="text", **options):
    """``(doc_id, n_features, weight, score, n_words, rank)`` of every row of ``docs``.

    ``weight`` is the sum of the gains of a text's features, ``score`` adds a noise that depends on
    ``seed`` and id alone, and ``rank`` counts the ``percent`` per cent with the highest scores
    among the texts of ``least_words`` words or more; ties go to the smaller id. Null texts have no
    feature; a null id counts as the empty text in the noise and comes last among ties. Repeated rows
    are counted, scored and ranked as often as they occur. An empty table gives an empty result;
    without target texts all target counts are zero. Other columns are ignored. ``options`` go to
    ``frequent_head``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    head = context.broadcast(frequent_head(rows.select("text"), buckets=buckets, **options))
    source = bucket_totals(rows.select("text"), head, buckets)
    gains = bucket_gains(source, bucket_totals(target.select(F.col(text_col).alias("text")), head, buckets))
    kinds = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_features bigint, weight bigint, n_words bigint"
    rows = rows.mapInArrow(_weights(head, gains, buckets), kinds)
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = settled(rows.withColumn("score", F.col("weight") + noise), "resampling-scores")
    return ranked(rows, percent, least_words).select("doc_id", "n_features", "weight", "score", "n_words", "rank")
