"""Best-fit packing of tokenised documents, certified by lower bounds.

Documents are tokenised and only those above the capacity are cut. Full pieces are sequences of
their own. The others are dealt over partitions of bounded size; each runs best-fit decreasing and
compares its number of bins with a lower bound from dual-feasible functions. A partition that
meets its bound is certified and gives back one bin, the least filled one, since its bound was
rounded up; a partition with a gap gives back all bins that are not full. The documents given back
are dealt anew, and this goes on while it lowers the number of sequences.
"""

import math
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F

from agoralens.llm.common import give_back, slices, wider
from agoralens.session import settled

CAPACITY = 1024
END_ID = 2
PART_ROWS = 20000
ROUNDS = 8
BATCH_CHARS = 2_000_000
CACHED_WORDS = 300_000  # of a generation
CACHED_SIGNS = 50_000

#: White space in UTF-8 other than space and newline; with it, runs with a space in them.
_OTHER_SPACE = [c.encode() for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_UNSAFE = [b"  ", b" \n", b"\n ", *_OTHER_SPACE]
#: How byte-level BPE cuts a text (fixed value).
PARTS = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
STOPS = ".,;:!?"


def _byte_names():
    """The character by which a vocabulary names each byte: itself if it can be seen, else the next
    one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTES = _byte_names()
SPACE_NAME = BYTES[ord(" ")]


class WordTokenizer:
    """Ids of whole texts through a byte-level BPE tokenizer, each distinct word encoded once.

    Byte-level BPE cuts a text before every single space between two words, so the ids of a text
    are those of its words, each with the space before it. A new word is cut into letters, digits
    and signs, and the model of the tokenizer merges the bytes of each part. Words are kept in two
    generations, so that those still in use outlive the others. Texts with other white space next
    to a space, or with a special token, are encoded as a whole.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.tokenizer.normalizer is not None:
            raise ValueError("a byte-level tokenizer without a normaliser is needed")
        self.merge = self.tokenizer.model.tokenize
        self.stops = {s: self._part(s) for s in STOPS}
        self.recent, self.older, self.signs = {}, {}, {}

    def _encode(self, texts):
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _part(self, part):
        if part.isascii() and part[0] == " " and part[1:].isalpha():
            named = SPACE_NAME + part[1:]
        else:
            named = part.encode().decode("latin-1").translate(BYTES)
        return array("I", [t.id for t in self.merge(named)]).tobytes()

    def _word(self, word):
        """The ids of a word after a space, from the words of this and the last generation."""
        found = self.recent.get(word) or self.older.get(word)
        if found is None:
            bare = word[:-1]
            if word.isalpha():
                found = self._part(f" {word}")
            elif bare.isalpha() and word[-1] in self.stops:
                found = self._word(bare) + self.stops[word[-1]]
            else:
                found = b"".join(map(self._sign, PARTS.findall(f" {word}")))
        self.recent[word] = found
        return found

    def _sign(self, part):
        if part[0] == " " and part[1:].isalpha():
            return self._word(part[1:])
        found = self.signs.get(part)
        if found is None:
            found = self.signs[part] = self._part(part)
        return found

    def _joined(self, texts):
        """The ids of texts of words with one space between them."""
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        start = words.offsets.to_numpy()
        distinct = words.flatten().dictionary_encode()
        known = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = distinct.indices.to_numpy().astype(np.int64)
        # The first word of a text has no space before it.
        first = [known[c] for c in codes[start[:-1]]]
        codes[start[:-1]] = len(known) + np.arange(len(texts))
        ids = list(map(self.recent.get, known))
        for i in np.flatnonzero(np.bincount(codes)[: len(known)]).tolist():
            if ids[i] is None:
                ids[i] = self._word(known[i])
        ids += self._encode(first)
        coded = pa.array(ids, pa.large_binary()).take(pa.array(codes))
        edges = np.frombuffer(coded.buffers()[1], np.int64, len(codes) + 1)[start]
        octets = coded.buffers()[2].to_pybytes() if edges[-1] else b""
        return [octets[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())]

    def encode(self, texts):
        """The ids of each text as little-endian numbers of 32 bits."""
        plain, whole = [], []
        for i, text in enumerate(texts):
            octets = text.encode("utf-8", "replace")
            edge = octets[:1].isspace() or octets[-1:].isspace()
            unsafe = not text or edge or any(s in octets for s in _UNSAFE) or any(t in text for t in self.special)
            (whole if unsafe else plain).append(i)
        out = [b""] * len(texts)
        for rows, run in ((whole, self._encode), (plain, self._joined)):
            if rows:
                for i, ids in zip(rows, run([texts[i] for i in rows])):
                    out[i] = ids
        if len(self.recent) > CACHED_WORDS:
            self.recent, self.older = {}, self.recent
        if len(self.signs) > CACHED_SIGNS:
            self.signs = {}
        return out


@lru_cache(maxsize=2)
def _tokenizer(path):
    return WordTokenizer(path)


def _cut(path, capacity, end_id):
    """Rows of ``pieces`` from batches of ``_id`` and ``_text``; one slice of a batch is unpacked at a time."""
    end = array("I", [end_id]).tobytes()

    def run(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            texts = batch.column("_text")
            for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BATCH_CHARS):
                at, number, starts, lengths, ids = [], [], [], [], []
                for i, coded in enumerate(tokenizer.encode([t or "" for t in texts[a:b].to_pylist()])):
                    coded += end
                    n = len(coded) // 4
                    cut = (n - 1) % capacity + 1
                    edges = [0, *range(cut, n + 1, capacity)]
                    for k, (s, e) in enumerate(zip(edges, edges[1:])):
                        at.append(a + i)
                        number.append(k)
                        starts.append(s)
                        lengths.append(e - s)
                        ids.append(coded[4 * s : 4 * e])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(pa.array(at, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["_id", "piece", "start", "length", "ids"],
                )
                give_back()

    return run


def pieces(docs, path, id_col="doc_id", text_col="text", capacity=CAPACITY, end_id=END_ID):
    """``(_id, piece, start, length, ids)`` of all documents; ``ids`` are little-endian, 32 bits.

    A document is the ids of its text, then ``end_id``. Only a longer one than ``capacity`` is cut;
    all pieces but the first then have the full length. Null and empty texts are one piece, the
    end. Other columns are ignored, repeated rows are packed as often as they occur.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kinds = {"piece": "int", "start": "bigint", "length": "bigint", "ids": "binary"}
    return rows.mapInArrow(_cut(path, capacity, end_id), wider(rows.drop("_text").schema, **kinds))


def best_fit(lengths, capacity=CAPACITY):
    """Best-fit decreasing: a bin number and an offset for each length, in the given order.

    The free space of the open bins is one bit set, so the tightest bin that fits is its lowest
    bit from the length on.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space = [[] for _ in range(capacity + 1)]
    spaces = count = 0
    for i in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        n = int(lengths[i])
        fitting = spaces >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            at = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - space
        by_space[space - n].append(at)
        spaces |= 1 << (space - n)
    return bins, offsets


def lower_bound(lengths, capacity=CAPACITY):
    """A number of bins that no packing can go below, by two families of dual-feasible functions."""
    counts = np.bincount(np.asarray(lengths, np.int64), minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = math.ceil((counts * size).sum() / capacity)
    for small in range(1, capacity // 2 + 1):
        # Sizes above capacity - small fill a bin, sizes below small count nothing.
        filled = (counts[capacity - small + 1 :].sum()) * capacity
        middle = slice(small, capacity - small + 1)
        best = max(best, math.ceil((filled + (counts[middle] * size[middle]).sum()) / capacity))
    for k in range(1, 20):
        # In units of capacity / k: sizes at a multiple of capacity / (k + 1) keep their size.
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, math.ceil((counts * value).sum() / (capacity * k)))
    return int(best)


def _pack_part(capacity):
    def run(group):
        lengths, rows = group.column("length").to_numpy(), group.column("_row").to_numpy()
        order = np.lexsort((rows, lengths))
        lengths, rows = lengths[order], rows[order]
        bins, offsets = best_fit(lengths, capacity)
        count, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        given = fill < capacity
        if count == bound and given.any():
            given = np.arange(count) == fill.argmin()
        name = np.zeros(count, np.int64)
        name[bins[::-1]] = rows[::-1]
        return pa.table(
            {
                "_row": rows,
                "length": lengths,
                "sequence_id": name[bins],
                "offset": offsets,
                "gap": np.full(len(rows), count - bound),
                "given": given[bins],
            }
        )

    return run


def _dealt(rows, number, part_rows, capacity, n):
    """One round over ``n`` rows: best-fit decreasing in each of as many parts as they need."""
    parts = max(1, math.ceil(n / part_rows))
    part = F.pmod(F.xxhash64("_row", F.lit(number)), F.lit(parts))
    grouped = rows.select("_row", "length", part.alias("part")).groupBy("part")
    kinds = "_row bigint, length bigint, sequence_id bigint, offset bigint, gap bigint, given boolean"
    return settled(grouped.applyInArrow(_pack_part(capacity), kinds), "packing-round")


def _sequences(rows):
    return rows.agg(F.countDistinct("sequence_id")).first()[0]


def assign(rows, capacity=CAPACITY, part_rows=PART_ROWS, rounds=ROUNDS):
    """``(_row, sequence_id, offset)`` for rows with distinct ``_row`` and a ``length`` up to capacity.

    ``part_rows`` bounds what one task packs at once. ``gap`` says how far the part in which a
    sequence was made stayed from its lower bound; 0 is certified.
    """
    full = rows.where(F.col("length") == capacity)
    done = full.select("_row", F.col("_row").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), F.lit(0).cast("bigint").alias("gap"))
    open_rows = rows.where(F.col("length") < capacity)
    n = open_rows.count()
    packed, columns = _dealt(open_rows, 0, part_rows, capacity, n), done.columns
    for number in range(1, rounds + 1):
        given = packed.where("given")
        n, before = given.agg(F.count(F.lit(1)), F.countDistinct("sequence_id")).first()
        if before < 2:
            break
        again = _dealt(given, number, part_rows, capacity, n)
        if _sequences(again) >= before:
            if n <= part_rows:
                break
            continue  # another deal may do better
        done = done.union(packed.where("not given").select(columns))
        packed = again
    return done.union(packed.select(columns))


def pack(docs, path, id_col="doc_id", text_col="text", capacity=CAPACITY, end_id=END_ID, part_rows=PART_ROWS):
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Sequence ids are arbitrary numbers; the pieces of a sequence lie without gaps from offset 0.
    The ids themselves are those of ``pieces``; only their checksum is stored.
    """
    cut = pieces(docs, path, id_col, text_col, capacity, end_id)
    cut = cut.select("_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    cut = settled(cut.withColumn("_row", F.monotonically_increasing_id()), "packing-pieces")
    placed = assign(cut.select("_row", "length"), capacity, part_rows)
    return cut.join(placed.drop("gap"), "_row").drop("_row").withColumnRenamed("_id", id_col)


def sequences(docs, packed, path, id_col="doc_id", text_col="text", capacity=CAPACITY, end_id=END_ID):
    """``(sequence_id, ids)``: the token ids of each packed sequence, as an array.

    Needs distinct ids of documents, by which the pieces find their tokens again.
    """
    cut = pieces(docs, path, id_col, text_col, capacity, end_id).withColumnRenamed("_id", id_col)
    parts = packed.join(cut.select(id_col, "piece", "ids"), [id_col, "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("x"))))
    joined = parts.groupBy("sequence_id").agg(F.array_join(F.transform(ordered, lambda p: p["x"]), "").alias("x"))
    word = F.transform(
        F.sequence(F.lit(0), (F.length("x") / 8 - 1).cast("int")),
        lambda i: F.conv(
            F.concat(*[F.substring(F.col("x"), i * 8 + p, F.lit(2)) for p in (7, 5, 3, 1)]), 16, 10
        ).cast("int"),
    )
    return joined.select("sequence_id", word.alias("ids"))
