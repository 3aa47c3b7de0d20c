"""SentencePiece models on the tokenizers library.

The model file is read field by field. From it come the normaliser (character map, extra white
space, dummy prefix, the mark for spaces), the pieces with their scores as a unigram or a merge
model, and the fallback to bytes. Texts are cut before each run of spaces where no piece of the
vocabulary reaches over such a border; the ids of a text are then those of its words, and each
distinct word of a batch is encoded once, in batches on several threads. Words in use are kept for
the next batches. A step unpacks one slice of Spark's batch at a time.
"""

import os
import re
import struct
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from agoralens.llm.common import give_back, slices, wider

MARK = "▁"
UNIGRAM, MERGES = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
BATCH_OCTETS = 500_000
CACHED_WORDS = 200_000  # of a generation
KEPT_CHARS = 50
WORDS = 1000
FAR_BELOW = -1e6


def read_fields(data):
    """The (number, value) pairs of a protobuf message; groups do not occur in these files."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            octet = data[at]
            at += 1
            value |= (octet & 127) << shift
            shift += 7
            if octet < 128:
                return value

    while at < len(data):
        tag = number()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(wire)
        size = number() if wire == 2 else size
        if size is None:
            raise ValueError(f"wire type {wire} is not part of a model file")
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says."""

    pieces: list = field(default_factory=list)
    scores: list = field(default_factory=list)
    kinds: list = field(default_factory=list)
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data):
        model = cls()
        for number, value in read_fields(data):
            if number == 1:
                piece = dict(read_fields(value))
                model.pieces.append(piece.get(1, b"").decode("utf-8"))
                model.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                model.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(read_fields(value))
                model.algorithm = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                spec = dict(read_fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix = bool(spec.get(3, 1))
                model.remove_extra = bool(spec.get(4, 1))
                model.escape = bool(spec.get(5, 1))
        if model.algorithm not in (UNIGRAM, MERGES):
            raise ValueError("only unigram and merge models are supported")
        if USER in model.kinds or not model.escape:
            raise ValueError("models with user-defined pieces or unescaped spaces are not supported")
        return model


def _merges(model):
    """Every way to make a piece of two pieces, best piece first."""
    score = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k == NORMAL}
    place = {p: i for i, p in enumerate(model.pieces)}
    made = []
    for piece, value in score.items():
        for cut in range(1, len(piece)):
            a, b = piece[:cut], piece[cut:]
            if a in score and b in score:
                made.append((-value, place[piece], place[a], place[b], a, b))
    return [m[4:] for m in sorted(made)]


class Codec:
    """Encode and decode texts as the model file says."""

    def __init__(self, path, threads=2):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        from tokenizers import Tokenizer, decoders, models, normalizers

        with open(path, "rb") as file:
            self.model = model = Model.parse(file.read())
        unknown = model.kinds.index(UNKNOWN)
        if model.algorithm == MERGES:
            core = models.BPE(
                {p: i for i, p in enumerate(model.pieces)},
                _merges(model),
                unk_token=model.pieces[unknown],
                fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        else:
            scores = [s if k == NORMAL else FAR_BELOW for s, k in zip(model.scores, model.kinds)]
            core = models.Unigram(list(zip(model.pieces, scores)), unknown, model.byte_fallback)
        self.tokenizer = Tokenizer(core)
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if model.dummy_prefix:
            steps.append(decoders.Strip(" ", 1, 0))
        self.tokenizer.decoder = decoders.Sequence(steps)
        self.charsmap = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        normal = [p for p, k in zip(model.pieces, model.kinds) if k == NORMAL]
        self.by_words = not any(MARK in p.lstrip(MARK) for p in normal)
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        # Normalised texts hold no space, so its byte can stand between the words of a batch.
        self.between = self.tokenizer.token_to_id("<0x20>") if model.byte_fallback else None
        self.cache, self.older = {}, {}
        octets = [
            bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode("utf-8")
            for p, k in zip(model.pieces, model.kinds)
        ]
        self.piece_sizes = np.array([len(o) for o in octets], np.int64)
        self.piece_at = np.append(0, np.cumsum(self.piece_sizes)[:-1])
        self.piece_octets = np.frombuffer(b"".join(octets), np.uint8)

    def normalise(self, text):
        """The text as the pieces see it: spaces are marks."""
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.model.remove_extra:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)

    def _encode_words(self, words):
        """The ids of each word, in batches of many words that the library deals over its threads."""
        if self.between is None:
            coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            return [array("I", e.ids).tobytes() for e in coded]
        runs = []
        for i in range(0, len(words), WORDS):
            run = [" "] * (2 * len(words[i : i + WORDS]) - 1)
            run[::2] = words[i : i + WORDS]
            runs.append(run)
        out = []
        for e in self.tokenizer.encode_batch_fast(runs, is_pretokenized=True, add_special_tokens=False):
            ids = np.array(e.ids, np.uint32)
            ends = 4 * np.flatnonzero(ids == self.between)
            octets = ids.tobytes()
            out += [octets[a:b] for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(octets)])]
        return out

    def _words(self, text):
        """The words of a text without the mark before them, or None for a model whose texts are not cut so."""
        if not (self.by_words and self.model.dummy_prefix):
            return None
        plain = self.charsmap is None and text and "  " not in text and text[0] != " " and text[-1] != " "
        if plain and MARK not in text:
            return text.split(" ")
        return [p[1:] for p in self.cut.findall(self.normalise(text))]

    def encode(self, texts):
        """The ids of each text as little-endian numbers of 32 bits."""
        if len(self.cache) > CACHED_WORDS:
            self.cache, self.older = {}, self.cache
        words = [self._words(t) for t in texts]
        coded = [list(map(self.cache.get, w or ())) for w in words]
        gaps = [[j for j, c in enumerate(found) if c is None] for found in coded]
        missing = {w[j] for w, at in zip(words, gaps) for j in at}
        found_now = {w: c for w in missing if (c := self.older.get(w)) is not None}
        new = [w for w in missing if w not in found_now]
        found_now.update(zip(new, self._encode_words([MARK + w for w in new])))
        self.cache.update((w, c) for w, c in found_now.items() if len(w) <= KEPT_CHARS)
        for w, found, at in zip(words, coded, gaps):
            for j in at:
                found[j] = found_now[w[j]]
        odd = [self.normalise(t) for t, w in zip(texts, words) if w is None]
        odd = [self.cut.findall(t) if self.by_words else [t] * bool(t) for t in odd]
        parts = list(set().union(*odd))
        of_part, rest = dict(zip(parts, self._encode_words(parts))), iter(odd)
        return [
            b"".join(map(of_part.__getitem__, next(rest)) if w is None else found) for w, found in zip(words, coded)
        ]

    def decode(self, coded):
        """The texts of ids as ``encode`` gives them.

        The bytes of all pieces of a batch are gathered at once. Ids whose bytes are no valid text
        are decoded by the library, which says what stands for the bytes that are wrong.
        """
        ids = np.frombuffer(b"".join(coded), "<u4")
        sizes = self.piece_sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        octets = self.piece_octets[np.arange(ends[-1]) + np.repeat(self.piece_at[ids] - ends[:-1], sizes)].tobytes()
        cuts = ends[np.append(0, np.cumsum([len(c) // 4 for c in coded], dtype=np.int64))].tolist()
        out = []
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            try:
                text = octets[a:b].decode("utf-8")
            except UnicodeDecodeError:
                text = self.decode_by_library(coded[i : i + 1])[0]
            else:
                text = text[1:] if self.model.dummy_prefix and text[:1] == " " else text
            out.append(text)
        return out

    def decode_by_library(self, coded):
        ids = [np.frombuffer(c, "<u4").tolist() for c in coded]
        return self.tokenizer.decode_batch(ids, skip_special_tokens=True)


@lru_cache(maxsize=2)
def codec(path, threads=2):
    return Codec(path, threads)


def _sliced(at, names, work):
    """Batches with the columns that ``work`` makes of column ``at``; one slice of a batch is unpacked at a time."""

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at).cast("binary")), 0).to_pylist()
            for a, b in slices(sizes, BATCH_OCTETS):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *work(part.column(at).to_pylist())], names=names)
                give_back()

    return run


def _mapped(df, text_col, names_and_kinds, work):
    kept = [c for c in df.columns if c not in names_and_kinds]
    rows = df.select(*[df[c] for c in kept])
    run = _sliced(kept.index(text_col), [*kept, *names_and_kinds], work)
    return rows.mapInArrow(run, wider(rows.schema, **names_and_kinds))


def with_ids(df, path, text_col="text", ids_name="ids", threads=2):
    """``df`` with the ids of each text as binary (little-endian, 32 bits). Null is the empty text."""

    def work(texts):
        return [pa.array(codec(path, threads).encode([t or "" for t in texts]), pa.binary())]

    return _mapped(df, text_col, {ids_name: "binary"}, work)


def with_text(df, path, ids_col="ids", text_name="decoded", threads=2):
    """``df`` with the text of binary ids. Null ids give the empty text."""

    def work(coded):
        return [pa.array(codec(path, threads).decode([c or b"" for c in coded]), pa.string())]

    return _mapped(df, ids_col, {text_name: "string"}, work)


@lru_cache(maxsize=2)
def _reference_codec(path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def with_parity(df, path, text_col="text", name="parity", threads=2):
    """``df`` with whether both libraries give one text the same ids, for every whole text."""

    def work(texts):
        texts = [t or "" for t in texts]
        ours = codec(path, threads).encode(texts)
        theirs = _reference_codec(path).encode(texts, num_threads=threads)
        return [pa.array([a == array("I", b).tobytes() for a, b in zip(ours, theirs)], pa.bool_())]

    return _mapped(df, text_col, {name: "boolean"}, work)


def round_trip(df, path, text_col="text", threads=2):
    """``df`` with ``ids``, ``decoded`` and ``parity`` of each text, in one pass over Python."""

    def work(texts):
        texts = [t or "" for t in texts]
        one = codec(path, threads)
        ours = one.encode(texts)
        theirs = _reference_codec(path).encode(texts, num_threads=threads)
        return [
            pa.array(ours, pa.binary()),
            pa.array(one.decode(ours), pa.string()),
            pa.array([a == array("I", b).tobytes() for a, b in zip(ours, theirs)], pa.bool_()),
        ]

    return _mapped(df, text_col, {"ids": "binary", "decoded": "string", "parity": "boolean"}, work)


def normalised_text(column):
    """What decoding gives back for a model with the identity map that keeps extra white space."""
    return F.replace(F.coalesce(column, F.lit("")), F.lit(MARK), F.lit(" "))
