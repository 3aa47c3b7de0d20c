"""What the Python steps of the pipeline and of the codec hold at once does not grow with the batches that Spark sends."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import types as T

from agoralens.llm import langid, packing, sentencepiece_codec, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_packing_unpacks_a_slice_of_a_batch_at_a_time(monkeypatch):
    monkeypatch.setattr(packing, "BATCH_CHARS", 100_000)
    texts = [None, "", "é " * 50 + "z"] + ["harbour light " * 285 + str(i) for i in range(3000)]  # 12 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["_id", "_text"])
    plain = packing._tokenizer(BPE).tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    counts = [len(e.ids) + 1 for e in plain]
    del plain
    found = np.zeros(len(texts), np.int64)
    tracemalloc.start()
    for out in packing._cut(BPE, 1024, 2)(iter([batch])):
        np.add.at(found, out.column("_id").to_numpy(), out.column("length").to_numpy())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == counts
    assert peak < 6e6


def test_signs_of_a_tokenizer_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 30)
    monkeypatch.setattr(packing, "CACHED_SIGNS", 3, raising=False)
    tokenizer = packing.WordTokenizer(BPE)
    texts = [f"to {i}--{i + 100}, {i}" for i in range(6)]
    plain = tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [tokenizer.encode([t])[0] for t in texts] == [np.array(e.ids, "<u4").tobytes() for e in plain]
    assert len(tokenizer.signs) <= 3


def test_steps_return_a_large_batch_in_portions():
    n = 2500
    texts = pa.array([f"a text of number {i}" for i in range(n)])
    ids, y = pa.array([str(i) for i in range(n)]), pa.array([i % 2 for i in range(n)], pa.int32())
    batch = pa.RecordBatch.from_arrays([ids, y, texts, y, pa.array(["en"] * n)], names=["_id", "y", "text", "part", "lang"])
    kept = np.ones(1 << toxicity.BUCKET_BITS, bool)
    for run in (toxicity._kept_features(kept), langid._sparse(["en"])):
        out = list(run(iter([batch.slice(0, 0), batch])))
        assert max(b.num_rows for b in out) <= 1000
        assert pa.Table.from_batches(out).column("y").to_pylist() == (y.to_pylist() if "_id" in out[0].schema.names else [0] * n)


def test_rows_of_a_shard_are_sorted_as_by_their_bytes():
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(2)), rng.integers(0, 3, k), rng.integers(0, 3, k) / 2) for k in rng.integers(1, 4, 400)]
    whole = sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    plain = lambda found: [(y, f.tolist(), x.tolist()) for y, f, x in found]
    assert plain(langid._in_order(iter(rows))) == plain(whole)


class Rows:
    """Stands for a data frame whose step is wanted, not run."""

    columns = ["doc_id", "text"]
    schema = T.StructType().add("doc_id", "long").add("text", "string")

    def __getitem__(self, name):
        return name

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_round_trip_unpacks_a_slice_of_a_batch_at_a_time(spark):
    texts = [None, "", " é  " * 50 + "z"] + ["harbour light " * 285 + str(i) for i in range(3000)]  # 12 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    run = sentencepiece_codec.round_trip(Rows(), PIECES)
    list(run(iter([batch.slice(0, 9)])))  # loads the models
    seen = []
    tracemalloc.start()
    for out in run(iter([batch])):
        same = out.column("decoded").equals(out.column("text").fill_null(""))
        seen += [(i, same and ok) for i, ok in zip(out.column("doc_id").to_pylist(), out.column("parity").to_pylist())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == [(i, True) for i in range(len(texts))]
    assert peak < 30e6


def test_codec_keeps_words_in_use_and_no_long_ones(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "CACHED_WORDS", 30)
    codec, encoded = sentencepiece_codec.Codec(PIECES), []
    encode = codec._encode_words
    monkeypatch.setattr(codec, "_encode_words", lambda words: encoded.extend(words) or encode(words))
    texts = [f"to harbour word{i}  other " + "日本語" * 100 for i in range(100)]  # more words than are kept
    plain = sentencepiece_codec._reference_codec(PIECES).encode(texts)
    assert [np.frombuffer(codec.encode([t])[0], "<u4").tolist() for t in texts] == plain
    assert encoded.count("▁harbour") == 1
    kept = [*codec.cache, *codec.older]
    assert len(kept) <= 70 and max(map(len, kept)) <= 50
