import importlib
import re
from collections import defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from agoralens.llm import simhash
from agoralens.session import settled

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF), "test")
        out.append(docs)
    return [df.collect() for df in out], [df.columns for df in out]


def test_stages_keep_the_columns_and_only_drop_rows(stages):
    rows, columns = stages
    assert all(c == COLUMNS for c in columns[:5])
    for before, after in zip(rows, rows[1:5]):
        assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    assert {r["doc_id"] for r in rows[5]} == {r["doc_id"] for r in rows[4]}


def test_toxic_rows_go_and_clean_rows_stay(spark, stages):
    rows, _ = stages
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows[1]}
    told = [d for d in toxic if any(r["doc_id"] == d for r in rows[0])]
    right = sum((d in kept) == (toxic[d] == 0) for d in told)
    assert right >= 0.9 * len(told)


def test_texts_without_letters_have_no_language(stages):
    rows, _ = stages
    kept = {r["doc_id"] for r in rows[2]}
    for r in rows[1]:
        assert (r["doc_id"] in kept) == bool(re.search(r"[^\W\d_]", r["text"] or ""))


def test_exact_and_near_copies(stages):
    rows, _ = stages
    groups = defaultdict(list)
    for r in rows[2]:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", r["text"] or "")].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(min(g) for g in groups.values())
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) % 2**64 for r in rows[3]}
    root = {d: d for d in prints}
    for _ in range(len(root)):
        new = {d: min(root[e] for e in root if bin(prints[d] ^ prints[e]).count("1") <= 2) for d in root}
        if new == root:
            break
        root = new
    assert sorted(r["doc_id"] for r in rows[4]) == sorted(d for d in root if root[d] == d)


def test_run_gives_the_last_stage(spark, stages):
    rows, columns = stages
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == columns[5]
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in out.collect()) == sorted(tuple(r[k] for k in key) for r in rows[5])


def test_entry_registers_every_operator():
    names = [re.match(r"op(\d+)_", n) for n in __spark_entry__.queries()]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", ["op8_sharding", "op10_exact_dedup", "op13_hard_negatives"])
def test_queries_against_their_sql(spark, name):
    import oracle

    con = oracle.connect(SF)
    assert oracle.compare(__spark_entry__.queries()[name](spark, SF), con, __spark_entry__.oracle_sql()[name]) == []


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(importlib.import_module("agoralens").__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()
