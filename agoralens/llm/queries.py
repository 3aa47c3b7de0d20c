"""The registered queries of the training-data operators, and their SQL where there is one."""

import public_tokenizers
from pyspark.sql import functions as F

from agoralens.llm.collision_ann import nearest
from agoralens.llm.common import held_out, remainder, table
from agoralens.llm.exact_dedup import exact_groups
from agoralens.llm.hard_negatives import hard_negatives
from agoralens.llm.hmm_lm import language_model_scores
from agoralens.llm.html_text import with_main_text
from agoralens.llm.langid import language
from agoralens.llm.packing import pack
from agoralens.llm.quality_trees import quality
from agoralens.llm.sentencepiece_codec import normalised_text, round_trip
from agoralens.llm.sharding import DIGITS, SLOTS, lookup_table, place
from agoralens.llm.simhash import hex_digits, near_groups
from agoralens.llm.target_resampling import resample
from agoralens.llm.toxicity import toxicity

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


SHARDS = [f"shard-{i:04d}" for i in range(96)]


def _sharding_sql():
    """The slot by SQL; the table is filled by ``lookup_table``, whose rule has its own tests."""
    owners = ",".join(map(str, lookup_table(SHARDS)))
    return f"""WITH filled AS (SELECT string_split('{owners}', ',') AS owner),
slots AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {DIGITS}))::BIGINT % {SLOTS})::INTEGER AS slot
  FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(owner[slot + 1], 4, '0') AS shard FROM slots, filled"""


@query("op8_sharding", _sharding_sql())
def op8_sharding(spark, sf_dir):
    """Every document with its slot and shard."""
    return place(table(spark, sf_dir, "documents"), "doc_id", SHARDS).select("doc_id", "slot", "shard")


@query(
    "op10_exact_dedup",
    r"""WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM norm""",
)
def op10_exact_dedup(spark, sf_dir):
    """Every document with the row that stays for its text."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("_row")


@query("op4_simhash")
def op4_simhash(spark, sf_dir):
    """Every document with its fingerprint and the smallest id of its near-duplicates."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


@query("op6_langid")
def op6_langid(spark, sf_dir):
    """Every document with its predicted language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language(docs).select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    """Every document with its toxicity score."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return toxicity(docs, labels).select("doc_id", held_out("doc_id", 4).alias("held_out"), "score", "predicted")


@query("op3_sentencepiece")
def op3_sentencepiece(spark, sf_dir):
    """Every document encoded and decoded, compared with its text and with the other library."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == normalised_text(F.col("text"))).alias("round_trip"),
        "parity",
    )


@query("op5_packing")
def op5_packing(spark, sf_dir):
    """Every piece of every document with its place in a sequence."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_hmm_lm")
def op9_hmm_lm(spark, sf_dir):
    """Every document with its base score and its score by the hidden Markov model."""
    return language_model_scores(table(spark, sf_dir, "documents"))


@query("op2_collision_ann")
def op2_collision_ann(spark, sf_dir):
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query("op1_html_tree")
def op1_html_tree(spark, sf_dir):
    """Every page with its main text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", "n_chars")


@query(
    "op13_hard_negatives",
    """WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5""",
)
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every vector whose id is divisible by 100, labels of every seventh id moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


@query("op11_target_resampling")
def op11_target_resampling(spark, sf_dir):
    """Every document with its weight towards the benchmark texts, and its place in the draw."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_quality_trees")
def op12_quality_trees(spark, sf_dir):
    """Every document with its quality score."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held = (remainder("doc_id", 5) == 0).alias("held_out")
    return quality(docs, labels).select("doc_id", held, "score", "predicted")
