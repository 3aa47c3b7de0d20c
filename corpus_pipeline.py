"""Clean, deduplicate and pack the documents.

Each stage works on all rows its predecessor kept. What it returns is written as Parquet to the
shared folder and read again as the next stage's documents, so a lost executor costs one stage at
most. All stages but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import functions as F

from agoralens.llm import langid, toxicity
from agoralens.llm.common import table
from agoralens.llm.exact_dedup import exact_kept
from agoralens.llm.packing import pack
from agoralens.llm.simhash import near_kept
from agoralens.session import settled

def new_names(docs, *names):
    """The names with as many underscores before them as it takes to be none of ``docs``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def drop_toxic(spark, docs, sf_dir):
    """Rows that the toxicity model does not predict as toxic. Null and empty texts stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score, label = new_names(docs, "score", "toxic")
    scored = toxicity.with_toxicity(docs, model, score_name=score, label_name=label)
    return scored.where(F.col(label) == 0).drop(score, label)


def drop_unknown_language(spark, docs, sf_dir):
    """Rows whose language the model can tell: as certainly as it tells texts of the languages it knows.

    Texts without a letter go.
    """
    names = new_names(docs, "lang", "score", "certain")
    told = langid.with_language(docs, langid.train(docs), "text", *names)
    return told.where(F.col(names[2])).drop(*names)


def drop_exact_copies(spark, docs, sf_dir):
    """Of equal texts the row with the smallest id, one row of repeated ones."""
    return exact_kept(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each near-duplicate group, the one with the smallest id.

    Near is what the SimHash operator links: fingerprints of three-word shingles that differ in two
    bits or fewer.
    """
    return near_kept(docs, words=3, radius=2)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: No SQL can train the models or tokenise; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of the documents that pass all stages."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settled(docs, f"pipeline-{name}")
    return docs
