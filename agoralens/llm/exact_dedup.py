"""Exact duplicates through an extendible-hash index on shared files.

The index file holds one entry per document: hash, row number, normalised text. A directory of
hash prefixes is doubled until no bucket is overfull; a bucket that one hash value fills goes to
overflow pages, chosen by row number. Every page has one owner task. It chains the entries of
equal hash and compares their bytes, so two texts with one hash stay apart. What the overflow
pages of a bucket found is then joined once more, one entry per page and text.

Only built-in functions run on the executors. The driver sees the sizes of the directory's
prefixes, some thousands of rows, at most ``2 ** MOST_BITS``, and no hash, text or id.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from agoralens.llm.common import WHITE
from agoralens.session import settled

PAGES = 2048
LEAST_BYTES, MOST_BYTES = 1 << 16, 1 << 28
MOST_BITS = 20


def normalised(column):
    """Null as the empty text, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), WHITE, " ")


def double_directory(sizes, bits, capacity):
    """The directory: a bucket number and a page count for each of ``2 ** depth`` prefixes.

    ``sizes`` maps prefixes of ``bits`` bits to bytes. The directory starts with one bucket and
    doubles while some bucket holds more than ``capacity`` bytes and can still be split. Sums by
    shorter prefixes are halvings of the list, so a doubling reads one more level of them.
    """
    levels = [[sizes.get(p, 0) for p in range(1 << bits)]]
    while len(levels[0]) > 1:
        levels.insert(0, [a + b for a, b in zip(levels[0][::2], levels[0][1::2])])
    depth, final = 0, []
    open_buckets = [(0, 0)]
    while open_buckets:
        split = []
        for level, prefix in open_buckets:
            if levels[level][prefix] > capacity and level < bits:
                split += [(level + 1, 2 * prefix), (level + 1, 2 * prefix + 1)]
            else:
                final.append((level, prefix, max(1, math.ceil(levels[level][prefix] / capacity))))
        open_buckets = split
        depth += bool(split)
    bucket, pages = [0] * (1 << depth), [1] * (1 << depth)
    for number, (level, prefix, count) in enumerate(sorted(final, key=lambda b: b[1] << (bits - b[0]))):
        for slot in range(prefix << (depth - level), (prefix + 1) << (depth - level)):
            bucket[slot], pages[slot] = number, count
    return depth, bucket, pages


def _looked_up(values, slot):
    """Constant-time look-up in a list that is a literal of the plan."""
    joined = F.lit(",".join(map(str, values)))
    return F.element_at(F.split(joined, ",").cast("array<int>"), (slot + 1).cast("int"))


def _prefix(bits):
    return F.shiftrightunsigned(F.col("_h"), 64 - bits) if bits else F.lit(0).cast("bigint")


def _hash(text, bits=64):
    h = F.xxhash64(text)
    return h if bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - bits), 64 - bits)


def _paged(entries, sizes):
    """``entries`` on their pages, one owner task for each: ``_bucket``, ``_page``, ``_pages``.

    ``sizes`` has ``_h`` and ``_bytes`` of the same entries.
    """
    total = sizes.agg(F.sum("_bytes")).first()[0] or 0
    capacity = min(MOST_BYTES, max(LEAST_BYTES, total // PAGES))
    bits = min(MOST_BITS, max(1, math.ceil(total / capacity)).bit_length() + 1)
    prefixes = sizes.groupBy(_prefix(bits).alias("p")).agg(F.sum("_bytes").alias("n"))
    depth, bucket, pages = double_directory({r["p"]: r["n"] for r in prefixes.collect()}, bits, capacity)
    slot = _prefix(depth)
    paged = entries.withColumns({"_bucket": _looked_up(bucket, slot), "_pages": _looked_up(pages, slot)})
    page = F.when(F.col("_pages") > 1, F.pmod(F.xxhash64("_row"), F.col("_pages"))).otherwise(0)
    return paged.withColumn("_page", page.cast("int")).repartition("_bucket", "_page")


CHAIN = ("_bucket", "_page", "_h", "_norm")


def exact_groups(docs, id_col="doc_id", text_col="text", hash_bits=64):
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``_row``.

    Of equal texts the row with the smallest id is kept; a null id comes after all others, and of
    repeated rows exactly one is kept. Null texts are empty texts, and empty texts are equal. An
    empty table gives an empty result. Other columns are ignored. ``hash_bits`` below 64 makes
    hashes collide, for tests. ``_row`` numbers the rows.
    """
    entries = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    size = F.octet_length("_norm").cast("bigint") + 64
    entries = settled(
        entries.select(
            "_id",
            F.monotonically_increasing_id().alias("_row"),
            _hash("_norm", hash_bits).alias("_h"),
            F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
            size.alias("_bytes"),
            "_norm",
        ),
        "dedup-index",
    )
    owned = _paged(entries.drop("_bytes"), entries)
    chain = Window.partitionBy(*CHAIN)
    first = chain.orderBy(F.col("_id").asc_nulls_last(), "_row")
    found = owned.withColumns(
        {"_rank": F.row_number().over(first), "_lead": F.first("_row").over(first), "_lead_id": F.first("_id").over(first)}
    ).withColumn("_n", F.count(F.lit(1)).over(chain))
    spread = (F.col("_pages") > 1) & (F.col("_rank") == 1)
    found = settled(
        found.withColumn("_norm", F.when(spread, F.col("_norm"))).drop("_bucket", "_page"), "dedup-pages"
    )

    same = Window.partitionBy("_h", "_norm")
    order = same.orderBy(F.col("_lead_id").asc_nulls_last(), "_lead")
    joined = found.where(spread).select(
        F.col("_lead").alias("_at"),
        F.first("_lead_id").over(order).alias("_keep_id"),
        F.first("_lead").over(order).alias("_keep_row"),
        F.sum("_n").over(same).alias("_size"),
    )
    alone = F.col("_at").isNull()
    return found.join(joined, F.col("_lead") == F.col("_at"), "left").select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_lead_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("_size", "_n").alias("group_size"),
        (F.col("_row") == F.coalesce("_keep_row", "_lead")).alias("kept"),
        "text_sha256",
        "_row",
    )


def exact_kept(docs, id_col="doc_id", text_col="text", hash_bits=64):
    """The rows of ``docs`` that stay: of equal texts the one with the smallest id, as above.

    Texts move once, to the owner of their page. The rows have all their columns.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    rows = rows.withColumn("_norm", normalised(f"_doc.{text_col}")).withColumn("_h", _hash("_norm", hash_bits))
    size = F.octet_length("_norm").cast("bigint") + 64
    sizes = settled(rows.select("_h", size.alias("_bytes")), "dedup-sizes")
    # Any spread of rows over the pages of a bucket is right, so the number need not be stable.
    owned = _paged(rows.withColumn("_row", F.monotonically_increasing_id()), sizes)
    order = F.col(f"_doc.{id_col}").asc_nulls_last()
    first = owned.withColumn("_rank", F.row_number().over(Window.partitionBy(*CHAIN).orderBy(order))).where("_rank = 1")
    leads = first.where("_pages > 1").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_h", "_norm").orderBy(order))
    )
    return first.where("_pages = 1").select("_doc.*").union(leads.where("_rank = 1").select("_doc.*"))
