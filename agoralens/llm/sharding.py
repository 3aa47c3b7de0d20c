"""Placement of rows on shards through a permutation-filled lookup table.

Each shard has its own preference order of the slots of a prime-sized table: a start and a step
taken from its name. Shards take turns and claim their next free slot until the table is full.
Every shard gets an almost equal number of slots, and when a shard goes away most other slots
keep their owner. The table has a fixed size whatever the data, so it is a literal of the plan,
and a row finds its shard with one hash and one look-up, without a shuffle.
"""

import hashlib

from pyspark.sql import functions as F

SLOTS = 65537
DIGITS = 15


def _number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def _is_prime(n):
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards, slots=SLOTS):
    """The owner of each slot, as a position in ``shards``.

    Names must be distinct and the number of slots a prime of at least as many.
    """
    names = list(shards)
    if not names or len(set(names)) != len(names):
        raise ValueError("shards need distinct names, at least one")
    if not _is_prime(slots) or slots < len(names):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    place = [_number(f"start {name}") % slots for name in names]
    step = [_number(f"step {name}") % (slots - 1) + 1 if slots > 2 else 1 for name in names]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(names)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % slots
            owner[place[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key, slots=SLOTS):
    """The slot of a key: 60 bits of the MD5 of its text, modulo the table size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") % slots).cast("int")


def place(df, key_col, shards, slots=SLOTS, slot_name="slot", shard_name="shard"):
    """``df`` with the slot and the shard name of each row; existing columns of these names go.

    Equal keys get equal shards. Null keys count as the empty text. Rows of one key all go to one
    shard, so choose an id as the key where a group may be large.
    """
    owner = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",").cast("array<int>")
    names = F.array(*[F.lit(name) for name in shards])
    kept = df.select(*[df[c] for c in df.columns if c == key_col or c not in (slot_name, shard_name)])
    placed = kept.withColumn(slot_name, slot_of(F.col(key_col), slots))
    return placed.withColumn(shard_name, F.element_at(names, F.element_at(owner, F.col(slot_name) + 1) + 1))


def write_shards(df, key_col, shards, path, slots=SLOTS, files_per_shard=1):
    """Write the rows in one folder per shard, each cut into ``files_per_shard`` files."""
    part = F.pmod(F.xxhash64(F.col(key_col)), F.lit(files_per_shard))
    placed = place(df, key_col, shards, slots).withColumn("_part", part)
    count = len(shards) * files_per_shard
    placed.repartition(count, "shard", "_part").drop("_part").write.partitionBy("shard").parquet(path)
