"""Connected components by joins."""

from pyspark.sql import functions as F

from agoralens.session import settled


def _least(pairs):
    """Each node with its smallest neighbour, itself included."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges):
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settled(_least(both), "components-least")
    moved = both.join(least, "u").where(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges):
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = settled(down.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges):
    """``(u, v)`` with u not v into ``(node, root)``: the smallest node that each one reaches.

    Roots themselves have no row. Alternates large and small stars until nothing moves; each
    round is written to the shared folder, which cuts the lineage.
    """
    edges = settled(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "components")
    mark = _mark(edges)
    while mark[0]:
        edges = settled(_small_star(_large_star(edges)), "components")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def smallest_kept(docs, groups, id_col):
    """``docs`` without the ids of ``groups`` that are not the ``component_id`` of any of their rows."""
    stays = F.max(F.col(id_col) == F.col("component_id"))
    gone = groups.groupBy(F.col(id_col).alias("_gone")).agg(stays.alias("s")).where("not s")
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
