"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A key descends region, rack and shard.  At each level every child draws
``-ln(u) / weight`` with u hashed from the key and the child's path, and the least draw
wins, so a child gets its weight's part of the keys.  A changed weight only changes draws
on its own path: keys move between the changed subtree and the rest, never between
subtrees whose weights stay.

A new shard opens a region of its own: its draw competes at the root, so a key either
keeps its whole path or moves to the new shard.  The law is ``key``.

Edge cases: a null id hashes as the word null; a null text has no bytes; repeated rows take
the same shard and consecutive slots; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: (region, rack, shard, weight)
Leaf = tuple[int, int, int, float]
SLOT_BINS = 256

def tree(regions: int = 2, racks: int = 3, shards: int = 4, weight: float = 1.0) -> list[Leaf]:
    return [(r, k, (r * racks + k) * shards + s, weight) for r in range(regions) for k in range(racks) for s in range(shards)]

def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own."""
    return [*leaves, (max(x[0] for x in leaves) + 1, 0, max(x[2] for x in leaves) + 1, weight)]

def unit(key: Column, path: Column) -> Column:
    """Uniform in (0, 1), from the first 52 bits of an MD5 of key and path."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), path)), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def _children(leaves: list[Leaf], level: int) -> Column:
    """A map from a node's path to its children's [(least-draw label, weight)]: the topology as one literal."""
    nodes: dict[str, dict[int, float]] = {}
    for leaf in leaves:
        own = nodes.setdefault("/".join(map(str, leaf[:level])), {})
        own[leaf[level]] = own.get(leaf[level], 0.0) + leaf[3]
    entry = lambda c, w: F.struct(F.lit(c).alias("c"), F.lit(float(w)).alias("w"))
    return F.create_map(*(x for path, own in nodes.items() for x in (F.lit(path), F.array(*(entry(c, w) for c, w in own.items())))))


def descend(df: DataFrame, key: Column, leaves: list[Leaf], out: str) -> DataFrame:
    """df with column out: the shard that key reaches. Weights must be positive."""
    df = df.withColumn("__path", F.lit(""))
    for level in range(3):
        path = F.col("__path")
        least = F.array_min(F.transform(
            F.element_at(_children(leaves, level), path),
            lambda ch: F.struct((-F.log(unit(key, F.concat(path, F.lit(">"), ch["c"].cast("string")))) / ch["w"]).alias("d"), ch["c"].alias("c")),  # noqa: B023
        ))["c"]
        df = df.withColumn("__child", least)
        if level < 2:
            df = df.withColumn("__path", F.concat_ws("/", F.when(path != "", path), F.col("__child").cast("string")))
    return df.withColumn(out, F.col("__child")).drop("__path", "__child")


def assign(docs: DataFrame, leaves: list[Leaf], more: list[Leaf], bins: int = SLOT_BINS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots are numbered in (shard, bin) groups, the bin hashed from the id, so that no task
    holds a whole shard; each group's first slot comes from the counts of the groups before
    it (shards x bins rows).  Only ids and numbers are shuffled, not texts.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    base = docs.select("doc_id", "text").withColumn("__bin", F.floor(unit(key, F.lit("slot")) * bins).cast("int"))
    base = descend(descend(base, key, leaves, "shard"), key, more, "grown_shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = base.withColumn("size", F.octet_length(text).cast("long") + 8).withColumn("text_crc32", F.crc32(text.cast("binary"))).drop("text")
    # Written once: the draws are not made again for the counts.
    rows = materialize(rows, "shards")
    counts = rows.groupBy("shard", "__bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "__bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    own = Window.partitionBy("shard", "__bin").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("__at", F.row_number().over(own))
    # first has at most shards x bins rows, whatever the input.
    first = F.broadcast(first) if len(leaves) * bins * 24 <= 1 << 20 else first
    return rows.join(first, ["shard", "__bin"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"),
        (F.col("__first") + F.col("__at") - 1).alias("slot"), F.col("grown_shard").cast("int"),
    )


def write_shards(docs: DataFrame, leaves: list[Leaf], path: str) -> None:
    """The documents as Parquet, one folder per shard; several tasks write a shard."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    descend(docs, key, leaves, "shard").write.partitionBy("shard").parquet(path)
