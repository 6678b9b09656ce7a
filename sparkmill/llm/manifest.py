"""Merkle manifest of a dataset: a leaf per row, a binary hash tree per group, a tree over the groups' roots.

Rows get their rank in their group from range partitions (a count per partition and group, and
a row number inside).  The binary digits of the rank name the nodes above a row: rows of one block
(all digits but the last DIGITS agree) are grouped by ever fewer digits, each grouping taking one level of the
tree, hashing the two children and nesting their structs.  A block is at most 2**DIGITS
leaves, so no row holds more; its root is a leaf of the next round's blocks, until a group has one node.

Proofs come down the same way: nested transforms walk a block from its root to its leaves, gathering
the siblings of every level, and explode emits the leaves.  What lies above a block reaches it as one more row of its
own (group, block), united and grouped with it, so no proof is made by a join.

A node that is alone on a level above which there is another is hashed by itself; the single node
of a group is its root as it is.

Edge cases: fields may be null (`-` in the leaf); a null group comes first and is no other group's; null ids come first, equal ids
are in the order of their leaves, and repeated rows have leaves of their own; other columns take no part; an empty table has
no leaves and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A block has 2**DIGITS leaves at most.
DIGITS = 8
#: Rows of a range partition.
RANGE_ROWS = 1 << 16
_PATH = "array<struct<before:string,after:string>>"


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields, each its number of bytes, a colon and its value, or `-` for null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """(materialized) rows with at, their rank in their gkey by order, and n, how many rows that gkey has."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS + 1)
    cut = materialize(rows.repartitionByRange(parts, "gkey", *order).withColumn("part", F.spark_partition_id()), "manifest-ranges")
    whole = Window.partitionBy("gkey")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("gkey", "part").agg(F.count("*").alias("k"))
    counts = counts.select("gkey", "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"), F.sum("k").over(whole).alias("n"))
    own = Window.partitionBy("gkey", "part").orderBy(*order)
    placed = cut.join(sized(materialize(counts, "manifest-counts"), 64), ["gkey", "part"])
    return placed.withColumn("at", F.col("base") + F.row_number().over(own) - 1)


def _depth(n: str) -> Column:
    """Levels above n nodes."""
    return F.expr(f"if({n} <= 1, 0, length(bin({n} - 1)))")


def _rollup(nodes: DataFrame) -> DataFrame:
    """nodes (gkey, at, n, node, own) -> gkey, block, n, node (of the block), kids (its nested levels)."""
    digits = [F.expr(f"cast((at >> {j}) & 1 as int)").alias(f"d{j}") for j in range(DIGITS)]
    rows = nodes.select("gkey", F.expr(f"at >> {DIGITS}").alias("block"), "n", *digits, "node", F.col("own").alias("kids"))
    # Every grouping below has these two keys, so none of them shuffles again.
    rows = rows.repartition("gkey", "block")
    for j in range(DIGITS):
        keys = ["gkey", "block", "n", *(f"d{k}" for k in range(j + 1, DIGITS))]
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(f"d{j}").alias("digit"), "node", "kids"))).alias("kids"))
        both = F.sha2(F.array_join(F.col("kids")["node"], ""), 256)
        rows = rows.withColumn("node", F.when(_depth("n") > j, both).otherwise(F.col("kids")[0]["node"]))
    return rows.select("gkey", "block", "n", "node", "kids")


def _down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """blocks and what lies above each (gkey, block, path, sub, top) -> a row per leaf: gkey, node, own, path, sub, top."""
    kinds = {f.name: f.dataType for f in blocks.schema}
    missing = lambda c, kind: F.lit(None).cast(kind).alias(c)
    ours = blocks.select("gkey", "block", "n", "kids", missing("path", _PATH), missing("sub", "string"), missing("top", "string"))
    theirs = above.select("gkey", "block", missing("n", "long"), missing("kids", kinds["kids"]), "path", "sub", "top")
    met = ours.unionByName(theirs).groupBy("gkey", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "sub", "top")))

    def walk(kids: Column, level: int, path: Column) -> Column:
        def each(kid: Column, i: Column) -> Column:
            step = F.struct(F.when(i == 1, kids[0]["node"]).otherwise("").alias("before"), F.when((i == 0) & (F.size(kids) == 2), F.get(kids, F.lit(1))["node"]).otherwise("").alias("after"))
            on = F.concat(F.when(F.col("depth") >= level, F.array(step)).otherwise(F.array().cast(_PATH)), path)
            return walk(kid["kids"], level - 1, on) if level > 1 else F.array(F.struct(kid["node"].alias("node"), kid["kids"].alias("own"), on.alias("path")))

        return F.flatten(F.transform(kids, each))

    leaves = met.withColumn("depth", _depth("n")).select("gkey", "sub", "top", F.explode(walk(F.col("kids"), DIGITS, F.col("path"))).alias("leaf"))
    return leaves.select("gkey", "leaf.node", "leaf.own", "leaf.path", "sub", "top")


def _proved(nodes: DataFrame, finish) -> DataFrame:
    """A row per node of nodes (gkey, at, n, node, own): gkey, node, own, path to the top, sub and top.

    finish(blocks): gkey, path, sub, top of the last round's blocks, one per gkey.
    """
    blocks = materialize(_rollup(nodes), "manifest-blocks")
    most = blocks.agg(F.max("n")).first()[0] or 0
    if most > 1 << DIGITS:
        up = blocks.select("gkey", F.col("block").alias("at"), F.expr(f"(n - 1) div {1 << DIGITS} + 1").alias("n"), "node", F.struct("block").alias("own"))
        above = _proved(up, finish).select("gkey", "own.block", "path", "sub", "top")
    else:
        above = finish(blocks).withColumn("block", F.lit(0).cast("long"))
    return _down(blocks, above)


def manifest(docs: DataFrame, fields=FIELDS, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of docs: order's column, leaf, path (per level from the leaf up: what is hashed before and after), subroot, root, and the columns of carry."""
    carry = carry or {}
    own = F.struct(F.col(f"`{order}`").alias("id"), *(c.alias(f"own_{k}") for k, c in enumerate(carry.values())))
    gkey = F.coalesce(F.concat(F.lit("s"), F.col(f"`{group}`").cast("string")), F.lit(""))  # null first
    rows = docs.select(gkey.alias("gkey"), leaf([F.col(f"`{f}`") for f in fields]).alias("node"), own.alias("own"))
    # The last key deals repeated rows out; which of two equal rows comes first is the same for both.
    rows = materialize(rows.withColumn("id", F.col("own.id")).withColumn("tie", F.monotonically_increasing_id()), "manifest-leaves")

    def top(blocks: DataFrame) -> DataFrame:
        return blocks.select("gkey", F.array().cast(_PATH).alias("path"), F.col("node").alias("sub"), F.col("node").alias("top"))

    def groups(blocks: DataFrame) -> DataFrame:
        subs = materialize(blocks.select(F.lit("").alias("gkey"), F.col("gkey").alias("name"), "node"), "manifest-groups")
        subs = ranked(subs, ["name"]).withColumn("own", F.struct("name"))
        return _proved(subs, top).select(F.col("own.name").alias("gkey"), "path", F.col("node").alias("sub"), "top")

    out = _proved(ranked(rows, ["id", "node", "tie"]), groups)
    return out.select(F.col("own.id").alias(order), F.col("node").alias("leaf"), "path", F.col("sub").alias("subroot"), F.col("top").alias("root"), *(F.col(f"own.own_{k}").alias(c) for k, c in enumerate(carry)))


def siblings(path: str = "path") -> Column:
    """All siblings of a proof, from the leaf up and from left to right, end to end."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings of a proof give."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))
