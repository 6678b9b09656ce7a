"""Which images may show the same: visual words, a weighted inverted file, the best partners of every image.

Words are the leaves of a vocabulary tree (hierarchical k-means on unit vectors, fitted level by
level on a bounded sample, every row is given its word) or the cells of the index of codes.  An image is its words' counts, weighted by
their rarity and brought to unit length; two images are as alike as the product of their postings.  Postings
are dealt to a grid of image blocks, each a sparse product in one task that keeps the best of every image,
so no list of images that share a common word is ever paired out.

Nulls: rows without a word or an image take no part.  Ties go to the lesser image.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import inverse_frequency, unit_weight
from ..sources import sized, stored

#: Children of a node, levels, rounds of a level's fit, vectors of the sample (about).
BRANCH, DEPTH, ROUNDS, SAMPLE_ROWS = 8, 3, 8, 1 << 16
#: Images of one side of a block.
BLOCK_IMAGES = 1 << 11
#: Vectors are added as multiples of 2**-20, so that a fit does not depend on the order of sums.
SCALE = 1 << 20


class Tree(NamedTuple):
    """centres[level]: for the nodes of a level, end to end, the unit vectors of their branch children."""

    branch: int
    centres: list[np.ndarray]


def _child(x: np.ndarray, node: np.ndarray, centres: np.ndarray, branch: int) -> np.ndarray:
    """The nearest child of each row's node; of equal ones the first."""
    out = np.zeros(len(x), np.int64)
    for k in np.unique(node):
        own = node == k
        out[own] = np.argmax(np.round(x[own] @ centres[k * branch : (k + 1) * branch].T, 9), axis=1)
    return node * branch + out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _down(x: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    for centres in tree.centres[:levels]:
        node = _child(x, node, centres, tree.branch)
    return node


def words(rows: DataFrame, tree: Tree, levels: int | None = None) -> DataFrame:
    """rows (vec_id, label, x) with word, the leaf of each (or its node after so many levels)."""
    levels = len(tree.centres) if levels is None else levels

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_down(_matrix(batch.column(2)), tree, levels))], ["vec_id", "label", "x", "word"])

    return rows.select("vec_id", "label", "x").mapInArrow(run, "vec_id long, label int, x array<double>, word long")


def fit_tree(rows: DataFrame, branch: int = BRANCH, depth: int = DEPTH, rounds: int = ROUNDS, sample: int = SAMPLE_ROWS) -> Tree:
    """The tree of a sample of about `sample` of rows, drawn by a hash of the id.

    All nodes of a level are fitted side by side.  A round is one pass that adds up the sample's vectors per child in
    every task, and one sum; the driver gets a vector per child (branch ** depth at most).  A node
    starts from its first members in the order of the hash; a child that nothing is nearest to stays where it is.
    """
    n = rows.count()
    drawn = F.pmod(F.xxhash64(F.lit("tree"), "vec_id"), F.lit(1 << 20)) < int(min(1.0, sample / max(1, n)) * (1 << 20))
    some = stored(rows.where(drawn).select("vec_id", "label", "x"), "tree-sample")
    first = some.limit(1).collect()
    if not first:
        return Tree(branch, [])
    dim, tree = len(first[0]["x"]), Tree(branch, [])
    for level in range(depth):
        nodes = branch**level
        by = Window.partitionBy("word").orderBy(F.xxhash64(F.lit("start"), "vec_id"), "vec_id")
        starts = words(some, tree, level).withColumn("k", F.row_number().over(by)).where(F.col("k") <= branch).select("word", "k", "x").collect()
        centres = np.zeros((nodes * branch, dim))
        for k in range(nodes):  # a node with few members has some children twice, the later of which stay empty
            own = sorted((r["k"], r["x"]) for r in starts if r["word"] == k) or [(1, [0.0] * dim)]
            centres[k * branch : (k + 1) * branch] = [own[i % len(own)][1] for i in range(branch)]
        for _ in range(rounds):
            moved = _round(some, tree, centres, dim)
            new = centres.copy()
            for child, total in moved:
                length = np.linalg.norm(total)
                new[child] = total / length if length else new[child]
            still, centres = np.array_equal(new, centres), new
            if still:
                break
        tree.centres.append(centres)
    return tree


def _round(some: DataFrame, tree: Tree, centres: np.ndarray, dim: int) -> list[tuple[int, np.ndarray]]:
    """(child, sum of the vectors nearest to it)."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                child = _child(x, _down(x, tree, len(tree.centres)), centres, tree.branch)
                whole = np.floor(x * SCALE + 0.5).astype(np.int64)
                for k in np.unique(child):
                    total[int(k)] = total.get(int(k), 0) + whole[child == k].sum(0)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], ["child", "total"])

    parts = some.select("x").mapInArrow(run, "child long, total array<long>")
    sums = parts.groupBy("child").agg(F.array(*(F.sum(F.col("total")[d]) for d in range(dim))).alias("total"))
    return [(r["child"], np.array(r["total"], np.float64)) for r in sums.collect()]


def postings(tagged: DataFrame) -> DataFrame:
    """tagged (label, word) -> image, word, weight: the inverted file, each image of unit length."""
    some = tagged.where("label is not null and word is not null")
    counts = stored(some.groupBy(F.col("label").alias("image"), "word").agg(F.count("*").alias("tf")), "word-counts")
    images = counts.select("image").distinct().count()
    rarity = counts.groupBy("word").agg(inverse_frequency(F.lit(images), F.count("*")).alias("idf"))
    weighed = counts.join(sized(stored(rarity, "word-weights"), 32), "word").withColumn("weight", F.col("tf") * F.col("idf"))
    return weighed.select("image", "word", unit_weight(F.col("weight"), "image").alias("weight"))


def image_pairs(inverted: DataFrame, top: int = 10, queries: DataFrame | None = None) -> DataFrame:
    """la, lb, score, r: for each image (of queries: image; all without it) the `top` most alike others.

    Images without a word in common score 0 and may fill the places that are left.
    """
    inverted = stored(inverted, "postings")
    images = inverted.select("image").distinct()
    asked = inverted if queries is None else inverted.join(queries.select("image").distinct(), "image", "left_semi")
    blocks = max(1, -(-images.count() // BLOCK_IMAGES))
    block = F.pmod(F.xxhash64("image"), F.lit(blocks)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = asked.select("image", "word", "weight", block.alias("i"), each.alias("j"), F.lit(True).alias("asks"))
    right = inverted.select("image", "word", "weight", each.alias("i"), block.alias("j"), F.lit(False).alias("asks"))

    def score(table: pa.Table) -> pa.Table:
        q, c = table.filter(table.column("asks")), table.filter(pc.invert(table.column("asks")))
        found = [[] for _ in range(3)]
        if q.num_rows and c.num_rows:
            names, at = np.unique(c.column("image").to_numpy(), return_inverse=True)
            word, weight = c.column("word").to_numpy(), c.column("weight").to_numpy()
            by = np.argsort(word, kind="stable")
            word, weight, at = word[by], weight[by], at[by]
            q = q.sort_by([("image", "ascending"), ("word", "ascending")])
            own, qw, qv = (q.column(n).to_numpy() for n in ("image", "word", "weight"))
            edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            for lo, hi in zip(edge, edge[1:]):
                total = np.zeros(len(names))
                for w, v in zip(qw[lo:hi], qv[lo:hi]):  # the list of each of its words
                    a, b = np.searchsorted(word, [w, w + 1])
                    total[at[a:b]] += v * weight[a:b]  # an image is in a list once
                total = np.round(total, 6)
                total[names == own[lo]] = -1
                best = np.lexsort((names, -total))[:top]
                best = best[total[best] >= 0]
                for out, v in zip(found, (np.full(len(best), own[lo]), names[best], total[best])):
                    out.append(v)
        return pa.table({n: pa.array(np.concatenate(v) if v else [], t) for n, v, t in zip(("la", "lb", "score"), found, (pa.int32(), pa.int32(), pa.float64()))})

    scored = left.unionByName(right).groupBy("i", "j").applyInArrow(score, "la int, lb int, score double")
    w = Window.partitionBy("la").orderBy(F.desc("score"), "lb")
    return scored.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top)


def pair_recall(graph: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: n_graph (edges la, lb of a view graph), n_found (those that pairs has either way round), recall."""
    either = pairs.select(F.least("la", "lb").alias("la"), F.greatest("la", "lb").alias("lb")).distinct().withColumn("hit", F.lit(1))
    both = graph.select("la", "lb").join(either, ["la", "lb"], "left")
    return both.agg(F.count("*").alias("n_graph"), F.count("hit").alias("n_found")).withColumn("recall", F.round(F.try_divide("n_found", "n_graph"), 6))
