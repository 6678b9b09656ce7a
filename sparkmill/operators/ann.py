"""Approximate nearest rows: cells and codes by random projections, exact distances for what is left.

A row's code is one bit for each of BITS random planes, the side on which it lies; its first CELL_BITS bits
name its cell.  A query looks into the `probes` cells that cost least, where a cell's cost is the sum of the squared distances to the
planes that lie between it and the query, and there at rows whose codes differ in `radius` bits at most.  Only
those get an exact distance.  Planes follow from a rule and projections are added as integers, so codes
do not depend on the order of sums and SQL gets the same ones.

Every row is indexed; a row of the index is found by its cell, so an index written by `write_index` is
read by the partitions that queries probe.  Cells of more than CELL_ROWS rows are dealt out by a hash of the id, however large they are.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Planes; bits that name a cell.
BITS, CELL_BITS = 512, 6
#: Defaults: of 64 cells the 56 that cost least, of 512 bits at most 240 that differ.
PROBES, RADIUS = 56, 240
#: Rows of a cell that one task looks through at a time; pairs whose vectors it gathers at once.
CELL_ROWS, PAIRS = 1 << 13, 1 << 17
#: Vectors are rounded to multiples of 2**-20 for their codes.
SCALE = 1 << 20

_WORDS = BITS // 64


def planes(dim: int) -> np.ndarray:
    """BITS planes as rows of +1 and -1: the first hex digit of md5('plane-<bit>-<dimension>') is below 8 or not."""
    sign = lambda b, d: 1.0 if hashlib.md5(f"plane-{b}-{d}".encode()).hexdigest()[0] < "8" else -1.0
    return np.array([[sign(b, d) for d in range(dim)] for b in range(BITS)])


def _projected(x: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Whole numbers, exact in doubles whatever the order of their sums."""
    return np.floor(x * SCALE + 0.5) @ sides.T


def _code(projected: np.ndarray) -> np.ndarray:
    return np.packbits(projected >= 0, axis=1, bitorder="little").view("<u8")


def _order(projected: np.ndarray) -> np.ndarray:
    """For each query its cells, the cheapest first (equal costs by number)."""
    first = projected[:, :CELL_BITS]
    cells = (np.arange(1 << CELL_BITS)[:, None] >> np.arange(CELL_BITS)) & 1
    cost = (((first >= 0)[:, None, :] != cells[None]) * (first**2)[:, None, :]).sum(2)
    return np.argsort(cost, axis=1, kind="stable").astype(np.int32)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def index(rows: DataFrame) -> DataFrame:
    """rows (vec_id, label, x) with cell and code (binary, BITS bits)."""

    def run(batches):
        sides = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2))
            sides = planes(x.shape[1]) if sides is None else sides
            code = _code(_projected(x, sides))
            cell = (code[:, 0] & np.uint64((1 << CELL_BITS) - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array([c.tobytes() for c in code], pa.binary())], ["vec_id", "label", "x", "cell", "code"])

    return rows.select("vec_id", "label", "x").mapInArrow(run, "vec_id long, label int, x array<double>, cell int, code binary")


def write_index(rows: DataFrame, path: str) -> None:
    """The index as Parquet, a folder per cell."""
    index(rows).repartition("cell").sortWithinPartitions("vec_id").write.partitionBy("cell").parquet(path)


def _probing(queries: DataFrame, probes: int) -> DataFrame:
    """queries (vec_id, label, x) with code, one row per probed cell."""

    def run(batches):
        sides = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2))
            sides = planes(x.shape[1]) if sides is None else sides
            m = _projected(x, sides)
            cells = _order(m)[:, :probes]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * cells.shape[1], pa.int32()), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in _code(m)], pa.binary()), lists], ["vec_id", "label", "x", "code", "cells"])

    found = queries.select("vec_id", "label", "x").mapInArrow(run, "vec_id long, label int, x array<double>, code binary, cells array<int>")
    return found.select("vec_id", "label", "x", "code", F.explode("cells").alias("cell"))


def _pairs_within(q: np.ndarray, c: np.ndarray, ql: np.ndarray, cl: np.ndarray, radius: int):
    """(query, row) indices of pairs of different labels whose codes differ in radius bits at most, some queries at a time."""
    step = max(1, (1 << 20) // max(1, len(c)))
    for lo in range(0, len(q), step):
        differ = np.zeros((min(step, len(q) - lo), len(c)), np.uint16)
        for w in range(_WORDS):
            differ += np.bitwise_count(q[lo : lo + step, w, None] ^ c[None, :, w])
        i, j = np.nonzero((differ <= radius) & (ql[lo : lo + step, None] != cl[None, :]))
        for k in range(0, len(i), PAIRS):
            yield i[k : k + PAIRS] + lo, j[k : k + PAIRS]


def _met(indexed: DataFrame, queries: DataFrame, probes: int) -> DataFrame:
    """Rows and probing queries under common keys (cell, turn): a large cell has as many turns as its rows need."""
    # One number for each of the 2**CELL_BITS cells reaches the driver.
    sizes = {r["cell"]: r["n"] for r in indexed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    turns = F.element_at(F.array(*(F.lit(max(1, -(-sizes.get(c, 0) // CELL_ROWS))) for c in range(1 << CELL_BITS))), F.col("cell") + 1)
    rows = indexed.select("vec_id", "label", "x", "code", "cell", F.pmod(F.xxhash64("vec_id"), turns).cast("int").alias("turn"), F.lit(False).alias("asks"))
    asked = _probing(queries, probes).select("vec_id", "label", "x", "code", "cell", F.explode(F.sequence(F.lit(0), turns - 1)).alias("turn"), F.lit(True).alias("asks"))
    return rows.unionByName(asked).groupBy("cell", "turn")


def _sides(table: pa.Table):
    def side(t):
        code = np.frombuffer(b"".join(t.column("code").to_pylist()), "<u8").reshape(-1, _WORDS)
        return t.column("vec_id").to_numpy(), t.column("label").to_numpy(), _matrix(t.column("x")), code

    asks = table.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
    return side(table.filter(pa.array(asks))), side(table.filter(pa.array(~asks)))


def approx_nearest(indexed: DataFrame, queries: DataFrame, k: int = 2, probes: int = PROBES, radius: int = RADIUS) -> DataFrame:
    """Like nearest: q, ql, c, cl, d2, r, of the rows whose cell and code pass."""

    def look(table: pa.Table) -> pa.Table:
        (q, ql, qx, qc), (c, cl, cx, cc) = _sides(table)
        best = []
        for i, j in _pairs_within(qc, cc, ql, cl, radius):
            d2 = np.round(2.0 - 2.0 * np.einsum("nd,nd->n", qx[i], cx[j]), 6)
            by = np.lexsort((c[j], d2, cl[j], i))
            i, j, d2 = i[by], j[by], d2[by]
            first = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (cl[j[1:]] != cl[j[:-1]])])
            place = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
            kept = place < k  # of one query's pairs, which may lie in two portions: a window below merges them
            best.append((q[i[kept]], ql[i[kept]], c[j[kept]], cl[j[kept]], d2[kept]))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.float64()]
        cols = zip(*best) if best else [[]] * 5
        return pa.table({n: pa.array(np.concatenate(v) if len(v) else [], t) for n, v, t in zip(("q", "ql", "c", "cl", "d2"), cols, kinds)})

    found = _met(indexed, queries, probes).applyInArrow(look, "q long, ql int, c long, cl int, d2 double")
    w = Window.partitionBy("q", "cl").orderBy("d2", "c")
    return found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)


def candidates(indexed: DataFrame, queries: DataFrame, probes: int = PROBES, radius: int = RADIUS) -> DataFrame:
    """q, n: how many rows get an exact distance to each query (queries without any are left out)."""

    def look(table: pa.Table) -> pa.Table:
        (q, ql, _, qc), (_, cl, _, cc) = _sides(table)
        n = np.zeros(len(q), np.int64)
        for i, _ in _pairs_within(qc, cc, ql, cl, radius):
            np.add.at(n, i, 1)
        return pa.table({"q": pa.array(q, pa.int64()), "n": pa.array(n)})

    return _met(indexed, queries, probes).applyInArrow(look, "q long, n long").groupBy("q").agg(F.sum("n").alias("n")).where("n > 0")


def recall(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """One row: n_exact, n_found (pairs q, c of both), recall (null without exact pairs)."""
    pairs = exact.select("q", "c").join(approx.select("q", "c", F.lit(1).alias("hit")), ["q", "c"], "left")
    return pairs.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found")).withColumn("recall", F.round(F.try_divide(F.col("n_found"), F.col("n_exact")), 6))


def tune(rows: DataFrame, exact: DataFrame, target: float = 0.95, sample: int = 4096) -> tuple[int, int]:
    """(probes, radius), the least that reach the target recall on a sample of about `sample` exact pairs (q, c, d2 ...).

    Each gets half of the loss: probes by the place of the neighbour's cell in the query's order, radius by the bits in which the two differ.
    The pairs are drawn by a hash, so the driver gets `sample` small rows at any size.
    """
    share = min(1.0, sample / max(1, exact.count()))
    some = exact.select("q", "c").where(F.pmod(F.xxhash64("q", "c"), F.lit(1 << 20)) < int(share * (1 << 20)))
    x = lambda name, v: rows.select(F.col("vec_id").alias(name), F.col("x").alias(v))
    pairs = some.join(x("q", "qx"), "q").join(x("c", "cx"), "c").select("qx", "cx")

    def run(batches):
        sides = None
        for batch in batches:
            if not batch.num_rows:
                continue
            qx, cx = _matrix(batch.column(0)), _matrix(batch.column(1))
            sides = planes(qx.shape[1]) if sides is None else sides
            m, other = _projected(qx, sides), _projected(cx, sides)
            cell = (_code(other)[:, 0] & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)
            place = np.argmax(_order(m) == cell[:, None], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(place + 1), pa.array(((m >= 0) != (other >= 0)).sum(1))], ["probes", "radius"])

    seen = pairs.mapInArrow(run, "probes long, radius long").collect()
    if not seen:
        return 1 << CELL_BITS, BITS
    at = math.ceil(len(seen) * (1 - (1 - target) / 2)) - 1
    return tuple(int(sorted(r[k] for r in seen)[at]) for k in (0, 1))
