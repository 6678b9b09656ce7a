import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sparkmill import operators


class _Held:
    """Stands for a DataFrame of cells and keeps the function that looks at one."""

    def groupBy(self, *keys):
        return self

    def applyInArrow(self, look, schema):
        self.look = look
        raise StopIteration


def _look(k):
    held = _Held()
    with pytest.raises(StopIteration):
        operators._best(held, ["i"], k)
    return held.look


def _cell(rng, queries, rows, labels, dim=8):
    x = rng.integers(-2, 3, (queries + rows, dim)).astype(float)  # many ties
    x[:, 0] += 3
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = rng.permutation(queries + rows)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dim, pa.int32()), pa.array(x.ravel()))
    label = rng.integers(0, labels, len(x)).astype(np.int32)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(label), lists, pa.array(np.arange(len(x)) < queries)], ["vec_id", "label", "x", "asks"])
    return batch, ids, label, x


def test_a_cell_multiplies_in_portions(spark):
    batch, *_ = _cell(np.random.default_rng(3), 1 << 11, 1 << 13, 2)
    look = _look(2)
    tracemalloc.start()
    n = sum(out.num_rows for out in look(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2 * (1 << 11) and peak < 40 << 20  # a product of 2^10 queries and half of the rows has 32 MB alone


@pytest.mark.parametrize("portion", [1 << 10, 7])
@pytest.mark.parametrize("k", [1, 3])
def test_portions_of_a_cell_keep_the_nearest(spark, monkeypatch, portion, k):
    monkeypatch.setattr(operators, "PORTION", portion)
    batch, ids, label, x = _cell(np.random.default_rng(4), 30, 90, 3)
    want = []
    for q in range(30):
        for other in {0, 1, 2} - {label[q]}:
            near = sorted((round(2 - 2 * float(x[q] @ x[c]), 6), ids[c]) for c in range(30, 120) if label[c] == other)[:k]
            want += [(ids[q], label[q], c, other, d2) for d2, c in near]
    got = [tuple(r.values()) for out in _look(k)(iter([batch])) for r in out.to_pylist()]
    assert len({d for *_, d in want}) < len(want)
    assert [g[:4] for g in sorted(got)] == [w[:4] for w in sorted(want)] and all(math.isclose(a[4], b[4], abs_tol=1e-9) for a, b in zip(sorted(got), sorted(want)))


def _rows(spark, n=600, labels=12):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return spark.createDataFrame([(i, i % labels, x[i].tolist()) for i in range(n)], "vec_id long, label int, x array<double>")


@pytest.mark.parametrize("cell", [1 << 15, 9])
def test_a_match_asks_back_in_the_label_it_came_from(spark, monkeypatch, cell):
    monkeypatch.setattr(operators, "CELL_ROWS", cell)
    monkeypatch.setattr(operators, "CELL_QUERIES", cell)
    rows = _rows(spark)
    matches = operators.nearest(rows, 1).drop("r").cache()
    sent, best = [], operators._best
    monkeypatch.setattr(operators, "_best", lambda cells, keys, k: (sent.append(cells.count()), best(cells, keys, k))[1])
    got = {(r["a"], r["b"], r["la"], r["lb"]) for r in operators.mutual(rows, matches).collect()}
    x = {r["vec_id"]: (r["label"], np.array(r["x"])) for r in rows.collect()}
    near = lambda v, other: min((round(2 - 2 * float(x[v][1] @ y), 6), c) for c, (label, y) in x.items() if label == other)[1]
    asked = [(r["q"], r["ql"], r["c"], r["cl"]) for r in matches.collect()]
    want = {(min(q, c), max(q, c), *((ql, cl) if q < c else (cl, ql))) for q, ql, c, cl in asked if near(c, ql) == q}
    assert got == want and want
    wanted = {(c, ql) for _, ql, c, _ in asked}
    down = {other: -(-sum(o == other for _, o in wanted) // cell) for other in {ql for _, ql, _, _ in asked}}
    across = -(-50 // cell)  # rows of a label
    assert sent == [len(wanted) * across + 50 * sum(down.values())]


def test_tracks_reads_its_pairs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pairs = spark.createDataFrame([(1, 2), (3, 2), (5, 5)], "a long, b long").mapInArrow(count, "a long, b long")
    assert sorted(map(tuple, operators.tracks(pairs).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5)]
    assert seen.value == 3
