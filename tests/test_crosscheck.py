from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest

from sparkmill import operators, plans
from sparkmill.operators import crosscheck


def _mutual(x, label, ids):
    """(a, b, la, lb) by comparing all pairs."""
    d2 = np.round(2 - 2 * x @ x.T, 6)
    near = {}
    for i in range(len(x)):
        for other in set(label) - {label[i]}:
            near[i, other] = min((d2[i, j], ids[j], j) for j in range(len(x)) if label[j] == other)[2]
    pairs = {tuple(sorted((i, j), key=lambda k: ids[k])) for (i, other), j in near.items() if near[j, label[i]] == i}
    return {(ids[i], ids[j], label[i], label[j]) for i, j in pairs}


def _written(path, ids, label, x):
    path.mkdir()
    lists = pa.array(x.astype(np.float32).tolist(), pa.list_(pa.float32()))
    pa.parquet.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": lists, "label": pa.array(label, pa.int32())}), path / "embeddings.parquet")


@pytest.mark.parametrize("sizes", [[40] * 6, [1] * 150, [100, 1, 2, 60, 3, 1, 1]])
@pytest.mark.parametrize("portion,rows_of_a_block,ties", [(1 << 9, 1 << 16, False), (7, 1 << 16, True), (16, 20, True)])
def test_all_rows_ask(spark, monkeypatch, sizes, portion, rows_of_a_block, ties):
    rng = np.random.default_rng(5)
    label = np.repeat(np.arange(len(sizes)), sizes).tolist()
    x = rng.integers(-1, 2, (len(label), 4)).astype(float) + 3 * np.eye(4)[0] if ties else rng.normal(size=(len(label), 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = (rng.permutation(len(label)) * 3 - 100).tolist()
    rows = spark.createDataFrame([(i, v, y.tolist()) for i, v, y in zip(ids, label, x)], "vec_id long, label int, x array<double>")
    cell = crosscheck._cell

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, crosscheck.PORTION = crosscheck.PORTION, portion  # of the worker, which imports the module anew
        yield from cell(batches)
        crosscheck.PORTION = before

    monkeypatch.setattr(crosscheck, "_cell", small)
    monkeypatch.setattr(crosscheck, "BLOCK_ROWS", rows_of_a_block)
    got = [tuple(r) for r in crosscheck.mutual_pairs(rows).select("a", "b", "la", "lb").collect()]
    want = _mutual(x, label, ids)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(a % 20 and b % 20 for a, b, *_ in want)


def _sql(path, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    return con.execute(plans.oracle_sql()[name])


#: What two pairs of ids that 20 does not divide give.
OF_TWO_PAIRS = {
    "mutual_matches": [(1, 2, 0, 1), (3, 41, 0, 1)],
    "tracks": [(1, 1), (2, 1), (3, 3), (41, 3)],
    "track_stats": [(2, 2, 0)],
    "consistent_tracks": [(1, 2), (3, 2)],
}


@pytest.mark.parametrize("name", sorted(OF_TWO_PAIRS))
def test_ids_that_20_does_not_divide(spark, tmp_path, name):
    x = np.eye(64)[[0, 0, 1, 1]]
    x[1, 2] = x[2, 3] = 0.01
    _written(tmp_path / "in", [1, 2, 3, 41], [0, 1, 0, 1], x)
    want = OF_TWO_PAIRS[name]
    got = sorted(tuple(r)[: len(want[0])] for r in plans.queries()[name](spark, f"{tmp_path}/in").collect())
    assert got == want and len(_sql(tmp_path / "in", name).fetchall()) == len(want)


def test_odd_ids_and_labels_as_in_sql(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(60, 64)), 2, axis=0)  # each vector twice
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids, label = [int(i) for i in rng.integers(0, 90, 120)], [int(v) for v in rng.integers(0, 4, 120)]
    ids[3] = ids[40] = label[7] = label[60] = None
    _written(tmp_path / "in", ids, label, x)
    query = _sql(tmp_path / "in", "mutual_matches")
    names = [c[0] for c in query.description]
    got = plans.queries()["mutual_matches"](spark, f"{tmp_path}/in").select(names)
    cut = lambda rows: sorted(tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in rows)
    assert cut(map(tuple, got.collect())) == cut(query.fetchall()) != []


def test_products_of_single_precision_decide_nothing():
    """Rows whose distances differ by less than single precision tells, and equal rows by the hundred."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=64)
    base /= np.linalg.norm(base)
    x = base + rng.normal(size=(400, 64)) * 1e-4
    x[100:300] = x[100]
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.arange(400) % 2
    lists = pa.ListArray.from_arrays(pa.array(np.arange(401) * 64, pa.int32()), pa.array(x.ravel()))
    zero = pa.array(np.zeros(400, np.int32))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(400)), pa.array(label, pa.int32()), lists, zero, zero, pa.array(np.ones(400, bool))], ["vec_id", "label", "x", "i", "j", "left"])
    got = {(r["q"], r["c"]) for out in crosscheck._cell(iter([batch])) for r in out.to_pylist()}
    d2 = np.round(2 - 2 * np.einsum("ik,jk->ij", x, x), 6)
    d2[label[:, None] == label] = np.inf
    assert got == {(i, int(j)) for i, j in enumerate(d2.argmin(axis=1))}
