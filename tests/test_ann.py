"""The index of codes: recall, candidates, equality with a plain search of the same cells and codes."""

from pathlib import Path

import numpy as np
import pytest

from sparkmill import operators, plans
from sparkmill.operators import ann
from sparkmill.sources import table

DATA = "/root/testdata"


def _rows(spark, sf="sf0.001"):
    return operators.descriptors(table(spark, f"{DATA}/{sf}", "embeddings"))


def _plain(rows, probes, radius, k):
    """What the index should find, query by query."""
    sides = ann.planes(64)
    ids, labels, x = (np.array([r[c] for r in rows]) for c in ("vec_id", "label", "x"))
    m = np.floor(x * ann.SCALE + 0.5) @ sides.T
    bits = m >= 0
    cell = bits[:, : ann.CELL_BITS] @ (1 << np.arange(ann.CELL_BITS))
    out = []
    for i in np.flatnonzero(ids % 20 == 0):
        cost = [sum(m[i, b] ** 2 for b in range(ann.CELL_BITS) if (c >> b & 1) != bits[i, b]) for c in range(1 << ann.CELL_BITS)]
        near = sorted(range(1 << ann.CELL_BITS), key=lambda c: (cost[c], c))[:probes]
        ok = np.isin(cell, near) & ((bits != bits[i]).sum(1) <= radius) & (labels != labels[i])
        for lab in np.unique(labels[ok]):
            own = np.flatnonzero(ok & (labels == lab))
            d2 = np.round(2 - 2 * x[own] @ x[i], 6)
            for r, (d, c) in enumerate(sorted(zip(d2.tolist(), ids[own].tolist()))[:k], 1):
                out.append((int(ids[i]), int(labels[i]), c, int(lab), d, r))
    return sorted(out)


@pytest.mark.parametrize("probes,radius,k,cell_rows,portion", [(56, 240, 2, 1 << 13, 1 << 17), (20, 230, 3, 3, 7), (64, 512, 1, 5, 1000), (1, 200, 2, 4, 1)])
def test_search_against_plain_code(spark, monkeypatch, probes, radius, k, cell_rows, portion):
    monkeypatch.setattr(ann, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(ann, "PAIRS", portion)
    rows = _rows(spark)
    got = ann.approx_nearest(ann.index(rows), rows.where("vec_id % 20 = 0"), k, probes, radius).collect()
    assert sorted(map(tuple, got)) == _plain(rows.collect(), probes, radius, k)


@pytest.mark.parametrize("sf", [sf for sf in ("sf0.01", "sf0.1", "check_s") if Path(DATA, sf).exists()])
def test_recall_and_candidates(spark, sf):
    r = plans.approx_recall(spark, f"{DATA}/{sf}").first()
    assert r["n_exact"] > 0 and r["recall"] == round(r["n_found"] / r["n_exact"], 6) and r["recall"] >= 0.9
    assert r["n_candidates"] <= 0.25 * r["n_pairs"]


def test_all_cells_and_bits_are_exact(spark):
    rows = _rows(spark)
    asked = rows.where("vec_id % 20 = 0")
    got = ann.approx_nearest(ann.index(rows), asked, 2, 1 << ann.CELL_BITS, ann.BITS).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, operators.nearest(rows).collect()))


def test_tuned_settings_reach_their_target(spark):
    rows = _rows(spark, "sf0.1")
    exact = operators.nearest(rows).checkpoint()
    asked, indexed = rows.where("vec_id % 20 = 0"), ann.index(rows)
    loose, tight = ann.tune(rows, exact, 0.97), ann.tune(rows, exact, 0.8)
    assert tight[0] < loose[0] <= 1 << ann.CELL_BITS and tight[1] < loose[1] <= ann.BITS
    for (probes, radius), target in ((loose, 0.97), (tight, 0.8)):
        found = ann.recall(exact, ann.approx_nearest(indexed, asked, 2, probes, radius)).first()
        assert found["recall"] >= target - 0.03
    assert ann.tune(rows, exact.limit(0)) == (1 << ann.CELL_BITS, ann.BITS)


def test_index_files(spark, tmp_path):
    rows = _rows(spark)
    ann.write_index(rows, str(tmp_path / "index"))
    back = spark.read.parquet(str(tmp_path / "index"))
    assert back.count() == rows.count() and len(list((tmp_path / "index").glob("cell=*"))) == back.select("cell").distinct().count()
    asked = rows.where("vec_id % 20 = 0")
    assert sorted(map(tuple, ann.approx_nearest(back, asked).collect())) == sorted(map(tuple, ann.approx_nearest(ann.index(rows), asked).collect()))


def test_copies_ties_and_no_rows(spark):
    x = [1.0] + [0.0] * 63
    rows = spark.createDataFrame([(20 * i, i % 3, x) for i in range(30)], "vec_id long, label int, x array<double>")
    got = sorted(map(tuple, ann.approx_nearest(ann.index(rows), rows, 2).collect()))
    assert got == sorted(map(tuple, operators.nearest(rows).collect())) and len(got) == 30 * 2 * 2
    assert ann.approx_nearest(ann.index(rows.limit(0)), rows.limit(0)).count() == 0
    assert ann.approx_nearest(ann.index(rows), rows.limit(0)).count() == 0
    assert ann.candidates(ann.index(rows), rows.limit(0)).count() == 0
    r = ann.recall(operators.nearest(rows.limit(0)), operators.nearest(rows)).first()
    assert (r["n_exact"], r["n_found"], r["recall"]) == (0, 0, None)
