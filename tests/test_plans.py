import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from sparkmill import plans, streaming
from sparkmill.sources import table

DATA = "/root/testdata/sf0.01"
REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    want = con.execute(plans.oracle_sql()[name])
    cols = sorted(c[0] for c in want.description)
    rows = [dict(zip((c[0] for c in want.description), r)) for r in want.fetchall()]
    got = [r.asDict() for r in plans.queries()[name](spark, DATA).collect()]
    key = lambda r: tuple(r[c] for c in cols)
    a, b = sorted(map(key, rows)), sorted(map(key, got))
    assert len(a) == len(b)
    assert all(x == y or math.isclose(x, y, abs_tol=1e-4) for r, s in zip(a, b) for x, y in zip(r, s))


def test_counts_of_a_stream_equal_the_batch(spark, tmp_path):
    events = table(spark, DATA, "events")
    batch = {tuple(r) for r in streaming.tumbling_counts(events).select("start", "event_type", "n").collect()}
    stream = spark.readStream.schema(events.schema).parquet(f"{DATA}/events*.parquet")
    q = streaming.tumbling_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("counts").select("start", "event_type", "n").collect()} == batch


def test_rejected_vectors_are_counted(spark):
    from sparkmill import operators

    unit, far = [1.0] + [0.0] * 63, [2.0] + [0.0] * 63
    vectors = [unit, far, unit[:63], [], None, [None] + unit[1:], [float("nan")] + unit[1:]]
    rows = spark.createDataFrame([(i, 0, x) for i, x in enumerate(vectors)], "vec_id long, label int, embedding array<float>")
    assert operators.rejects(rows).first().asDict() == {"n_rows": 7, "n_null": 2, "n_length": 2, "n_norm": 2}
    assert [r["vec_id"] for r in operators.descriptors(rows).collect()] == [0]


def test_event_counts_are_registered(spark):
    import __spark_entry__

    got = {(r["day"], r["event_type"], r["n"]): r["value"] for r in __spark_entry__.queries()["tumbling_counts"](spark, DATA).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    want = {r[:3]: r[3] for r in con.execute(__spark_entry__.oracle_sql()["tumbling_counts"]).fetchall()}
    assert got.keys() == want.keys() and all(math.isclose(v, want[k], rel_tol=1e-9) for k, v in got.items())


def test_imports_without_the_optional_parts(tmp_path):
    for p in ("__spark_entry__.py", "sparkmill"):
        (tmp_path / p).symlink_to(REPO / p) if p.endswith("py") else None
    import shutil

    shutil.copytree(REPO / "sparkmill", tmp_path / "sparkmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "__spark_entry__.py").unlink()
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
    assert "view_graph" in out.stdout and "op5" not in out.stdout, out.stderr


def test_nearest_of_any_ids_in_any_cells(spark, monkeypatch):
    import random

    from sparkmill import operators

    r = random.Random(2)
    ids = [*range(-3000, -2940), *range(40), 10**15, 10**15 + 20, -(10**17)]
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    rows = [(i, i % 3, unit([r.gauss(0, 1) for _ in range(8)])) for i in ids]
    rows += [(7777, 1, rows[0][2]), (7778, 1, rows[0][2])]  # ties go by id
    df = spark.createDataFrame(rows, "vec_id long, label int, x array<double>")
    want = []
    for q, ql, x in rows:
        if q % 20 == 0:
            for label in {0, 1, 2} - {ql}:
                best = sorted((round(2 - 2 * sum(a * b for a, b in zip(x, y)), 6), c) for c, cl, y in rows if cl == label)[:2]
                want += [(q, ql, c, label, d, k + 1) for k, (d, c) in enumerate(best)]
    for cells in ((1 << 13, 1 << 11), (20, 2)):
        monkeypatch.setattr(operators, "CELL_ROWS", cells[0])
        monkeypatch.setattr(operators, "CELL_QUERIES", cells[1])
        assert sorted(tuple(x) for x in operators.nearest(df).collect()) == sorted(want)
    assert operators.nearest(df.limit(0)).count() == 0


def test_tracks_of_chains_and_sinks(spark, tmp_path):
    from sparkmill import operators

    r = list(range(1, 60))
    pairs = [(a, b) for a, b in zip(r, r[1:]) if b != 30] + [(100, 101), (102, 101), (5, 5)]
    got = dict(tuple(x) for x in operators.tracks(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {**{i: 1 if i < 30 else 30 for i in r}, 100: 100, 101: 100, 102: 100}
    matches = spark.createDataFrame([(1, 0, 2, 1, 0.5), (3, 1, 2, 0, 0.25)], "q long, ql int, c long, cl int, d2 double")
    operators.write_matches(matches, f"{tmp_path}/m")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/m").select(matches.columns).collect())) == sorted(map(tuple, matches.collect()))
