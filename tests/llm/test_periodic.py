"""Runs of repeated words against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from brute import runs as brute_runs


from sparkmill.llm import oracles, periodic, queries
from sparkmill.llm.common import table

DATA = "/root/testdata"


def _found(docs: list[list[int]]):
    n = np.array([len(d) for d in docs], np.int64)
    found = list(zip(*(f.tolist() for f in periodic.find_runs(np.array([w for d in docs for w in d], np.int64), n))))
    return [[r[1:] for r in found if r[0] == k] for k in range(len(docs))]


def test_runs_of_random_words():
    rng = np.random.default_rng(11)
    for letters in (1, 2, 3, 5):
        docs = []
        for _ in range(60):
            n = int(rng.integers(0, 70))
            d = rng.integers(1, letters + 1, n).tolist()
            if n > 20 and rng.random() < 0.7:  # some turns, perhaps broken
                a, p = int(rng.integers(0, n // 2)), int(rng.integers(1, 9))
                d[a:] = [d[a + (i - a) % p] for i in range(a, n)]
                d[int(rng.integers(0, n))] = int(rng.integers(1, letters + 1))
            docs.append(d)
        assert _found(docs) == [brute_runs(d) for d in docs]


def test_long_periods_need_sorted_suffixes():
    rng = np.random.default_rng(12)
    docs = []
    for p in (2, 6, 7, 8, 30, 100, 333):
        turn = rng.integers(1, 1000, p).tolist()
        docs.append(rng.integers(1, 1000, 50).tolist() + turn * 5 + turn[: p // 2] + rng.integers(1, 1000, 31).tolist() + turn * 4)
    docs.append(docs[4][:-1])
    got = _found(docs)
    assert got == [brute_runs(d) for d in docs] and all(got)


def test_extensions_are_those_of_plain_comparison():
    rng = np.random.default_rng(13)
    for letters, sizes in ((1, [40, 13]), (2, [200, 1, 90]), (50, [300])):
        n = np.array(sizes)
        base = periodic.V + np.cumsum(n + periodic.V) - n - periodic.V
        x = np.zeros(int((n + periodic.V).sum()) + periodic.V, np.int64)
        for b, k in zip(base, n):
            x[b : b + k] = np.tile(rng.integers(1, letters + 1, 17), k // 17 + 1)[:k]
        at = periodic.Extensions(x, base, n)
        for b, k in zip(base.tolist(), n.tolist()):
            i, j = np.triu_indices(k + 1, 1)
            want = []
            for u, v in zip(i + b, j + b):
                h = 0
                while x[v + h] and x[u + h] == x[v + h]:
                    h += 1
                want.append(h)
            assert at.of_pairs(i + b, j + b).tolist() == want


def _edited(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def _want(doc_id, text):
    words = _edited(doc_id, [w.decode() for w in (text or "").encode().split()])
    number = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    runs = brute_runs([number[w] for w in words])
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_brute_force(spark):
    docs = table(spark, f"{DATA}/sf0.001", "documents")
    got = queries.op11_of(docs.where("length(text) < 2000")).select(COLUMNS).collect()
    want = [_want(r["doc_id"], r["text"]) for r in docs.where("length(text) < 2000").collect()]
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r["n_runs"] for r in got) and queries.op11_of(docs).count() == docs.count()


def test_odd_rows(spark):
    rows = [(None, None), (None, "a b " * 9), (7, ""), (7, " \t\n"), (7, ""), (35, "x " * 50), (8, "    " * 8), (9, "ab\x0b" * 6 + "\x00 \x1c" * 7), (10, "w" * 300_000), (11, " ".join(map(str, range(40_000)))), (12, "la " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = queries.op11_of(docs).select(COLUMNS).collect()
    small = [r for r in rows if r[0] not in (11, 12)]
    assert sorted(map(repr, (tuple(r) for r in got if r["doc_id"] not in (11, 12)))) == sorted(repr(_want(*r)) for r in small)
    whole = next(r for r in got if r["doc_id"] == 12)
    assert (whole["n_runs"], whole["start"], whole["length"], whole["period"]) == (1, 0, 40_000, 1)
    assert next(r for r in got if r["doc_id"] == 11)["n_runs"] == 0
    assert queries.op11_of(docs.limit(0)).count() == 0


def test_own_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b " * 6, "own", 7)], "id long, text string, runs string, doc int")
    r = periodic.runs(docs).first()
    assert r["doc"].asDict() == {"id": 1, "runs": "own", "doc": 7} and [tuple(x) for x in r["runs"]] == [(0, 12, 2)] and r["collapsed"] == "a b"
    assert periodic.runs(docs.select("text")).first()["n_words"] == 12


@pytest.mark.parametrize("h", [0])
def test_planted_text_is_edited(spark, h):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == h][:40]
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 97 + 1))) for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in queries.op11_texts(docs).collect()}
    assert got == {r["doc_id"]: " ".join(_edited(r["doc_id"], r["text"].split())) for r in docs.collect()}


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    got = queries.op11_periodic_runs(spark, f"{DATA}/sf0.001").select(COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracles.OP11})").fetchall())
