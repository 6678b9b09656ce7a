"""The Merkle manifest against a plain tree, and against SQL."""

import hashlib
import zlib

import duckdb
import pytest

from sparkmill.llm import manifest, oracles, queries

DATA = "/root/testdata"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, kids string, n string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, more=0):
    values = (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes):
    """(root, proof of every node: what stands before and after it on each level)."""
    proofs, above = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(above):
            proofs[k].append((nodes[i - 1], "") if i % 2 else ("", "".join(nodes[i + 1 : i + 2])))
        nodes, above = [_h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [i // 2 for i in above]
    return nodes[0], proofs


def _want(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for v in langs:
        own = sorted(by[v], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[v] = own, *_tree([_leaf(r) for r in own])
    root, top = _tree([trees[v][1] for v in langs])
    out = []
    for v, over in zip(langs, top):
        for r, proof in zip(trees[v][0], trees[v][2]):
            picked = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            fold = _leaf(r, int(picked))
            for before, after in proof + over:
                fold = _h(before, fold, after)
            out.append((r[0], _leaf(r), trees[v][1], root, _h(*(b + a for b, a in proof + over)), fold, fold == root))
    return out


@pytest.mark.parametrize("digits", [2])
def test_against_a_plain_tree(spark, monkeypatch, digits):
    monkeypatch.setattr(manifest, "DIGITS", digits)
    rows = [(i * 3 % 101, f"text {i} é", ("en", "de", "zz", None)[min(3, i % 9)], "s", i, 1, "k", "n") for i in range(41)]
    rows += [(5, "one", "fr", None, 3, None, None, None), (None, None, None, None, None, None, None, None), (None, "", "en", "", 0, 1, "k", "n"), (None, "", "en", "", 0, 1, "k", "n"), (7, "x" * 200_000, "é", "a:b", 2**63 - 1, 1, "k", "n")]
    rows += [(7, "same", "en", "s", 4, 1, "k", "n")] * 9
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in queries.op13_of(docs).select(COLUMNS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, _want(rows)))
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 257])
def test_sizes_about_a_block(spark, n):
    rows = [(i, "t", "en", "s", 1, 1, "k", "n") for i in range(n)]
    got = [tuple(r) for r in queries.op13_of(spark.createDataFrame(rows, SCHEMA)).select(COLUMNS).collect()]
    assert sorted(got) == sorted(_want(rows) if rows else [])


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    got = queries.op13_merkle_manifest(spark, f"{DATA}/sf0.001").select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracles.OP13})").fetchall())
    assert all(r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) for r in got)


def test_other_groups_and_fields(spark):
    docs = spark.createDataFrame([(i, f"v{i}", f"g{i % 3}") for i in range(20)], "key long, value string, part string")
    rows = manifest.manifest(docs, fields=("key", "value"), group="part", order="key").collect()
    assert len({r["root"] for r in rows}) == 1 and len({r["subroot"] for r in rows}) == 3
    for r in rows:
        at = r["leaf"]
        for step in r["path"]:
            at = _h(step["before"], at, step["after"])
        assert at == r["root"]
