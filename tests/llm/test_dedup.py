import random

import duckdb
import pytest
from brute import components, removed, shingles

from sparkmill.llm import jaccard, oracles, repeats
from sparkmill.llm.common import table

DATA = "/root/testdata"


def odd_rows():
    r = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    base = " ".join(r.choice(words) for _ in range(120))
    far = " ".join(r.choice(words) for _ in range(9000))
    edit = lambda t, n: " ".join(r.choice(words) if r.random() < n else w for w in t.split(" "))
    texts = [base, base, None, "", " \n", "one", "One", "one two", "ONE two", base.upper(), edit(base, 0.01), edit(base, 0.03), far, edit(far, 0.001), far[:30000], "é" * 80, "é" * 80, "ab" * 60, "ab" * 70]
    texts += [edit(base, 0.02) for _ in range(40)]
    line = " ".join(r.choice(words) for _ in range(14))
    texts += ["%s %s %s" % (edit(base, 1)[:80], line, edit(base, 1)[:200]) for _ in range(60)]
    rows = [(i * 3 + 1, t, None if i % 4 else "a", i) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[14], (None, base, "x", 1), (None, None, None, None)]


SCHEMA = "doc_id long, text string, bucket string, n int"


@pytest.mark.parametrize("hot", [8, 2])
def test_removed_bytes(spark, hot):
    from pyspark.sql import functions as F

    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = repeats.remove_repeats(docs, hot=hot).select("doc.doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256), "doc.bucket", "doc.n").collect()
    want = removed([x[:2] for x in rows])
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(key, (tuple(x)[:5] for x in got))) == sorted(map(key, want))
    assert sorted(map(key, (x[5:] for x in got))) == sorted(map(key, (x[2:] for x in rows)))
    assert any(x[2] for x in want)


def test_removed_bytes_of_the_table(spark):
    from pyspark.sql import functions as F

    docs = table(spark, f"{DATA}/sf0.001", "documents").select("doc_id", "text")
    got = repeats.remove_repeats(docs).select("doc.doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(removed([tuple(x) for x in docs.collect()]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(oracles.OP4).fetchall())


@pytest.mark.parametrize("bits", [8, 3, 64])
@pytest.mark.parametrize("hot", [8, 2])
def test_collisions_remove_nothing_else(monkeypatch, bits, hot):
    """The steps of remove_repeats on parts held here, with hashes of a few bits."""
    import hashlib

    import numpy as np
    import pyarrow as pa

    from sparkmill.llm import suffixes

    mask = np.uint64((1 << bits) - 1)
    for module, name in ((repeats, "mix"), (repeats, "spans"), (suffixes, "spans")):
        monkeypatch.setattr(module, name, lambda *x, f=getattr(module, name): f(*x) & mask)
    rows = [x[:2] for x in odd_rows()]
    shown = lambda rows, ddl: repeats._table(rows, ddl)
    part = lambda rows: repeats._Part(pa.table({"__text": pa.array([t for _, t in rows], pa.string()), "__id": pa.array([i for i, _ in rows], pa.int64())}), 50, 19)
    parts = [part(rows[k::5]) for k in range(5)]
    sent = [r for k, p in enumerate(parts) for r in repeats._anchors(p, k, 3, hot)]
    known = [r for b in range(3) if (own := [r for r in sent if r[0] == b]) for r in repeats._survivors(*zip(*(r[1:] for r in own)))]
    of = lambda k: [np.sort(repeats._unpack(b"".join(r[c] for r in known if r[0] == k))) for c in (1, 2)]
    spread = [r for k, p in enumerate(parts) for r in repeats._contexts(p, k, *of(k), 3, 50)]
    replies = [(*r, b"") for b in range(3) if (own := [r for r in spread if r[0] == b]) for r in repeats._least_ids(shown(own, repeats._SEND), 50, 19, 81)]
    replies += [(k, b"", b"", b"", b"", repeats._pack(of(k)[1])) for k in range(5)]
    got = []
    for k in range(5):
        p = part(rows[k::5][::-1])  # the rows of a part may come in another order
        gone = repeats._cuts(p, shown([r for r in replies if r[0] == k], repeats._REPLY), 50)
        for i, lo, hi in zip(p.table.column("__id").to_pylist(), p.at, p.at[1:]):
            got.append((i, int(hi - lo), int(gone[lo:hi].sum()), hashlib.sha256(p.raw[lo:hi][~gone[lo:hi]].tobytes()).hexdigest()))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(key, got)) == sorted(key((i, n, m, h)) for i, n, m, _, h in removed(rows))


def test_suffixes_are_sorted_whatever_collides(monkeypatch):
    import numpy as np

    from sparkmill.llm import hashing, suffixes

    r = np.random.default_rng(1)
    raw = np.tile(r.integers(97, 99, 300).astype(np.uint8), 3)
    starts, segment = np.arange(800), np.repeat(np.arange(4), 200).astype(np.uint64)
    for bits in (64, 8, 2):
        monkeypatch.setattr(suffixes, "spans", lambda *x: hashing.spans(*x) & np.uint64((1 << bits) - 1))
        order, shared = suffixes.sort_suffixes(raw, hashing.prefixes(raw), starts, segment, 60)
        texts = [raw[i : i + 60].tobytes() for i in starts[order]]
        for k in range(4):
            assert texts[200 * k : 200 * k + 200] == sorted(raw[i : i + 60].tobytes() for i in range(200 * k, 200 * k + 200))
        for i in range(1, 800):
            n = next((j for j in range(60) if texts[i][j] != texts[i - 1][j]), 60)
            assert shared[i] == (-1 if i % 200 == 0 else n)


def test_cleaned_texts_and_clashing_names(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(*x, b"own", 7, -1, "s", "p") for x in rows], SCHEMA + ", kept binary, n_bytes int, n_chars int, spans string, `doc` string")
    got = repeats.cleaned(docs)
    assert got.schema["n_bytes"].dataType == docs.schema["n_bytes"].dataType and got.columns == docs.columns
    assert repeats.remove_repeats(docs).select("doc.kept").distinct().collect() == [(b"own",)]
    texts = {x["n"]: x for x in got.where("doc_id is not null").collect()}
    assert all(bytes(x["kept"]) == b"own" and x["n_bytes"] == 7 and x["spans"] == "s" and x["doc"] == "p" for x in texts.values())
    assert all((x["text"] is None) == (rows[n][1] is None) and x["n_chars"] == (len(x["text"]) if x["text"] is not None else -1) for n, x in texts.items())
    accents = spark.createDataFrame([(1, "ab" * 24 + "é"), (2, "cc" + "ab" * 24 + "è" + "dd"), (3, "ab" * 24 + "é" + "ff")], "doc_id long, text string")
    # The first byte of both letters is one, so 50 bytes are shared with the letter cut in two.
    assert {x["doc_id"]: x["text"] for x in repeats.cleaned(accents).collect()} == {1: "ab" * 24 + "é", 2: "cc" + "ab" * 24 + "è" + "dd", 3: "ff"}
    odd = spark.createDataFrame([(1, "ab" * 25 + "xé"), (2, "ab" * 25 + "yé")], "doc_id long, text string")
    assert {x["doc_id"]: x["text"] for x in repeats.cleaned(odd).collect()} == {1: "ab" * 25 + "xé", 2: "yé"}
    half = spark.createDataFrame([(1, "a" * 49 + "é"), (2, "a" * 49 + "è")], "doc_id long, text string")
    assert {x["doc_id"]: x["text"] for x in repeats.cleaned(half).collect()} == {1: "a" * 49 + "é", 2: ""}


@pytest.mark.parametrize("postings,hot", [(1 << 18, 64), (700, 64), (700, 1), (1 << 18, 3)])
def test_components(spark, monkeypatch, postings, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = odd_rows()[:-2] + [(1, "another text of the first id", None, 1), (None, "a b c d", None, 1), (None, None, None, 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(x) for x in jaccard.link_components(docs, postings=postings).collect()]
    want = components([x[:2] for x in rows])
    assert sorted(x for x in got if x[0] is not None) == sorted((i, len(shingles(text)), want[i][1]) for i, text, *_ in rows if i is not None)
    assert sorted(x[1:] for x in got if x[0] is None) == [(0, None), (2, None)]
    assert len({c for _, c in want.values()}) < len(want) - 20


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_components_of_the_table(spark, words, percent):
    docs = table(spark, f"{DATA}/sf0.01", "documents").select("doc_id", "text")
    got = {x[0]: tuple(x)[1:] for x in jaccard.link_components(docs, words, percent).collect()}
    assert got == components([tuple(x) for x in docs.collect()], words, percent)


def rooted(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("long_", [0, 16])
@pytest.mark.parametrize("percent", [90, 80])
def test_search_finds_all_links_and_spans_components(monkeypatch, percent, long_):
    import numpy as np

    monkeypatch.setattr(jaccard, "LONG", long_)

    r = random.Random(11)

    for _ in range(60):
        size = r.choice([12, 40, 300])
        base, sets = [r.getrandbits(60) for _ in range(size)], []
        for _ in range(r.randrange(2, 40)):
            s = set(base[: r.randrange(1, size + 1) if r.random() < 0.3 else size])
            for _ in range(r.randrange(0, size // 8 + 2)):
                s.discard(r.choice(base))
                s.add(r.getrandbits(60))
            sets.append(np.array(sorted(s), np.uint64))
        same = {(j, i): len(np.intersect1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i)}
        want = {(j, i) for (j, i), n in same.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)}
        every, some = jaccard.search(sets, percent, True), jaccard.search(sets, percent)
        assert {tuple(sorted(x)) for x in every} == want and len(every) == len(want)
        assert {tuple(sorted(x)) for x in some} <= want and rooted(len(sets), some) == rooted(len(sets), want)


@pytest.mark.parametrize("long_", [0, 16])
@pytest.mark.parametrize("percent", [80, 90])
def test_search_of_texts_that_share_a_template(monkeypatch, percent, long_):
    """Lists that every document is in: links against all pairs, and work that does not grow with pairs."""
    import time
    from itertools import combinations

    import numpy as np

    monkeypatch.setattr(jaccard, "LONG", long_)
    r = np.random.default_rng(6)
    drawn = lambda n: r.integers(0, 1 << 62, n).astype(np.uint64)
    common = drawn(60)
    sets = [np.unique(np.r_[common[: r.integers(1, 60)], drawn(r.integers(0, 9))]) for _ in range(250)]
    sets += [np.unique(np.r_[s[1:], drawn(1)]) for s in sets[:60] if len(s) > 1] + sets[:3]
    linked = {(i, j) for i, j in combinations(range(len(sets)), 2) if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= percent * (len(sets[i]) + len(sets[j]) - o)}
    every, some = jaccard.search(sets, percent, True), jaccard.search(sets, percent)
    assert {tuple(sorted(x)) for x in every} == linked and len(linked) > 50
    assert {tuple(sorted(x)) for x in some} <= linked and rooted(len(sets), some) == rooted(len(sets), linked)
    began = time.time()
    assert jaccard.search([np.unique(np.r_[common[:9], drawn(1)]) for _ in range(26_000)], 90) == [] and time.time() - began < 10


@pytest.mark.parametrize("most", [1 << 25, 0])
def test_components_of_edges(spark, monkeypatch, most):
    from sparkmill.llm import components as c

    monkeypatch.setattr(c, "BROADCAST_BYTES", most)
    pairs = [(a, a + 1) for a in range(-20, 20)] + [(100, b) for b in range(101, 150)] + [(7000, -7000), (5, 5), (149, 150), (149, 150)]
    got = {r["node"]: r["component"] for r in c.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: -20 for i in range(-20, 21)}, **{i: 100 for i in range(100, 151)}, 7000: -7000, -7000: -7000}
    assert c.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_of_linked_sets_meet():
    import numpy as np

    r = random.Random(3)
    for _ in range(3000):
        n = r.choice([1, 2, 5, 9, 10, 11, 19, 20, 21, 40, 90, 300])
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(a)
        for _ in range(r.randrange(0, n // 8 + 2)):
            if r.random() < 0.5 and b:
                b.discard(r.choice(list(b)))
            if r.random() < 0.5:
                b.add(r.getrandbits(64))
        shared = len(a & b)
        if b and 100 * shared >= 90 * (len(a) + len(b) - shared):
            sa, sb = (jaccard.signatures(np.array(sorted(x), np.uint64)) for x in (a, b))
            assert len(np.intersect1d(sa, sb)), (len(a), len(b), shared)


@pytest.mark.parametrize("postings", [1 << 18, 700])
def test_all_links(spark, postings):
    rows = [x for x in odd_rows()[:-4]]
    got = [tuple(x) for x in jaccard.all_links(spark.createDataFrame(rows, SCHEMA), postings=postings).collect()]
    ids = {}
    for i, text, *_ in rows:
        if shingles(text):
            ids.setdefault(frozenset(shingles(text)), []).append(i)
    sets = sorted(ids, key=lambda s: min(ids[s]))
    pairs = [(s, t) for k, s in enumerate(sets) for t in sets[k + 1 :] if 100 * len(s & t) >= 90 * len(s | t)]
    assert sorted(got) == sorted((min(ids[s]), min(ids[t]), len(ids[s]), len(ids[t])) for s, t in pairs)
    assert len(got) > len({x for a, b, *_ in got for x in (a, b)})  # more than span them


def test_rows_counted_for_a_broadcast_are_as_small_as_counted(spark, monkeypatch):
    r = random.Random(9)
    words = ["w%d" % i for i in range(400)]
    base = [r.choice(words) for _ in range(150)]
    rows = [(i, " ".join("x%d" % i if k == i else w for k, w in enumerate(base))) for i in range(90)]
    counted = []

    def fits(placed):
        counted.extend(8 + sum(8 for _ in x) for x in placed.collect())
        assert {t for _, t in placed.dtypes} <= {"bigint", "int"}
        return True

    monkeypatch.setattr(jaccard, "_fits", fits)
    got = {x[0]: tuple(x)[1:] for x in jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string"), postings=600).collect()}
    assert got == components(rows) and len({c for _, c in got.values()}) == 1
    assert counted and max(counted) <= jaccard.PLACED_BYTES // 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert repeats.remove_repeats(docs).count() == 0
    assert jaccard.link_components(docs).count() == 0
    assert jaccard.one_of_each(docs).columns == docs.columns
