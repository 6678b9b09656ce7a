import hashlib
import math
import zlib
from itertools import combinations

import duckdb
import pyarrow as pa
import pytest
from brute import rules
from pyspark.sql import functions as F

from sparkmill.llm import licenses, mix, oracles, quality, queries, shards, sketch
from sparkmill.llm.common import table

DATA = "/root/testdata"
SCHEMA = "doc_id long, text string, source string, size int, n_words string, bin int"
TEXT = "the quick brown fox jumps over the lazy dog and runs far away from here today " * 9
ROWS = [(7, TEXT, "a", 1, "x", 1), (3, None, "b", 1, "x", 1), (9, "", None, 1, "x", 1), (4, "one", "a", 1, None, None), (4, "one", "a", 1, None, None), (None, "x y", "é", 1, "x", 1), (5, "w " * 30000, "b", 2, "y", 2), (6, "é\tü\x0b# $\n\n# $", "c", 2, "y", 2)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rules(spark, odd, none):
    docs = table(spark, f"{DATA}/sf0.001", "documents").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = sorted((tuple(r) for r in quality.ledger(docs).select("doc_id", *quality.MEASURES[:5]).collect()), key=repr)
    assert got == sorted(((r["doc_id"], *rules(r["text"])) for r in docs.collect()), key=repr)
    assert quality.ledger(odd).columns == ["doc_id", "source", "size", "bin", *quality.MEASURES, "fail_bits"]
    assert quality.ledger(none).count() == 0 and quality.keep_documents(odd).columns == odd.columns
    led = quality.ledger(docs)
    kept = led.where(quality.passes("strict-1")).count()
    for r in quality.ablation(led, "strict-1").collect():
        bit = quality.bits([r["rule"]])
        assert r["n_failed"] == led.where(F.col("fail_bits").bitwiseAND(bit) != 0).count()
        assert r["n_failed_alone"] == led.where(F.col("fail_bits").bitwiseAND(quality.bits(quality.STRICT)) == bit).count() and r["n_kept"] == kept
    first = quality.ledger(docs, first=True)
    assert sorted(map(repr, first.collect())) == sorted(map(repr, led.select("doc_id", *quality.MEASURES[: quality.FIRST], F.col("fail_bits").bitwiseAND(quality.bits(quality.STRICT)).alias("fail_bits")).collect()))


RULE_TEXTS = {
    "few_letters": "12 34 --- 5 6 7 8 9 word %" * 9, "numbers": "1 22 333 a word here " * 20, "single_letters": "a b c d e word " * 12, "long_word": "x" * 1001 + " and the rest of it " * 12, "links": "http://a.b www.c and some more words of it " * 9,
    "braces": "if (a) { b } else { c } " * 12, "no_common_words": "xylophone quartz vivid jumps " * 20, "one_word": "spam eggs spam spam ham " * 15, "few_distinct": "one two three four " * 20, "short_lines": "a b\n" * 9,
    "bullets": "- a point of it\n* another\n  • third one\n" * 5, "ellipses": "and so on...\nthen more…\nend of it. \n" * 6, "no_sentence_ends": "a line without an end\n" * 6, "repeated_line_text": "the same long line comes again\n" * 4 + "once", "repeated_fives": "one two three four five six " * 3 + "seven", "filler": "Some Lorem IPSUM dolor",
    "many_words": "w " * 100_001,
}


@pytest.mark.parametrize("name", sorted(RULE_TEXTS))
def test_every_rule_has_a_text_that_fails_it(name):
    plain = "The house stands on a hill, and the river runs to the sea below it.\nIn spring the grass of its garden is green with rain. Who would not walk there?"
    fails = lambda text: {n for n, rule in quality.RULES.items() if eval(rule.replace(" = ", " == "), {}, dict(zip(quality.MEASURES, quality.measure(text))))}
    assert name in fails(RULE_TEXTS[name]) and fails(plain) == {"few_words"} and set(RULE_TEXTS) == set(quality.RULES) - set(quality.STRICT)


def test_rules_in_sql(spark):
    rows = [(i, t) for i, t in enumerate([*RULE_TEXTS.values(), None, "", " \n\t", "é\n É.\nFür DIE \x0b...\n", "a\r\nb\r\n a", "{}{ • •x http:// HTTP://x 9 99. — « “"])]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": pa.array([t for _, t in rows], pa.string())}))
    cols = ["doc_id", *quality.MEASURES, "fail_bits"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({oracles.OP5})").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, quality.ledger(docs).select(cols).collect())) == sorted(want)
    patterns = quality.ablation(quality.stored_ledger(docs), "web-1")
    names = {n: i for i, n in enumerate(quality.RULES)}
    assert {r["rule"]: r["n_failed"] for r in patterns.collect()} == {n: sum(w[-1] >> i & 1 for w in want) for n, i in names.items()}


def test_rules_agree_with_labels(spark):
    docs, labels = table(spark, f"{DATA}/sf0.01", "documents"), table(spark, f"{DATA}/sf0.01", "labels")
    rows = quality.stored_ledger(docs.select("doc_id", "text")).join(labels, "doc_id").select("quality", "n_words", quality.passes("strict-1").alias("kept")).collect()
    assert any(r["quality"] == 0 for r in rows) and not any(r["kept"] for r in rows if r["quality"] == 0)
    assert all(r["kept"] for r in rows if r["quality"] == 1 and r["n_words"] >= 50)
    assert quality.ledger(docs.select("doc_id", "text").limit(0)).count() == 0


def test_kept_documents_keep_clashing_columns(spark):
    docs = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(90)), "own", "mine"), (2, "few words", "own", "mine"), (3, None, None, None)], "doc_id long, text string, n_words string, fail_bits string")
    assert [tuple(r) for r in quality.keep_documents(docs).collect()] == [tuple(docs.first())]


def test_mix(spark, odd, none):
    for docs in (table(spark, f"{DATA}/sf0.001", "documents"), odd):
        got, rows = mix.taken_words(docs).collect(), docs.collect()
        size = {}
        for r in rows:
            size[r["source"]] = size.get(r["source"], 0) + rules(r["text"])[0]
        names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
        weight = {s: mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
        want, open_, total = {}, set(names), sum(size.values())
        while True:  # targets stop at three times the size, the rest is shared again
            rest = total - sum(want.values())
            share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
            over = {s for s in open_ if share[s] > 3 * size[s]}
            if not over:
                want |= share
                break
            want |= {s: 3.0 * size[s] for s in over}
            open_ -= over
        assert sorted((r["size"] for r in got)) == sorted(rules(r["text"])[0] for r in rows)
        assert all(r["taken"] <= 3 * r["size"] for r in got)
        assert math.isclose(sum(r["taken"] for r in got), total, abs_tol=mix.BLOCK * len(names))
        for s, t in want.items():
            assert any(math.isclose(r["target"], t, rel_tol=1e-9, abs_tol=1e-6) and r["source_size"] == size[s] for r in got)
        by_target = {}
        for r in got:
            by_target[r["source_size"], round(r["target"], 6)] = by_target.get((r["source_size"], round(r["target"], 6)), 0) + r["taken"]
        if len(rows) > 100:
            assert all(abs(n - t) <= 3 * mix.BLOCK for (_, t), n in by_target.items())
        assert sorted(map(tuple, mix.taken_words(docs).collect()), key=repr) == sorted(map(tuple, got), key=repr)
        out = mix.mixed_documents(docs)
        assert out.columns == docs.columns
        assert out.select(F.sum(F.expr(mix.WORD_SIZE))).first()[0] == sum(r["taken"] for r in got)
    assert mix.taken_words(none).count() == 0 and mix.mixed_documents(none).count() == 0


def test_points_ranks_and_slots(spark):
    """schedule() and mix() against plain Python."""
    n, step = 5000, int((math.sqrt(5) - 1) / 2 * 2**48) | 1
    assert abs(step - mix.STEP) < 2**10 and mix.STEP % 2 == 1
    edges = [0, 2**48 // 3, 2**48 // 3, 2**48 // 3 + 10**11, 2**48]
    plan = spark.createDataFrame([(k, lo, hi, n) for k, lo, hi in zip("abcd", edges, edges[1:])], "skey string, lo long, hi long, slots long")
    got = sorted(tuple(r) for r in mix.schedule(spark, plan).collect())
    want, seen = [], {}
    for slot in range(n):
        u = slot * mix.STEP % 2**48
        k = next(k for k, lo, hi in zip("abcd", edges, edges[1:]) if lo <= u < hi)
        want.append((slot, k, seen.get(k, 0)))
        seen[k] = seen.get(k, 0) + 1
    assert got == want and "b" not in seen
    far = [(1 << 62) + 12345, (1 << 32) - 1, 7]
    points = spark.createDataFrame([(x,) for x in far], "slot long").select(F.expr(mix._point("slot"))).collect()
    assert [r[0] for r in points] == [x * mix.STEP % 2**48 for x in far]
    docs = table(spark, f"{DATA}/sf0.001", "documents")
    rows = mix.mix(docs).where("slot is not null").collect()
    total = sum(x[0] for x in docs.select(F.expr(mix.WORD_SIZE)).collect())
    by_slot, by_source = {}, {}
    for r in rows:
        at = r["start"] + r["epoch"] * r["source_size"]
        by_slot.setdefault(r["slot"], []).append((r["skey"], at + r["word_lo"], at + r["word_hi"]))
    for slot, parts in sorted(by_slot.items()):
        (k,) = {p[0] for p in parts}
        rank = by_source[k] = by_source.get(k, -1) + 1  # the next block of its source, in whole
        assert min(p[1] for p in parts) == rank * mix.BLOCK and max(p[2] for p in parts) <= (rank + 1) * mix.BLOCK
        assert sum(p[2] - p[1] for p in parts) == max(p[2] for p in parts) - rank * mix.BLOCK
    assert len(by_slot) == -(-total // mix.BLOCK)


def test_mixed_documents_come_in_slot_order(spark):
    docs = table(spark, f"{DATA}/sf0.001", "documents").withColumn("slot", F.lit("own")).withColumn("__other", F.lit(1))
    first = {}
    for r in mix.mix(docs).where("slot is not null").collect():
        first[r["doc_id"], r["epoch"]] = min((r["slot"], r["start"]), first.get((r["doc_id"], r["epoch"]), (1 << 60, 0)))
    got = [r["doc_id"] for r in mix.mixed_documents(docs).collect()]
    assert got == [i for i, _ in sorted(first, key=first.get)] and mix.mixed_documents(docs).columns == docs.columns
    twins = spark.createDataFrame([(1, "a b", "x"), (1, "c d", "x"), (1, "a b", "x"), (1, "e", "x")], "doc_id long, text string, source string")
    out = [r["text"] for r in mix.mixed_documents(twins, 1).collect()]
    assert sorted(out) == ["a b", "a b", "c d", "e"]


def test_shards(spark, odd, none):
    got = queries.op9_hash_tree(spark, f"{DATA}/sf0.001").collect()
    text = {r["doc_id"]: r["text"] for r in table(spark, f"{DATA}/sf0.001", "documents").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    sql = {r[0]: r for r in con.execute(f"SELECT doc_id, size, law, shard, slot, grown_shard FROM ({oracles.OP9})").fetchall()}
    for r in got:
        assert (r["doc_id"], r["size"], r["law"], r["shard"], r["slot"], r["grown_shard"]) == sql[r["doc_id"]]
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
        assert r["grown_shard"] in (r["shard"], 24)
    leaves = shards.tree(2, 3, 4)
    rows = shards.assign(odd, leaves, shards.grown(leaves)).collect()
    assert len(rows) == len(ROWS)
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert shards.assign(none, leaves, shards.grown(leaves)).count() == 0


def test_a_weight_moves_keys_in_its_subtree_only(spark):
    leaves = shards.tree(2, 2, 2)
    heavier = [(r, k, s, w * (3 if s == 5 else 1)) for r, k, s, w in leaves]
    keys = spark.range(4000).withColumn("key", F.col("id").cast("string"))
    moved = shards.descend(shards.descend(keys, F.col("key"), leaves, "a"), F.col("key"), heavier, "b").collect()
    region = {s: r for r, _, s, _ in leaves}
    rack = {s: k for _, k, s, _ in leaves}
    assert any(r["a"] != r["b"] for r in moved)
    for r in moved:
        if r["a"] != r["b"]:
            assert region[r["b"]] == region[5]
            assert region[r["a"]] != region[5] or rack[r["b"]] == rack[5]
    n = sum(r["b"] == 5 for r in moved)
    assert abs(n / 4000 - 3 / 10) < 0.04


def shingle_hashes(text):
    """The kept hashes by brute force: XXH64 of each word seeded with the hash of those before it, as signed numbers."""
    import re

    import xxhash

    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    runs = [ws[i : i + 5] for i in range(len(ws) - 4)] if len(ws) >= 5 else [[" ".join(ws)]] if ws else []
    out = set()
    for run in runs:
        h = 42
        for w in run:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return {h for h in out if h < (1 << 63) // sketch.SCALE * 2 - (1 << 63)}


def test_sketches(spark, odd, none):
    more = odd.withColumns({c: F.lit(9) for c in ("guest", "edited", "sketch", "spot", "to")}).unionByName(odd.limit(1).selectExpr("*", *(f"8 AS {c}" for c in ("guest", "edited", "sketch", "spot", "to"))).withColumn("text", F.expr("repeat('long text of words ', 60000)")).withColumn("doc_id", F.lit(77).cast("long")))
    sizes = spark.conf.get("spark.sql.shuffle.partitions")
    for docs, parts in ((table(spark, f"{DATA}/sf0.001", "documents"), 16), (more, 5), (odd, 1)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        like = lambda a, b: 1.0 if a == b else len(shingle_hashes(a) & shingle_hashes(b)) / len(x) if (x := shingle_hashes(a) | shingle_hashes(b)) else 0.0
        want = []
        for i, (doc, text) in enumerate(rows):
            n, nxt = len(text), rows[(i + 1) % len(rows)][1]
            edited = text[: n - n // 3] + nxt[: n // 3]
            want.append((doc, n, hashlib.sha256(edited.encode()).hexdigest(), round(like(text, edited), 9), round(like(text, nxt), 9)))
        out = sketch.edited_pairs(docs).collect()
        assert sorted(((*tuple(r)[:3], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in out), key=repr) == sorted(want, key=repr)
        of = {}
        for (doc, text), _ in zip(rows, rows):
            of.setdefault(doc, set()).add(text)
        prints = {}
        for r in out:  # the hashes in a fingerprint are those kept, and one text has one fingerprint
            kept = {int(h, 16) - (1 << 64 if int(h, 16) >> 63 else 0) for h in r["fingerprint"].split(":")[1].split(",") if h}
            assert any(kept == shingle_hashes(x) for x in of[r["doc_id"]])
            if len(of[r["doc_id"]]) == 1:
                prints.setdefault(next(iter(of[r["doc_id"]])), set()).add(r["fingerprint"])
        assert all(len(x) == 1 for x in prints.values()) and len({next(iter(x)) for x in prints.values()}) == len(prints)
    spark.conf.set("spark.sql.shuffle.partitions", sizes)
    assert sketch.edited_pairs(none).count() == 0
    a, b = " ".join(f"w{i}" for i in range(4000)), " ".join(f"w{i}" for i in range(400))
    r = spark.createDataFrame([(a, b)], "a string, b string").select(sketch.sketch(F.col("a")).alias("a"), sketch.sketch(F.col("b")).alias("b"))
    got = r.select(sketch.containment(F.col("b"), F.col("a")), sketch.containment(F.col("a"), F.col("b")), F.size("a"), sketch.merged(F.col("a"), F.col("b")) == F.col("a")).first()
    assert got[0] == 1 and abs(got[1] - 0.1) < 0.03 and abs(got[2] * sketch.SCALE - 3996) < 400 and got[3]


NOTICES = {t.name: t.text for t in licenses.TEMPLATES}


def test_licenses(spark, none):
    worn = " ".join(w for i, w in enumerate(NOTICES["mit-text"].split()) if i % 11)
    rows = [(1, "x y z " * 500 + NOTICES["apache-2.0"] + " a b", "own"), (2, worn, None), (3, None, "o"), (4, "", "o"), (5, NOTICES["mit"] + "\n" + NOTICES["mit"], "o"), (6, "licensed under nothing", "o"), (None, "# " + NOTICES["gpl-3.0"], "o")]
    rows += [(7, "word, " * 200_000 + NOTICES["isc-text"], "o"), (8, NOTICES["gpl-2.0"], "o"), (8, NOTICES["gpl-2.0"], "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    all_ = licenses.scan(docs).collect()
    got = {(r["doc_id"], r["template"]): r for r in all_}
    assert sorted(map(repr, ((r["doc_id"], r["template"]) for r in all_))) == sorted(map(repr, [(1, "apache-2.0"), (2, "mit-text"), (5, "mit"), (5, "mit"), (None, "gpl-3.0"), (7, "isc-text"), (8, "gpl-2.0"), (8, "gpl-2.0")]))
    assert got[1, "apache-2.0"]["word_lo"] == 1500 and got[1, "apache-2.0"]["coverage"] == 1 and got[7, "isc-text"]["word_lo"] == 200_000
    assert got[2, "mit-text"]["coverage"] > 0.85
    assert licenses.scan(none).count() == 0
    own = licenses.templates_of(spark.createDataFrame([("house", "own-1", "Free for use within the house only", "house")], "name string, license string, text string, deciding string"))
    assert [r["license"] for r in licenses.scan(spark.createDataFrame([(1, "It is free for use within the house, only"), (2, "Free for use within the barn only")], "doc_id long, text string"), own).collect()] == ["own-1"]
    docs = table(spark, f"{DATA}/sf0.01", "documents")
    lines = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {(r["doc_id"], r["license"]) for r in licenses.scan(docs).collect()}
    for k in ("apache-2.0", "cc-by-nc-4.0", "gpl-3.0", "mit"):
        assert {i for i, x in lines.items() if NOTICES[k] in x} == {i for i, name in found if name == k}
    assert {name for _, name in found} == {"apache-2.0", "cc-by-nc-4.0", "gpl-3.0", "mit"}


def test_siblings_are_told_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    names = lambda text: [x[0].license for x in scanner.scan(text)]
    near = "Some words of the author go before it. "
    for t in licenses.TEMPLATES:
        assert names(t.text) == names(near + t.text + " And some go after it.") == [t.license], t.name
    wanted = {
        "Licensed under CC BY 4.0.": ["cc-by-4.0"], "Licensed under CC BY-SA 4.0.": ["cc-by-sa-4.0"], "CC BY-SA 4.0.": ["cc-by-sa-4.0"], "Licensed under CC BY-NC 4.0.": ["cc-by-nc-4.0"],
        "Released under the BSD License.": ["bsd"], "Released under the Apache License.": [], "released under the terms of the license": [],
        "Licensed under the Apache License, Version 1.1.": ["apache-1.1"], "Licensed under the Apache License, Version 1.1. See 2.0 too.": ["apache-1.1"],
        "This work is licensed under the GNU General Public License, version 2.": ["gpl-2.0"],
        "This work is licensed under the GNU General Public License, version 2. Chapter 3 begins.": ["gpl-2.0"],
        "This work is licensed under the GNU Lesser General Public License, version 3.": ["lgpl-3.0"],
        "This work is licensed under the GNU Affero General Public License, version 3.": ["agpl-3.0"],
        "Released under the license of the house.": [], "This work is licensed under the General Public Transport Act, version 3.": [],
        "Licensed under the MIT License or the Apache License, Version 2.0.": ["apache-2.0", "mit"],
    }
    for text, want in wanted.items():
        assert names(text) == names(near + text) == want, text
    from random import Random

    r, plain = Random(8), "the license under licensed released version of this work is software by public general terms mit apache 2.0 3".split()
    assert not [x for _ in range(400) for x in names(" ".join(r.choice(plain) for _ in range(12))) if x not in ("mit",)]


def test_names_identifiers_and_denials(spark):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    names = lambda text: [x[0].license for x in scanner.scan(text)]
    wanted = {
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["cc-by-4.0"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": ["cc-by-sa-3.0"],
        "SPDX-License-Identifier: MIT": ["mit"], "# SPDX-License-Identifier: Apache-2.0": ["apache-2.0"], "// SPDX-License-Identifier: GPL-2.0-or-later": ["gpl-2.0"], "SPDX-License-Identifier: Zlib": ["zlib"],
        "MIT License": ["mit"], "Licensed under CC-BY-4.0": ["cc-by-4.0"], "GPL v3": ["gpl-3.0"], "GPLv2 applies": ["gpl-2.0"], "LGPL-2.1": ["lgpl-2.1"], "Apache License 2.0": ["apache-2.0"], "Apache License, Version 2.0": ["apache-2.0"], "CC0 1.0 Universal": ["cc0-1.0"],
        "Licensed under CC BY 3.0 and CC BY 4.0.": ["cc-by-3.0", "cc-by-4.0"],
        "Not released under the MIT License.": [], "It is not MIT License.": [], "modified MIT License": [], "They did not. Released under the MIT License.": ["mit"], "It is never, ever licensed under CC BY 4.0.": [],
        "The MIT people have a License": [], "the Apache License was made before 2.0": [], "CC by 4.0 today": ["cc-by-4.0"], "GPL, then v3": [], "SPDX-License-Identifier: Proprietary": [],
    }
    for text, want in wanted.items():
        assert names(text) == want, (text, names(text))
    assert names(licenses._UNLICENSE) == ["unlicense"] and names(licenses._ZLIB.replace("original", "first")) == ["zlib"] and names("x " * 99 + licenses._BSL) == ["bsl-1.0"]
    assert licenses.templates_of(licenses.template_table(spark)) == licenses.TEMPLATES and len({t.name for t in licenses.TEMPLATES}) == len(licenses.TEMPLATES) > 150


def test_repeated_and_stretched_notices():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    spans = lambda text, name: [x[1:] for x in scanner.scan(text) if x[0].name == name]
    for name in ("mit", "apache-2.0", "gpl-3.0", "mit-text", "gpl-3.0-header"):
        t, n = NOTICES[name], len(licenses.words(NOTICES[name]))
        for gap in (0, 1, 3, 400):
            text = (t + " " + "q " * gap) * 5
            assert spans(text, name) == [(n, n, k * (n + gap), k * (n + gap) + n) for k in range(5)], (name, gap)
        for every in (1, 2):  # foreign words after each, or after every second
            ws = licenses.words(t)
            long_ = b" ".join(w + (b" q%d" % i if i % every == 0 else b"") for i, w in enumerate(ws)).decode()
            width = n + (n - 1 + every - 1) // every
            got = spans("x " * 37 + long_ + " y" * 300, name)
            assert [x[2] for x in got] == [37] and got[0][0] >= 0.95 * n and abs(got[0][3] - 37 - width) <= 1, (name, every, got)


def test_alignment_is_monotone_and_equal():
    import random

    r = random.Random(4)
    for _ in range(300):
        a = [r.choice("abcdefghij") for _ in range(r.randrange(30))]
        b = [r.choice("abcdefghij") for _ in range(r.randrange(30))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    for _ in range(300):
        ys = r.sample(range(40), r.randrange(9))
        best = max((len(c) for n in range(len(ys) + 1) for c in combinations(ys, n) if list(c) == sorted(c)), default=0)
        own = [ys[i] for i in licenses.increasing(ys)]
        assert len(own) == best and own == sorted(own)
    for _ in range(200):  # where every word is unique the alignment is a longest one
        a, b = r.sample("abcdefghijklmnop", 12), r.sample("abcdefghijklmnop", 12)
        longest = [[0] * 13 for _ in range(13)]
        for i in range(12):
            for j in range(12):
                longest[i + 1][j + 1] = longest[i][j] + 1 if a[i] == b[j] else max(longest[i][j + 1], longest[i + 1][j])
        assert len(licenses.align(a, b)) == longest[12][12]


def test_edited_texts_in_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    got = queries.edited_texts(spark, f"{DATA}/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(oracles.EDITED).fetchall())
    assert {(r["doc_id"], r["edited_sha256"]) for r in got} == {(r["doc_id"], r["edited_sha256"]) for r in queries.op6_scaled_sketch(spark, f"{DATA}/sf0.001").collect()}
