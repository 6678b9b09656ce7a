import json
import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import crc

from tokenizers import Tokenizer

from sparkmill.llm import attribution, huffman, packing
from sparkmill.llm.common import table, tokenizer_path
from sparkmill.llm.tokens import Encoder

DATA = "/root/testdata"
BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
ROWS = [(3, "b c d", "x", 1), (1, None, None, 2), (2, "", "y", 3), (5, "one two\nthree  four" * 900, "x", 4), (5, "one two", "x", 4), (None, "lost", None, None), (5, "one two", "x", 4)]
SCHEMA = "doc_id long, text string, source string, ids int"


def texts():
    r = random.Random(1)
    out = ["", " ", "\n", "a  b", "a\n\nb", "a \nb", "\ta b\t", "x　 y", "don't  stop 's", "a\x1cb \x1c c", "<|endoftext|> a", "é́ ΑΣ ΑΣ.", "a\0 b\0\nc", "ª. b, ²."]
    out += ["Straße! ÀÖØ?) Überraſchung;", "word%%% Word\".-- naïve:/ İ, aİ$ x́. ß@_ µª!", "l'été... l'ÉTÉ** don't, 'S. rock'n'roll!"]
    out += [" ".join("".join(r.choice("abcDEFüÉİ'") for _ in range(r.randrange(1, 8))) + "".join(r.choice(".,!%)'́<9") for _ in range(r.randrange(4))) for _ in range(8)) for _ in range(1500)]
    return out + ["".join(r.choice([" ", "\n", "a", "B", "1", "'s", ".", ",", "\t", "é", " ", "日", "\r", "\0"]) for _ in range(r.randrange(14))) for _ in range(4000)]


def plain(name):
    """The library's own tokenizer, nothing set."""
    return Tokenizer.from_file(tokenizer_path(name))


def same_as_library(enc, some, step):
    for i in range(0, len(some), step):
        ids, edge = enc.encode(pa.array(some[i : i + step]))
        want = [e.ids for e in enc.tokenizer.encode_batch_fast([x or "" for x in some[i : i + step]], add_special_tokens=False)]
        for x, lo, hi, own in zip(some[i : i + step], edge[:-1], edge[1:], want, strict=True):
            assert ids[lo:hi].tolist() == own, repr(x)


@pytest.mark.parametrize("name", [BYTE, WORD])
@pytest.mark.parametrize("memo", [24 << 20, 4000])
def test_pieces_equal_the_library(name, memo):
    enc = Encoder(tokenizer_path(name), memo)
    assert enc._cuts and enc._plain("a")
    same_as_library(enc, texts() + [None], 97)


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_every_letter_before_punctuation(name):
    enc = Encoder(tokenizer_path(name))
    some = [f"b{chr(c)}{mark} x{mark}{chr(c)}, {chr(c)}" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 for mark in (".&" if c < 0x3000 else ")")]
    same_as_library(enc, some if len(some) < 1 << 20 else [x for x in some if unicodedata.category(x[1])[0] in "LMZN" or ord(x[1]) < 0x3000], 20_000)


def test_scripts(spark):
    words = "হয়, বাড়ি হয়? बड़! क़&ख़ ਸ਼. ଡ଼; གྷ) שׁ, יִ! אַ) مرحبا، Привет, мир! Ελλάς. 日本語。 한국어! ไทย."
    for name in (BYTE, WORD):
        same_as_library(Encoder(tokenizer_path(name)), [words, *words.split(), words.replace(" ", "\u00a0"), words.replace(" ", " \u3000\n")], 4)


def test_white_space_of_all_kinds():
    r = random.Random(5)
    some = ["".join(r.choice([" ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u2028", "\u180e", "\u200b", "a", "é,", "1"]) for _ in range(r.randrange(9))) for _ in range(20_000)]
    for name in (BYTE, WORD):
        same_as_library(Encoder(tokenizer_path(name)), some, 500)


def test_other_settings_get_whole_texts(tmp_path):
    made = json.loads(Encoder(tokenizer_path(BYTE)).tokenizer.to_str())
    made["normalizer"] = {"type": "NFKC"}
    (tmp_path / "other.json").write_text(json.dumps(made))
    enc = Encoder(str(tmp_path / "other.json"))
    assert enc._cuts is None
    same_as_library(enc, texts()[:500] + [None], 50)


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_added_tokens_in_texts_are_what_the_library_makes_of_them(name):
    enc, t, r = Encoder(tokenizer_path(name)), plain(name), random.Random(7)
    held = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", " ", "\n", "a", " b,", "é.", "x<"]
    some = ["".join(r.choice(held) for _ in range(r.randrange(12))) for _ in range(5000)] + [None, "", "<|endoftext|>"]
    for i in range(0, len(some), 61):
        ids, edge = enc.encode(pa.array(some[i : i + 61]))
        for x, lo, hi in zip(some[i : i + 61], edge[:-1], edge[1:], strict=True):
            assert ids[lo:hi].tolist() == t.encode(x or "", add_special_tokens=False).ids, repr(x)


def test_attribution_refuses_other_files(spark):
    docs = spark.createDataFrame([(1, "Hello big world, hello")], "doc_id long, text string")
    with pytest.raises(Exception, match="needs a byte-level tokenizer"):
        attribution.attribute(docs, tokenizer_path(WORD)).collect()


def test_rare_pieces_leave_the_memory():
    enc = Encoder(tokenizer_path(WORD), 10_000)
    for i in range(300):
        enc.encode(pa.array([f"often {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}"]))
        assert len(enc._young) + len(enc._old) < 100
    assert "often" in enc._young or "often" in enc._old


def whole(rows, name, end):
    t = plain(name)
    return [(i, [*t.encode(x or "", add_special_tokens=False).ids, end]) for i, x in rows]


def test_code_lengths_are_limited_and_complete():
    r = np.random.default_rng(2)
    for n, limit in ((1, 4), (2, 4), (16, 4), (1000, 10), (1000, 18), (5000, 13)):
        counts = (r.pareto(0.5, n) * 10 + 1).astype(np.int64)
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and lengths.min() >= 1
        if n > 1:
            assert sum(2.0 ** -float(x) for x in lengths) == 1
        ids = r.choice(n, 3000, p=counts / counts.sum())
        bits, marks = huffman.encode_block(ids, lengths, huffman.canonical(lengths))
        assert (huffman.decode_block(bits, marks, len(ids), huffman.decode_table(lengths)) == ids).all()


@pytest.mark.parametrize("given", ["rows", "table", "none"])
def test_files_read_back(spark, given):
    docs = spark.createDataFrame(ROWS if given == "rows" else [], SCHEMA) if given != "table" else table(spark, f"{DATA}/sf0.001", "documents")
    got = [(r["doc_id"], r["start"], len(r["ids"]) // 4, zlib.crc32(r["ids"])) for r in huffman.round_trip(docs, tokenizer_path(BYTE), 2).collect()]
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for i, ids in whole(rows, BYTE, 2):
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(got, key=lambda x: x[1]) == want


def test_files_hold_ascending_ids(spark, monkeypatch):
    held = []
    monkeypatch.setattr(huffman, "write_blocks", lambda *x, w=huffman.write_blocks: held.append(w(*x)) or held[0])
    docs = table(spark, f"{DATA}/sf0.01", "documents").repartition(5)
    huffman.round_trip(docs, tokenizer_path(BYTE), 2).count()
    names = sorted(f.removeprefix("file:") for f in held[0].inputFiles())
    ids = [i for f in names for b in pq.read_table(f).column("doc_ids").to_pylist() for i in np.frombuffer(b, np.int64).tolist()]
    assert len(names) > 2 and len(ids) == docs.count() and ids == sorted(ids)


def test_small_blocks_and_broken_runs(spark):
    from sparkmill.llm.tokens import binaries

    r = np.random.default_rng(4)
    lens = r.integers(0, 9, 300)
    flat = r.integers(0, 50, lens.sum()).astype(np.uint32)
    edge = np.r_[0, np.cumsum(lens)]
    rows = [(i // 100, i, int(edge[i] - edge[i // 100 * 100]), None if i % 50 == 0 else i, bytes(x)) for i, x in enumerate(binaries(flat, edge).to_pylist())]
    ids = spark.createDataFrame(rows, "part int, seq long, at long, doc_id long, ids binary").coalesce(1)
    lengths = huffman.code_lengths(np.bincount(flat, minlength=50))
    files, book = huffman.write_blocks(ids, lengths, 20), huffman.write_code_book(spark, lengths)
    got = sorted((x["part"], x["at"], len(x["ids"]), x["doc_id"] or -1, bytes(x["ids"])) for x in huffman.read_blocks(files, book).collect())
    assert got == sorted((p, at, len(x), i or -1, x) for p, _, at, i, x in rows)


def test_starts_come_from_the_files(spark, monkeypatch):
    held = []
    monkeypatch.setattr(huffman, "write_blocks", lambda *x, w=huffman.write_blocks: held.append(w(*x)) or held[0].where(f"part <> {first(held[0])}"))
    first = lambda files: min(r["part"] for r in files.select("part").collect())
    docs = table(spark, f"{DATA}/sf0.001", "documents")
    got = sorted((r["start"], len(r["ids"]) // 4) for r in huffman.round_trip(docs, tokenizer_path(BYTE), 2).collect())
    lost = sum(r["n"] for r in held[0].where(f"part = {first(held[0])}").collect())
    assert lost and got[0][0] == 0  # ids of a block that is not there are not counted
    assert all(a + n == b for (a, n), (b, _) in zip(got, got[1:]))


@pytest.mark.parametrize("given,group", [("rows", 2), ("table", 8), ("none", 8)])
def test_packing(spark, given, group):
    docs = spark.createDataFrame(ROWS if given == "rows" else [], SCHEMA) if given != "table" else table(spark, f"{DATA}/sf0.001", "documents")
    got = packing.pack(docs, tokenizer_path(WORD), 1, group=group).collect()
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
        assert len(r["ids"]) == 4 * r["length"]
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 2048 or rows[0]["sequence_id"] == max(by_seq)
    want = {}
    for i, ids in whole([(r["doc_id"], r["text"]) for r in docs.collect()], WORD, 1):
        want.setdefault(i, []).append(ids)
    for i, many in want.items():
        if len(many) == 1:
            pieces = sorted(by_doc[i], key=lambda r: r["start"])
            assert b"".join(r["ids"] for r in pieces) == np.array(many[0], "<u4").tobytes()
        assert sum(r["length"] for r in by_doc[i]) == sum(map(len, many))
    assert set(by_doc) == set(want)
    if given == "table":
        total = sum(r["length"] for r in got)
        share = {}
        for r in got:
            share[r["queue"]] = share.get(r["queue"], 0) + r["length"]
        for rows in by_seq.values():  # every window is near its target
            for q, n in share.items():
                have = sum(r["length"] for r in rows if r["queue"] == q)
                assert abs(have - 2048 * n / total) <= 3 * packing.GRAIN + 64


def test_attribution(spark):
    rows = [(1, "abc def\n\nghi", [(0, 5), (5, 12), (3, 3), (4, 400)]), (2, None, [(0, 4)]), (3, "日本語 text", [(0, 1), (1, 2), (2, 9)]), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, s array<struct<lo:long,hi:long>>")
    got = {(r["doc_id"], r["section"]): r for r in attribution.attribute(docs, tokenizer_path(BYTE), "s").collect()}
    t = plain(BYTE)
    for i, text, sections in rows:
        text = text or ""
        e = t.encode(text, add_special_tokens=False)
        at, tokens = 0, []
        size = {v: len(k) for k, v in t.get_vocab().items()}
        for x in e.ids:
            tokens.append((at, at + size[x]))
            at += size[x]
        for k, (lo, hi) in enumerate(sections or []):
            lo, hi = (len(text[:v].encode()) for v in (lo, max(lo, hi)))
            r = got[i, k]
            over = [(max(0, min(b, hi) - max(a, lo)), b - a, lo <= a < hi) for a, b in tokens]
            assert r["n_first"] == sum(f for _, _, f in over)
            assert r["n_most"] == sum(2 * o > n or (2 * o == n and o > 0 and f) for o, n, f in over)
            assert abs(r["n_split"] - sum(o / n for o, n, _ in over)) < 1e-9
    docs = table(spark, f"{DATA}/sf0.001", "documents")
    sums = attribution.attribute(docs, tokenizer_path(BYTE)).groupBy("doc_id").agg({"n_first": "sum", "n_most": "sum", "doc_tokens": "max"}).collect()
    assert sums and all(r[1] == r[2] == r[3] for r in sums)


def test_attribution_of_the_query_and_its_edges(spark):
    from sparkmill.llm.queries import op1_sections

    long = "wörd, " * 40_000
    rows = [(1, long, "x"), (2, "a" * 1000, "x"), (2, "a" * 1000, "x"), (3, "b" * 1001, None), (4, "", "y"), (None, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sections string")
    got = op1_sections(docs).collect()
    t = plain(BYTE)
    for i, text, _ in rows:
        text = text or ""
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["section"])
        n = max(1, -(-len(text) // 1000))
        twins = sum(r[0] == i for r in rows)
        assert [(r["lo"], r["hi"]) for r in own] == sorted([(k * 1000, min((k + 1) * 1000, len(text))) for k in range(n)] * twins)
        total = len(t.encode(text, add_special_tokens=False).ids)
        assert {r["doc_tokens"] for r in own} == {total} and sum(r["n_first"] for r in own) == total * twins
    assert op1_sections(docs.limit(0)).collect() == []
