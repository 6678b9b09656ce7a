"""Token ids in canonical length-limited Huffman blocks.

Code lengths come from the global id counts by package-merge with a limit of ``LIMIT`` bits;
codes are canonical, so the lengths alone are the code book.  A file is a Parquet table of
independent blocks of whole documents: a block's bits, the bit offset of every
``STRIDE``-th id (checkpoints), and its documents' ids and lengths.  A reader decodes all
stretches between checkpoints side by side, one table lookup per id.

Edge cases: a null or empty text has only the end id; null ids come first; repeated ids keep
their order by text; an id beyond every count cannot be encoded and raises; an empty table
gives empty files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release, sized
from .tokens import binaries, numbers

LIMIT = 18
STRIDE = 256
BLOCK = 1 << 18
_U = np.uint64


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most limit bits (0 for ids that do not occur)."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    if n <= 1:
        out[used] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    packages, is_leaf = np.zeros(0, np.int64), []
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        order = np.argsort(merged, kind="stable")
        is_leaf.append(order < n)
        merged = merged[order]
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):
        chosen = int(flags[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out[used] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code of each id: by length, then by id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    per = np.bincount(lengths[order], minlength=1)
    i = 0
    for bits in range(1, len(per)):
        code <<= bits - last
        last = bits
        codes[order[i : i + per[bits]]] = np.arange(code, code + per[bits], dtype=np.uint64)
        code += int(per[bits])
        i += per[bits]
    return codes


def decode_table(lengths: np.ndarray):
    """(id, length) for every prefix of the longest code's bits."""
    width = int(lengths.max(initial=1))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    fill = np.int64(1) << (width - lengths[order].astype(np.int64))
    ids, bits = np.repeat(order, fill).astype(np.uint32), np.repeat(lengths[order], fill)
    rest = (1 << width) - len(ids)
    return np.r_[ids, np.zeros(rest, np.uint32)], np.r_[bits, np.ones(rest, np.uint8)], width


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """(bits as big-endian 64-bit words, checkpoints as uint64)."""
    n = lengths[ids].astype(np.int64)
    if len(n) and not n.all():
        raise ValueError("an id has no code")
    ends = np.cumsum(n)
    begin = ends - n
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros((total + 63) // 64 + 1, np.uint64)
    if len(ids):
        code, word = codes[ids], begin >> 6
        shift = 64 - (begin & 63) - n
        here = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
        edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[edge]] = np.bitwise_or.reduceat(here, edge)
        over = np.flatnonzero(shift < 0)
        words[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), begin[::STRIDE].astype(np.uint64).tobytes()


def decode_block(bits: bytes, checkpoints: bytes, n: int, table) -> np.ndarray:
    ids, lens, width = table
    words = np.r_[np.frombuffer(bits, ">u8").astype(np.uint64), np.zeros(1, np.uint64)]
    at = np.frombuffer(checkpoints, np.uint64).copy()
    out = np.zeros((len(at), STRIDE), np.uint32)
    last = n - (len(at) - 1) * STRIDE
    for step in range(STRIDE if len(at) > 1 else last):
        if step == last:
            at = at[:-1]  # the last stretch is the only short one
        word, bit = (at >> _U(6)).astype(np.int64), at & _U(63)
        top = (words[word] << bit) | (words[word + 1] >> _U(1) >> (_U(63) - bit))
        key = (top >> _U(64 - width)).astype(np.int64)
        out[: len(at), step] = ids[key]
        at = at + lens[key]
    return out.ravel()[:n]


_BLOCKS = "part int, at long, n long, doc_ids binary, doc_lens binary, checkpoints binary, bits binary"
_BLOCK_SCHEMA = pa.schema([(x.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in _BLOCKS.split(", ")])


#: Stands for a null id in a block.
_NULL = -(1 << 63)


def write_blocks(ids: DataFrame, lengths: np.ndarray, block: int = BLOCK) -> DataFrame:
    """Writes the files (uncompressed Parquet: the bits are coded already) and returns them as read back.

    File k, in the order of names, holds part k, its blocks in order, so ids ascend through the files.
    """
    sizes = lengths.tobytes()

    def run(batches):
        lens = np.frombuffer(sizes, np.uint8)
        codes = canonical(lens)
        held, part, at, n = [], None, 0, 0

        def row():
            flat, docs, own = (np.concatenate(x) for x in zip(*held))
            bits, marks = encode_block(flat, lens, codes)
            values = (part, at, n, docs.tobytes(), own.tobytes(), marks, bits)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA)

        for batch in batches:
            parts, ats = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            docs = pc.fill_null(batch.column(2), _NULL).to_numpy()
            flat, edge = numbers(batch.column(3))
            own = np.diff(edge)
            stops = np.r_[np.flatnonzero((parts[1:] != parts[:-1]) | (ats[1:] != ats[:-1] + own[:-1])) + 1, len(docs)]
            i = 0
            while i < len(docs):
                if held and (parts[i] != part or ats[i] != at + n or n >= block):
                    yield row()
                    held, n = [], 0
                if not held:
                    part, at = int(parts[i]), int(ats[i])
                full = max(int(np.searchsorted(edge, edge[i] + block - n)), i + 1)
                j = min(int(stops[np.searchsorted(stops, i, "right")]), full)
                held.append((flat[edge[i] : edge[j]], docs[i:j], own[i:j]))
                n += int(edge[j] - edge[i])
                i = j
        if held:
            yield row()
        release()

    rows = ids.where("seq >= 0").select("part", "at", "doc_id", "ids").mapInArrow(run, _BLOCKS)
    files = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(rows.repartitionById(files, F.col("part")).sortWithinPartitions("part", "at"), "huffman", codec="none")


def write_code_book(spark, lengths: np.ndarray) -> DataFrame:
    rows = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    return materialize(spark.createDataFrame(rows, "id int, length int").coalesce(1), "code-book")


def read_blocks(files: DataFrame, book: DataFrame) -> DataFrame:
    """(part, at, doc_id, ids): the files decoded; the book has at most one row per id of the vocabulary."""
    rows = book.collect()
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["length"]
    sizes = lengths.tobytes()

    def run(batches):
        table = decode_table(np.frombuffer(sizes, np.uint8))
        for batch in batches:
            for part, at, n, docs, lens, marks, bits in zip(*(c.to_pylist() for c in batch.columns)):
                ids = decode_block(bits, marks, n, table)
                docs, lens = np.frombuffer(docs, np.int64), np.frombuffer(lens, np.int64)
                edge = np.r_[0, np.cumsum(lens)]
                for i in range(0, len(docs), 256):
                    j = min(i + 256, len(docs))
                    known = pa.array(docs[i:j], mask=docs[i:j] == _NULL)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(j - i, part, np.int32)), pa.array(at + edge[i:j]), known, binaries(ids[edge[i] : edge[j]], edge[i : j + 1] - edge[i])], ["part", "at", "doc_id", "ids"])
        release()

    return files.mapInArrow(run, "part int, at long, doc_id long, ids binary")


def file_bases(files: DataFrame) -> DataFrame:
    """(part, base): ids before each part, from the blocks of the files alone."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n").alias("n"))
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, start, ids: the corpus encoded, written in ascending doc_id order and read back."""
    from .streams import encoded, id_counts

    ids = encoded(docs, path, end_id)
    lengths = code_lengths(id_counts(ids))
    files, book = write_blocks(ids, lengths), write_code_book(docs.sparkSession, lengths)
    return read_back(files, book)


def read_back(files: DataFrame, book: DataFrame) -> DataFrame:
    """doc_id, start, ids from the files and the code book alone."""
    base = materialize(file_bases(files), "bases")
    return read_blocks(files, book).join(sized(base, 32), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "ids")
