"""Token counts per section by offset-mapped attribution.

A document is encoded once, its sections together.  Byte-level ids spell their bytes, so the running sum of
the ids' byte lengths gives every token's span in the text, which is joined to the
sections' spans by binary search (a document's tokens never leave its row: no shuffle).
A token that crosses a section's edge is allocated by one of three rules:

* ``first``: to the section with its first byte;
* ``most``: to the section with over half of its bytes, at half to the one with its first;
* ``split``: to each section by its part of the bytes.

Over sections that tile the text each rule's counts add up to the document's tokens.

Sections are given as character spans; without any they are the text's lines.

Edge cases: a null or empty text has no lines, and given sections of it are empty; empty sections count nothing;
sections past the text are cut to it; a null list of sections gives no rows; null ids and repeated rows are counted row by
row; other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes
from .tokens import encoder

_OUT = "section int, lo long, hi long, doc_tokens long, n_first long, n_most long, n_split double"


def lines(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, each with its line break."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(raw[:-1] == 10) + 1
    return np.r_[0, cut], np.r_[cut, len(raw)]


def allocate(ends: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(first, most, split) counts of the tokens that end at ends (ascending bytes) in the spans [lo, hi)."""
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    first = np.searchsorted(starts, hi, "left") - np.searchsorted(starts, lo, "left")
    # Tokens that lie whole in a span, then the one or two that cross its edges.
    a = np.searchsorted(starts, lo, "left")
    b = np.maximum(np.searchsorted(ends, hi, "right"), a)
    whole = (b - a).astype(np.float64)
    most, split = whole.copy(), whole.copy()
    if len(ends):
        for at, there in ((a - 1, a > 0), (b, b < len(ends))):
            at = np.clip(at, 0, len(ends) - 1)
            size = ends[at] - starts[at]
            share = np.maximum(np.minimum(ends[at], hi) - np.maximum(starts[at], lo), 0) * there
            split += share / size
            most += (2 * share > size) | ((2 * share == size) & (share > 0) & (starts[at] >= lo) & (starts[at] < hi))
    return first, most.astype(np.int64), split


def attribute(docs: DataFrame, path: str, sections: str | None = None) -> DataFrame:
    """doc_id and, per section: section, lo, hi (characters), doc_tokens, n_first, n_most, n_split.

    sections: an array<struct<lo, hi>> column of character spans; without one, the lines.
    path: a byte-level tokenizer file; one whose ids do not spell the text's bytes raises ValueError.
    """
    given = F.col(sections) if sections else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), given.cast("array<struct<lo:bigint,hi:bigint>>").alias("sections"))

    def run(batches):
        enc = encoder(path)
        if not enc.spells_bytes:
            raise ValueError(f"{path}: attribution needs a byte-level tokenizer without a normalizer, whose ids spell the text")
        size = np.zeros(enc.tokenizer.get_vocab_size(), np.int64)
        for token, i in enc.tokenizer.get_vocab().items():
            size[i] = len(token)  # byte-level: a character of a token's name is a byte
        for batch in slices(batches, "text", 2 << 20):
            ids, edge = enc.encode(batch.column(1))
            all_raw, text_at = text_bytes(batch.column(1))
            ids_size = size[ids]
            out: list[list] = [[] for _ in range(8)]
            for i, (doc, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                raw = all_raw[text_at[i] : text_at[i + 1]]
                ends = np.cumsum(ids_size[edge[i] : edge[i + 1]])
                letters = np.flatnonzero((raw & 0xC0) != 0x80)
                if spans is None:
                    if sections:
                        continue
                    lo, hi = lines(raw)
                    at, to = np.searchsorted(letters, lo), np.searchsorted(letters, hi)
                else:
                    at, to = (np.clip([s[k] or 0 for s in spans], 0, len(letters)).astype(np.int64) for k in ("lo", "hi"))
                    to = np.maximum(at, to)
                    byte = np.r_[letters, len(raw)]
                    lo, hi = byte[at], byte[to]
                n = len(lo)
                for k, v in enumerate((np.arange(n), at, to, np.full(n, len(ends)), *allocate(ends, lo, hi))):
                    out[k + 1].append(v)
                out[0] += [doc] * n
            cols = [pa.array(out[0], pa.int64())]
            for v, t in zip(out[1:], (pa.int32(), *[pa.int64()] * 5, pa.float64())):
                cols.append(pa.array(np.concatenate(v) if v else np.zeros(0), t, safe=False))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "section", "lo", "hi", "doc_tokens", "n_first", "n_most", "n_split"])

    return rows.mapInArrow(run, f"doc_id long, {_OUT}")
