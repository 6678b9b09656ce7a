"""Mixture-controlled packing by deficit round-robin.

Sources are queues of token ids in doc_id order; a source's target is its part of all ids,
so the queues run dry together and nothing is left over.  Every window of ``WINDOW`` ids
credits each queue with its target; queues are served in turn while they are in credit, at
least GRAIN ids at a time, a document being cut at a window's end.  What a queue got too
much or too little is carried to the next window.

Windows are packed in groups of ``GROUP``.  The ids a group takes of each queue are fixed
beforehand: ids of all queues are ranked by (position + 1/2) / queue length, and group g
takes ranks [g, g + 1) * GROUP * WINDOW.  So groups are packed in parallel, each is full to
the last id (only the very last window of all can be short), and a group starts with the
deficit that the exact target leaves at its first rank.

Edge cases: a null or empty text is its end id alone; a null source is a queue of its own;
null and repeated doc_ids are packed row by row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .streams import encoded, placed

WINDOW = 2048
GROUP = 512
GRAIN = 128
_ONE = 1 << 80


class Shares:
    """The exact split of the first x ranks among queues of given lengths."""

    def __init__(self, lengths: dict[str, int]):
        self.names = sorted(lengths)
        self.n = [lengths[q] for q in self.names]
        self.total = sum(self.n)
        self._memo: dict[int, dict[str, int]] = {}

    def _at(self, m: int) -> list[int]:
        return [min(k, (2 * k * m + _ONE) // (2 * _ONE)) for k in self.n]

    def upto(self, x: int) -> dict[str, int]:
        """Per queue, how many of its ids are among the first x ranks; grows with x in each queue."""
        if x >= self.total:
            return dict(zip(self.names, self.n))
        if x not in self._memo:
            lo, hi = 0, _ONE
            while hi - lo > 1:  # the largest point whose ids do not exceed x
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if sum(self._at(mid)) <= x else (lo, mid)
            have, more = self._at(lo), self._at(hi)
            left = x - sum(have)
            for i in range(len(have)):  # ties in the order of names
                step = min(left, more[i] - have[i])
                have[i] += step
                left -= step
            if len(self._memo) > 4096:
                self._memo.clear()
            self._memo[x] = dict(zip(self.names, have))
        return self._memo[x]


def fill(queues: dict[str, list], shares: Shares, x: int, window: int, grain: int):
    """Deficit round-robin over one group that starts at rank x.

    queues: name -> documents or parts of them, (row, ids) in order.  Yields (window number in
    the group, offset, row, from, ids).
    """
    start = shares.upto(x)
    names = [q for q in shares.names if queues.get(q)]
    weight = {q: k / shares.total for q, k in zip(shares.names, shares.n)}
    owed = {q: weight[q] * x - start[q] for q in names}
    left = {q: sum(n for _, n in queues[q]) for q in names}
    head = {q: [0, 0] for q in names}  # document, ids of it served
    number, turn, total = 0, 0, sum(left.values())
    while total:
        for q in names:
            owed[q] += weight[q] * window
        room = offset = 0
        room = min(window, total)
        idle = 0
        while room:
            q = names[turn % len(names)]
            if left[q] and (owed[q] > 0 or idle >= len(names)):
                place = head[q]
                row, n = queues[q][place[0]]
                take = min(n - place[1], room, max(int(owed[q]), grain))
                yield number, offset, row, place[1], take
                place[1] += take
                if place[1] == n:
                    head[q] = [place[0] + 1, 0]
                owed[q] -= take
                left[q] -= take
                total -= take
                room -= take
                offset += take
                idle = 0
                if owed[q] > 0 and left[q]:
                    continue
            else:
                idle += 1
            turn += 1
        number += 1


def pack(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, group: int = GROUP, grain: int = GRAIN) -> DataFrame:
    """Pieces: sequence_id, offset, doc_id, queue, start (in the document), length, doc_tokens, ids (uint32)."""
    queue = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))
    ids = encoded(docs, path, end_id, queue)
    # One row per source.
    lengths = {r["queue"]: int(r["n"]) for r in ids.where("seq = -1").groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    span = window * group

    def deal(batches):
        shares = Shares(lengths)
        schema = pa.schema([("g", pa.int64()), ("queue", pa.string()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            out = []
            for q, pos, doc, x in zip(*(c.to_pylist() for c in batch.columns)):
                n, done = len(x) // 4, 0
                g = pos * shares.total // (lengths[q] * span)
                while g and shares.upto(g * span)[q] > pos:
                    g -= 1
                while done < n:
                    edge = shares.upto((g + 1) * span)[q]
                    if edge > pos + done:
                        take = min(n, edge - pos) - done
                        out.append((g, q, pos + done, doc, done, n, x[4 * done : 4 * (done + take)]))
                        done += take
                    g += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

    def fold(key, table):
        shares, g = Shares(lengths), key[0].as_py()
        table = table.sort_by([("queue", "ascending"), ("pos", "ascending")]).combine_chunks()
        cols = [table.column(c).to_pylist() for c in ("queue", "doc_id", "start", "doc_tokens", "ids")]
        queues: dict[str, list] = {}
        for i, (q, x) in enumerate(zip(cols[0], cols[4])):
            queues.setdefault(q, []).append((i, len(x) // 4))
        out = [
            (g * group + number, offset, cols[1][i], cols[0][i], cols[2][i] + frm, take, cols[3][i], cols[4][i][4 * frm : 4 * (frm + take)])
            for number, offset, i, frm, take in fill(queues, shares, g * span, window, grain)
        ]
        names = ["sequence_id", "offset", "doc_id", "queue", "start", "length", "doc_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, zip(*out), kinds)})

    pieces = placed(ids).select("queue", "start", "doc_id", "ids").mapInArrow(deal, "g long, queue string, pos long, doc_id long, start long, doc_tokens long, ids binary")
    return pieces.groupBy("g").applyInArrow(fold, "sequence_id long, offset long, doc_id long, queue string, start long, length long, doc_tokens long, ids binary")
