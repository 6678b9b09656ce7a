"""Runs of repeated words: maximal stretches of a text that repeat with some period at least four times over.

Common extensions come from a difference cover modulo 7: only suffixes that start at cover
places (3 words in 7) are sorted, by blocks of 7 words and then by doubling the ranks; any two
places reach cover places within 6 words, which are compared one by one, and from there
the extension is a minimum over neighbours' shared words, by a sparse table.  The same on the
reversed words extends to the left.

Runs are enumerated on a harmonic grid: a run of period p and length >= max(6, 4 * p) has as many
matches of words p apart as the grid of p is wide, so one grid place per max(6, 4 * p) - p words finds
it, n * log(n) / 3 places in all.  A stretch found with several periods counts with the least, which is then its
smallest period.

Documents of a slice are worked on side by side, with blank places between them, in numpy inside the
tasks that read them; nothing is shuffled, and a task holds one slice (one text at least).

Edge cases: a null or empty text has no words, no runs and an empty collapsed text; null ids, repeated rows and
further columns of any name pass through in the struct `doc`; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .hashing import ragged

#: A run has this many words, and this many times its period, at least.
LEAST_WORDS, LEAST_TURNS = 6, 4
#: A cover modulo V: every difference modulo V is one of two of its members.
V, COVER = 7, (0, 1, 3)
#: Text bytes worked on at once, and grid places.
SLICE, PLACES = 4 << 20, 1 << 20

_RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
_SYNC = np.array([[next(h for h in range(V) if (i + h) % V in COVER and (j + h) % V in COVER) for j in range(V)] for i in range(V)])


class Extensions:
    """Common extensions of places of the same document, in words laid out with V blanks (0) around every document."""

    def __init__(self, x: np.ndarray, base: np.ndarray, n: np.ndarray):
        """base and n: where the documents begin in x, and their numbers of words."""
        self.x = x
        at = ragged(base, n)
        doc, end = np.repeat(np.arange(len(n)), n), np.repeat(base + n, n)
        some = np.isin(at % V, COVER)
        self.at, doc, self.end = at[some], doc[some], end[some]
        self.of = np.full(len(x), -1, np.int64)  # place -> sample
        self.of[self.at] = np.arange(len(self.at))
        self._sort(doc)
        self._neighbours(doc)

    def _sort(self, doc: np.ndarray) -> None:
        """rank of each sample's suffix inside its document's stretch of ranks; ranks by 7, 14, 28 ... words in by_words."""
        m, x, at = len(self.at), self.x, self.at
        bits = max(1, int(x.max()).bit_length())
        a_key = max(1, 62 // bits)
        keys = [doc]
        for lo in range(0, V, a_key):
            key = np.zeros(m, np.int64)
            for k in range(lo, min(V, lo + a_key)):
                key = key << bits | x[at + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(m, bool)
        new[:1] = True
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(m, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(m), 0))
        self.by_words, words = [rank], V
        while True:
            size = np.bincount(rank, minlength=m)[rank]
            tied = np.flatnonzero(size > 1)
            if not len(tied):
                break
            ahead = at[tied] + words
            after = np.where(ahead < self.end[tied], rank[self.of[np.minimum(ahead, len(x) - 1)]], -1)
            order = np.lexsort((after, rank[tied]))
            tied, after, group = tied[order], after[order], rank[tied][order]
            step = np.arange(len(tied))
            first = np.r_[True, group[1:] != group[:-1]]
            new = first | np.r_[True, after[1:] != after[:-1]]
            place = group + step - np.maximum.accumulate(np.where(first, step, 0))
            rank = rank.copy()
            rank[tied] = np.maximum.accumulate(np.where(new, place, 0))
            self.by_words.append(rank)
            words *= 2
        self.rank = rank

    def _neighbours(self, doc: np.ndarray) -> None:
        """levels[0]: words that each suffix shares with the one ranked before it; levels[k]: the least of 2**k of them."""
        m = len(self.at)
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        shared = np.zeros(m, np.int64)
        pair = np.flatnonzero(doc[order[1:]] == doc[order[:-1]]) + 1
        a, b = order[pair - 1], order[pair]
        for k in range(len(self.by_words) - 1, -1, -1):
            live = np.flatnonzero((a >= 0) & (b >= 0))
            same = live[self.by_words[k][a[live]] == self.by_words[k][b[live]]]
            words = V << k
            shared[pair[same]] += words
            for side in (a, b):
                ahead = self.at[side[same]] + words
                side[same] = np.where(ahead < self.end[side[same]], self.of[np.minimum(ahead, len(self.x) - 1)], -1)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        shared[pair[live]] += agree(self.x, self.at[a[live]], self.at[b[live]], np.full(len(live), V))
        self.by_words = []
        self.levels = [shared.astype(np.int32)]
        most = int(np.bincount(doc).max()) if m else 0
        while 2 << (len(self.levels) - 1) <= most:
            t, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(t[:-half], t[half:]))

    def of_pairs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the stretches from i and from j have in common (i < j, i in the document, j at its end at most)."""
        to = _SYNC[i % V, j % V]
        out = agree(self.x, i, j, to)
        on = np.flatnonzero((out == to) & (self.x[j + to] != 0))
        a, b = (self.rank[self.of[side[on] + to[on]]] for side in (i, j))
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            q = np.flatnonzero(level == k)
            t = self.levels[k]
            out[on[q]] += np.minimum(t[lo[q]], t[hi[q] - (1 << int(k)) + 1])
        return out


def agree(x: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int = 1) -> np.ndarray:
    """Words from i and j on (to the left for step -1) that are equal, up to most, compared one by one."""
    out = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    for k in range(int(most.max()) if len(most) else 0):
        live = live[(k < most[live]) & (x[i[live] + step * k] == x[j[live] + step * k])]
        if not len(live):
            break
        out[live] += 1
    return out


def _grid(n: np.ndarray):
    """(document, place, period) of the grids of all documents, by about PLACES places."""
    by = np.argsort(-n, kind="stable")
    longest = n[by]
    top = int(longest[0]) // LEAST_TURNS if len(n) else 0
    periods = np.arange(1, top + 1)
    least = np.maximum(LEAST_WORDS, LEAST_TURNS * periods)
    fit = np.searchsorted(-longest, -least, "right")  # documents of so many words, the longest first
    total = np.r_[0, np.cumsum(n)[-1] // np.maximum(1, least - periods) + fit] if top else np.zeros(1, np.int64)
    block = np.cumsum(total)[1:] // PLACES
    for lo in (np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if top else ()):
        hi = int(np.searchsorted(block, block[lo], "right"))
        own = np.repeat(np.arange(lo, hi), fit[lo:hi])
        doc = by[ragged(np.zeros(hi - lo, np.int64), fit[lo:hi])]
        p, wide = periods[own], (least - periods)[own]
        places = -(-(n[doc] - p) // wide)
        turn = ragged(np.zeros(len(places), np.int64), places)
        yield np.repeat(doc, places), turn * np.repeat(wide, places), np.repeat(p, places)


def find_runs(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs, by document, start and period.

    words: numbers (from 1) of the words of all documents end to end; n: how many each has.
    """
    def laid(docs):
        base = V + np.cumsum(n[docs] + V) - n[docs] - V
        x = np.zeros(int((n[docs] + V).sum()) + V, np.int64)
        x[ragged(base, n[docs])] = words[ragged(first[docs], n[docs])]
        return x, base

    first = np.cumsum(n) - n
    x, base = laid(np.arange(len(n)))
    done, open_ = [], []
    for doc, g, p in _grid(n):
        i = base[doc] + g
        some = x[i] == x[i + p]
        doc, g, p, i = doc[some], g[some], p[some], i[some]
        limit = np.full(len(doc), V)
        right, left = agree(x, i, i + p, limit), agree(x, i - 1, i - 1 + p, limit, -1)
        more = (right == V) | (left == V)
        whole = ~more & (right + left + p >= np.maximum(LEAST_WORDS, LEAST_TURNS * p))
        done.append(np.stack([doc, g - left, right + left + p, p])[:, whole])
        open_.append(np.stack([doc, g, p, right, left])[:, more])
    if open_ and sum(o.shape[1] for o in open_):
        doc, g, p, right, left = np.concatenate(open_, 1)
        docs, sub = np.unique(doc, return_inverse=True)
        x, base = laid(docs)
        i = base[sub] + g
        for step, have in ((1, right), (-1, left)):
            some = np.flatnonzero(have == V)
            if step < 0:  # the words from right to left: what stands at i is at len(x) - 1 - i
                x, base = x[::-1].copy(), len(x) - base - n[docs]
                i = len(x) - i - p  # of the place left of i + p; the place left of i comes p later
            at = Extensions(x, base, n[docs])
            for lo in range(0, len(some), PLACES):
                q = some[lo : lo + PLACES]
                have[q] += at.of_pairs(i[q] + V, i[q] + p[q] + V)
        some = right + left + p >= np.maximum(LEAST_WORDS, LEAST_TURNS * p)
        done.append(np.stack([doc, g - left, right + left + p, p])[:, some])
    if not done:
        return (np.zeros(0, np.int64),) * 4
    doc, start, length, p = np.concatenate(done, 1)
    by = np.lexsort((p, length, start, doc))
    doc, start, length, p = doc[by], start[by], length[by], p[by]
    least = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(doc)]
    doc, start, length, p = doc[least], start[least], length[least], p[least]
    by = np.lexsort((p, start, doc))
    return doc[by], start[by], length[by], p[by]


def _best(runs: list[tuple[int, int, int]]):
    """The run of the greatest length / period, compared exactly; of equal ones the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _slice(texts: list[bytes | None]):
    """Per text: number of words, runs, best run, the words kept joined by one space."""
    split = [(t or b"").split() for t in texts]
    number = defaultdict(count(1).__next__)
    n = np.array([len(w) for w in split], np.int64)
    words = np.fromiter((number[w] for own in split for w in own), np.int64, int(n.sum()))
    doc, *found = find_runs(words, n)
    edge = np.searchsorted(doc, np.arange(len(n) + 1))
    runs = list(zip(*(f.tolist() for f in found)))
    for k, own in enumerate(split):
        mine = runs[edge[k] : edge[k + 1]]
        if mine:
            gone = np.zeros(len(own) + 1, np.int64)
            np.add.at(gone, [s + p for s, _, p in mine], 1)
            np.add.at(gone, [s + length for s, length, _ in mine], -1)
            own = [w for w, out in zip(own, np.cumsum(gone)) if not out]
        yield int(n[k]), mine, _best(mine), b" ".join(own)


def runs(docs: DataFrame) -> DataFrame:
    """doc (a struct of the other columns of docs), n_words, runs (start, length, period; by start, then period),
    best (of the greatest length / period; ties: the first start, then the least period), collapsed (the words outside
    runs' repeated turns, joined by one space)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # A struct must have a field even where text is the only column.
    src = docs.select(F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias("doc"), F.col("`text`").cast("string").alias("text"))
    schema = T.StructType([src.schema["doc"]]).add("n_words", "long").add("runs", T.ArrayType(_RUN)).add("best", _RUN).add("collapsed", "string")
    kind = pa.struct([(f.name, pa.int64()) for f in _RUN])

    def work(batches):
        for batch in slices(batches, "text", SLICE):
            rows = list(_slice(batch.column(1).cast(pa.binary()).to_pylist()))
            n, own, best, kept = zip(*rows)
            flat = [r for mine in own for r in mine]
            run = lambda rs, mask=None: pa.StructArray.from_arrays([pa.array([r[k] for r in rs], pa.int64()) for k in range(3)], fields=list(kind), mask=mask)
            held = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in own])], pa.int32()), run(flat))
            tops = run([b or (0, 0, 0) for b in best], pa.array([b is None for b in best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), held, tops, pa.array(kept, pa.binary()).cast(pa.string())], ["doc", "n_words", "runs", "best", "collapsed"])

    return src.mapInArrow(work, schema)
