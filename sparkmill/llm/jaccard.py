"""Exact n-gram Jaccard join by T-occurrence search.

1. Signatures.  Sets of linked documents differ in at most 2 * size / 19 shingles (for 0.9),
   so if the hash range is cut into one more piece than that, some piece holds the same
   shingles in both.  A document sends a hash of each piece that is not empty, for both size
   classes that pairs of its size can share.  There are more pieces than differences by an
   eighth; a document with as many empty pieces as that also sends its prefix (its least
   hashes, of which two linked sets share one).  Sets that have a signature in common make up the group of its
   head, the least of them; a set is in the groups of all its heads, so every pair of linked sets is in a group
   together, and sets that only share a passage with one of a group stay out of it.  Copies are one set before that.
2. Parities.  In these groups sets are compared by their parities first: a bit for every one or two shingles, whether an odd
   number of them fall on it.  Two sets differ in at least as many shingles as bits, so no linked pair is lost, while sets that
   share a piece by chance differ in far too many.  The components of the pairs that remain are the groups of the search.
3. Search.  Only documents of these groups have their whole shingle sets shuffled, one
   per distinct set, once unless its group is cut.  Inside a group each document asks which earlier ones reach the
   overlap T: its longest inverted lists are set aside (DivideSkip; T - 1 of them, size by size, where the others are long as well), the heads of the short ones are
   merged, least head first, skipping ahead where too few agree, for documents that occur often enough to
   reach T with the long lists' help, and those are probed in the long lists by binary search.  The merges
   of many documents run side by side, their heads in one array.
4. Components of the links found.

Skew: copies collapse to one set; signatures are made distinct in every task before the
shuffle; a group of more than POSTINGS shingles is cut into blocks, by its work, and every two blocks meet in a task
of their own.  Candidates that are in a document's own component already are
not probed, so a large group of near copies costs a few probes per document; `all_links` probes them all.

Edge cases: null or empty texts have an empty set and no links; a null id takes part in no
link and has a null component; rows that repeat an id are one node, which joins the components of their texts;
other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, materialize, release, sized, slices, text_bytes
from .components import components
from .hashing import mix, prefixes, ragged, spans

#: Link where PERCENT * union <= 100 * intersection.
PERCENT = 90
WORDS = 3
#: Postings (shingles of all sets) in one search; a larger group meets block by block.
POSTINGS = 1 << 18
#: Heads of lists that are merged side by side; DivideSkip's weight of a probe.
CELLS = 1 << 18
MU = 0.1
#: Postings of a query's short lists for each of its shingles, above which each size of documents is asked for by itself.
LONG = 16
#: One more piece for so many: linked sets then share more pieces than are likely to be empty.
SPARE = 8
SPREAD = 4
FLUSH = 1 << 19
#: Sets with one signature among FLUSH signatures, above which one of them stands for all.
HOT = 64
#: Sets whose parities are compared in one task; the sets of a larger group are dealt to blocks, of which every two meet.
TOGETHER = 1 << 13
#: Words of parities that are compared at a time.
COMPARED = 1 << 20
#: Sets go by so many bits of their hashes when they are grouped; two sets of one name are only compared more often.
_NODE = (1 << 48) - 1

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5), _U(0x85EBCA77C2B2AE63)]


def shingle_sets(column: pa.Array, words: int = WORDS, percent: int = PERCENT):
    """Per text, the ascending distinct 64-bit hashes of its shingles."""
    raw, at = text_bytes(column)
    raw = _LOWER[raw]
    word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    lo = np.flatnonzero(word & (np.r_[True, ~word[:-1]] | edge[:-1])) if len(raw) else np.zeros(0, np.int64)
    hi = np.flatnonzero(word & (np.r_[~word[1:], True] | edge[1:])) + 1 if len(raw) else lo
    w = mix(spans(prefixes(raw), lo, hi) + (hi - lo).astype(np.uint64))
    place = [_U(int(_PLACE[k % 5]) * (2 * k + 1) & 0xFFFFFFFFFFFFFFFF) for k in range(words)]
    n = max(0, len(w) - words + 1)
    full = np.zeros(n, np.uint64)
    for k in range(words):
        full += w[k : k + n] * place[k]
    full = mix(full)
    first = np.searchsorted(lo, at)
    for i in range(len(at) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= words:
            yield np.unique(full[a : b - words + 1])
        elif b > a:
            yield mix(np.array([sum(int(w[a + k]) * int(place[k]) for k in range(b - a)) + (b - a) & 0xFFFFFFFFFFFFFFFF], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _classes(percent: int, most: int) -> list[int]:
    """Size classes: sizes that can be linked lie in one class or in two neighbours."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(edges[-1] * 100 // percent + 1)
    return [*edges, edges[-1] * 100 // percent + 1]


_EDGES: dict[int, list[int]] = {}


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes of which any two linked sets share one."""
    n = len(s)
    if not n:
        return s
    edges = _EDGES.get(percent)
    if edges is None or edges[-2] <= n:
        edges = _EDGES[percent] = _classes(percent, max(n, 1 << 16))
    own = int(np.searchsorted(edges, n, "right")) - 1
    mixed, out = mix(s + _PLACE[4]), []
    prefix = s[: n - -(-percent * n // 100) + 1]
    for level in {own, max(own - 1, 0)}:
        differ = 2 * (edges[level + 2] - 1) * (100 - percent) // (100 + percent)
        pieces = differ + 1 + differ // SPARE
        piece = (s >> _U(32)) * _U(pieces) >> _U(32)
        start = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
        at, class_ = piece[start], np.array([level], np.uint64)
        out.append(mix(np.add.reduceat(mixed, start) + at * _PLACE[0] + class_ * _PLACE[1]))
        if pieces - len(at) >= pieces - differ:  # all that is sure to agree may be empty in both
            out.append(mix(prefix ^ mix(class_ * _PLACE[3] + _U(1))))
    return np.concatenate(out)


def _parity_bytes(n: int) -> int:
    """The bytes of a set's parities: 1 to 2 bits a shingle, whole words of 64."""
    return max(64, 1 << (n - 1).bit_length()) // 8 if n else 0


def parities(s: np.ndarray) -> bytes:
    """For each value of the low bits of a shingle, whether an odd number of the set's have it.  Of two sets no more of them differ than shingles."""
    bits = 8 * _parity_bytes(len(s))
    count = np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) if bits else np.zeros(0, np.int64)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def plausible(n: np.ndarray, bits: list[bytes], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs that span the components of the graph of sets that may be linked, by their sizes (ascending) and parities."""
    of, pairs = np.arange(len(n)), []
    width = np.array([len(b) // 8 for b in bits])
    level = np.flatnonzero(np.r_[True, width[1:] != width[:-1], True]).tolist()
    for lo, hi in zip(level, level[1:]):
        end = int(np.searchsorted(n, 100 * n[hi - 1] // percent, "right"))
        words = [_words(bits[max(a, lo) : min(b, end)], int(width[lo])) for a, b in zip(level, level[1:]) if a >= lo and a < end]
        words = np.concatenate(words)
        step = max(1, COMPARED // words.size)
        for a in range(lo, hi, step):
            b = min(a + step, hi)
            z = int(np.searchsorted(n, 100 * n[b - 1] // percent, "right"))
            differ = np.bitwise_count(words[a - lo : b - lo, None] ^ words[None, a - lo : z - lo]).sum(axis=2, dtype=np.int32)
            both = n[a:b, None] + n[None, a:z]
            need = _required(n[a:b, None], n[None, a:z], percent)
            near = (differ <= both - 2 * need) & (need <= np.minimum(n[a:b, None], n[None, a:z]))
            x, y = np.nonzero(np.triu(near, 1))
            edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True]) if len(x) else []
            for i, j in zip(edge, edge[1:]):
                own = a + x[i]
                ys = a + y[i:j]
                ys = ys[of[ys] != of[own]]
                if len(ys):
                    others, first = np.unique(of[ys], return_index=True)
                    pairs += [(int(own), int(k)) for k in ys[first]]
                    of[np.isin(of, others)] = of[own]
            if len(x) and (of == of[0]).all():
                return pairs
    return pairs


def _words(bits: list[bytes], width: int) -> np.ndarray:
    """A row of `width` words for each of parities that are as long or longer; halves of longer ones are added up."""
    words = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


class _Lists:
    """Inverted lists over sets in ascending order of size: the documents that have a token, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.edge = np.r_[0, np.cumsum(self.sizes)]
        token, self.own = np.unique(np.concatenate(sets), return_inverse=True)
        doc = np.repeat(np.arange(self.n), self.sizes)
        posts = np.argsort(self.own, kind="stable")
        self.doc, self.length = doc[posts], np.bincount(self.own, minlength=len(token))
        self.flat = self.own[posts] * self.n + self.doc  # ascending by list, then document

    def at(self, lists, docs):
        """The place in each list of its first document from docs on (global, to be compared with an end)."""
        return np.searchsorted(self.flat, lists * self.n + docs)

    def has(self, lists, docs):
        """Binary probes: whether the list has the document."""
        key = lists * self.n + docs
        return self.flat[np.minimum(np.searchsorted(self.flat, key), len(self.flat) - 1)] == key


def _required(a, b, percent: int):
    """The overlap that links sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, which cells are filled)."""
    lens = np.array([len(r) for r in rows])
    filled = np.arange(max(int(lens.max()), 1)) < lens[:, None]
    out = np.zeros(filled.shape, np.int64)
    out[filled] = np.concatenate(rows)
    return out, filled


def _candidates_of(index: _Lists, first: np.ndarray, stop: np.ndarray, short: list[np.ndarray], need: np.ndarray, after):
    """(queries' places, documents, lists that have them): T-occurrence in the short lists of many queries side by side,
    each over the documents from first to stop.

    A row holds the heads of a query's lists.  Its least head is the next document of the k-way merge: if
    enough heads agree it is a candidate, else the lists skip ahead (MergeSkip) to the need-th
    least head, as no document before that can be in enough lists.  after(places, documents): the
    next document of interest to a query that has been told of this one.
    """
    lists, filled = _padded(short)
    pos = index.at(lists, first[:, None])
    end = np.where(filled, index.at(lists, stop[:, None]), pos)
    of, none = np.arange(len(first)), index.n
    doc = np.r_[index.doc, none]
    heads = np.where(pos < end, doc[pos], none)
    while len(of):
        least = heads.min(1)
        agree = heads == least[:, None]
        count = agree.sum(1)
        enough = count >= need
        some = np.flatnonzero(enough & (least < none))
        if len(some):
            yield of[some], least[some], count[some]
        goal = least + 1
        if len(some):
            goal[some] = after(of[some], least[some])
        behind = np.flatnonzero(~enough)
        if len(behind):
            for n in np.unique(need[behind]):
                rows = behind[need[behind] == n]
                goal[rows] = np.partition(heads[rows], n - 1, axis=1)[:, n - 1] if n <= heads.shape[1] else none
        i, j = np.nonzero(heads < np.minimum(goal, none)[:, None])
        step = goal[i] == least[i] + 1
        pos[i[step], j[step]] += 1
        i2, j2 = i[~step], j[~step]
        pos[i2, j2] = np.where(goal[i2] < none, index.at(lists[i2, j2], np.minimum(goal[i2], none - 1)), end[i2, j2])
        heads[i, j] = np.where(pos[i, j] < end[i, j], doc[pos[i, j]], none)
        open_ = (heads < none).sum(1) >= need
        if 4 * np.count_nonzero(open_) <= 3 * len(of):
            lists, pos, end, heads, of, need = (x[open_] for x in (lists, pos, end, heads, of, need))


def search(sets: list[np.ndarray], percent: int = PERCENT, every: bool = False) -> list[tuple[int, int]]:
    """Links (i, j) among the sets: all of them, or as many as span every component of the link graph."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    index = _Lists([sets[i] for i in order])
    least = -(-percent * index.sizes // 100)
    first = np.searchsorted(index.sizes, least)
    asking = np.flatnonzero(first < np.arange(index.n))
    of, links = np.arange(index.n), []  # of: the component of each so far
    by_size = np.r_[np.flatnonzero(np.r_[True, index.sizes[1:] != index.sizes[:-1]]), index.n]

    def asked():
        """(query, documents from and to, short lists, long lists, occurrences needed in the short ones): DivideSkip, so T less the long lists set aside."""
        for x in asking.tolist():
            own = index.own[index.edge[x] : index.edge[x + 1]]
            lens = index.length[own]
            by = np.argsort(lens, kind="stable")
            own = own[by]
            aside = min(int(least[x]) - 1, int(least[x] / (MU * int(lens.max()).bit_length() + 1)))
            short = len(own) - aside
            if int(lens[by[:short]].sum()) <= LONG * len(own):
                yield x, int(first[x]), x, own[:short], own[short:], int(least[x]) - aside
                continue
            # Lists that many documents share: documents of each size by themselves, as T is known then, and T - 1 lists aside.
            # A text that fits a template as all others do, but is linked with none of them, has only words of its own in the rest.
            for k in range(int(np.searchsorted(by_size, first[x], "right")) - 1, len(by_size) - 1):
                lo, hi = max(int(by_size[k]), int(first[x])), min(int(by_size[k + 1]), x)
                if lo >= hi:
                    break
                t = int(_required(len(own), int(index.sizes[lo]), percent))
                if t <= len(own):
                    yield x, lo, hi, own[: len(own) - t + 1], own[len(own) - t + 1 :], 1

    def merged(queries):
        xs, lo, hi, short, long_, need = zip(*queries)
        xs, lo, hi, need = map(np.array, (xs, lo, hi, need))
        aside = np.array([len(v) for v in long_])
        probes, filled = _padded(long_)

        def after(rows, ys):
            """The next document that is not in the query's component."""
            out = ys + 1
            for r in np.flatnonzero(of[xs[rows]] == of[ys]):
                x = xs[rows[r]]
                rest = of[out[r] : hi[rows[r]]] != of[x]
                out[r] = out[r] + rest.argmax() if rest.any() else index.n
            return out

        for rows, ys, k in _candidates_of(index, lo, hi, short, need, (lambda rows, ys: ys + 1) if every else after):
            wanted = _required(index.sizes[xs[rows]], index.sizes[ys], percent)
            some = (k + aside[rows] >= wanted) & (every | (of[xs[rows]] != of[ys]))  # else their component is known already
            rows, ys, k, wanted = rows[some], ys[some], k[some], wanted[some]
            if len(rows):
                k = k + (index.has(probes[rows], ys[:, None]) & filled[rows]).sum(1)
            for r in np.flatnonzero(k >= wanted):
                x, y = xs[rows[r]], ys[r]
                if every or of[x] != of[y]:
                    links.append((order[x], order[y]))
                    of[of == of[x]] = of[y]

    some, wide = [], 0
    for query in asked():
        wide = max(wide, len(query[3]), len(query[4]))
        if some and (len(some) + 1) * wide > CELLS:
            merged(some)
            some, wide = [], max(len(query[3]), len(query[4]))
        some.append(query)
    if some:
        merged(some)
    return links


def _flush(sigs, nodes, buckets, most):
    """Rows (bucket, kind, a, b) of the distinct signatures and the sets that have them: kind 0, all of them; kind 4, where more
    than `most` sets have one, the least of them, which stands for the others by edges of kind 5."""
    sig, node = np.concatenate(sigs), np.concatenate(nodes)
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    size = np.diff(np.r_[first, len(sig)])
    hot = np.repeat(size > most, size)
    rows = []
    for kind, some in ((0, np.flatnonzero(~hot)), (4, first[size > most])):
        bucket = (sig[some] >> _U(32)) * _U(buckets) >> _U(32)
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(some) else []
        rows += [(int(bucket[a]), kind, _low(sig[some[a:b]], 4), _low(node[some[a:b]], 6)) for a, b in zip(edge, np.r_[edge[1:], len(some)])]
    if hot.any():
        stars = np.unique(np.stack([node[hot], np.repeat(node[first], size)[hot]]), axis=1)
        rows.append((int(stars[0, 0] % buckets), 5, stars[0].tobytes(), stars[1].tobytes()))
    return rows


def _low(x: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit numbers."""
    return np.ascontiguousarray(x).astype("<i8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _raised(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<i8").ravel()


_MEETS = "array<struct<g1:bigint,c:int,i:int,d:int,j:int>>"
#: A set's place in a group: its block i of `own` in its size class, and the blocks of the classes above and below; null in small groups.
_PLACED = ["rep", "label", "class", "i", "own", "above", "below"]
#: A place in a broadcast: 64 bytes, and as many for its share of the hash table.
PLACED_BYTES = 128
#: A group's size in a broadcast, with its share of the hash table.
GROUP_BYTES = 96
_SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_FOUND = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("d", pa.int64()), ("bits", pa.binary())])


def candidates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(kind, a, b, c, d, bits): kind 1 sets and the head of a signature they have (a, b), by 48 bits of their
    hashes; kind 5 pairs (a, b) of which either stands for all that the other does; kind 2 documents (id, set
    size, 128-bit set hash, parities); kind 3 documents without an id (0, set size).  Materialized."""
    buckets, most = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), HOT

    def send(batches):
        sigs, nodes, held, turn, seen = [], [], 0, 0, set()
        for batch in slices(batches, "text"):
            info, bits = [], []
            for i, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), words)):
                check = [np.add.reduce(mix(s + p)) if len(s) else _U(0) for p in _PLACE[:2]]
                info.append((i, len(s), *(int(x.astype(np.int64)) for x in check)))
                if i is not None:
                    bits.append(parities(s))
                if i is not None and len(s) and info[-1][1:] not in seen:
                    seen.add(info[-1][1:])
                    found = signatures(s, percent)
                    sigs.append(found)
                    nodes.append(np.full(len(found), info[-1][2] & _NODE, np.int64))
                    held += len(found)
            turn += 1
            known = [np.array([x[k] for x in info if x[0] is not None], np.int64) for k in range(4)]
            rows = [(turn * 7919 % buckets, 2, np.concatenate(known).tobytes(), b"".join(bits))] if len(known[0]) else []
            nulls = [x[1] for x in info if x[0] is None]
            if nulls:
                rows.append((turn * 7919 % buckets, 3, np.array(nulls, np.int64).tobytes(), b""))
            if held >= FLUSH:
                rows += _flush(sigs, nodes, buckets, most)
                sigs, nodes, held, seen = [], [], 0, set()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)] if rows else [pa.array([], f.type) for f in _SENT], schema=_SENT)
        if sigs:
            rows = _flush(sigs, nodes, buckets, most)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)

    def meet(table):
        rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "a", "b"))))
        ints = lambda x: np.frombuffer(x, np.int64)
        out = []
        sent = [(k, a, b) for k, a, b in rows if k in (0, 4)]
        if sent:
            sig, node = _raised(b"".join(a for _, a, _ in sent), 4), _raised(b"".join(b for _, _, b in sent), 6)
            stands = np.repeat([k == 4 for k, _, _ in sent], [len(a) // 4 for _, a, _ in sent])
            order = np.lexsort((node, sig))
            sig, node, stands = sig[order], node[order], stands[order]
            new = np.r_[True, sig[1:] != sig[:-1]]
            head = node[new][np.cumsum(new) - 1]
            for kind, some in ((1, ~stands), (5, stands)):
                out.append((kind, np.unique(np.stack([node, head])[:, (node != head) & some], axis=1)))
        out += [(5, np.stack([ints(a), ints(b)])) for k, a, b in rows if k == 5]
        out += [(2, ints(a).reshape(4, -1)) for k, a, b in rows if k == 2]
        out += [(3, np.stack([np.zeros(len(a) // 8, np.int64), ints(a)])) for k, a, b in rows if k == 3]
        cols = [np.concatenate([np.full(x.shape[1], k, np.int32) for k, x in out])]
        cols += [np.concatenate([x[c] if c < len(x) else np.zeros(x.shape[1], np.int64) for _, x in out]) for c in range(4)]
        held = np.where(cols[0] == 2, [_parity_bytes(n) for n in cols[2].tolist()], 0)  # in the order of the documents
        ends = np.r_[0, np.cumsum(held)].astype(np.int32)
        bits = pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(b for k, _, b in rows if k == 2))])
        release(2)
        return pa.Table.from_arrays([*(pa.array(c) for c in cols), bits], schema=_FOUND)

    ddl = "bucket int, kind int, a binary, b binary"
    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(send, ddl)
    return materialize(sent.groupBy("bucket").applyInArrow(meet, "kind int, a long, b long, c long, d long, bits binary"), "signatures")


def _meets(bins: int):
    """The tasks a placed set goes to, one for every block it meets: made after any broadcast, as their number grows with the group."""
    of, i = F.col("class"), F.col("i")
    key = lambda c, i, d, j: F.struct(F.col("label").alias("g1"), c.alias("c"), i.alias("i"), d.alias("d"), j.alias("j"))
    meet = lambda m, f: F.when(F.col(m) > 0, F.transform(F.sequence(F.lit(0), F.col(m) - 1), f)).otherwise(F.array().cast(_MEETS))
    here = F.filter(meet("own", lambda k: key(of, F.least(k, i), of, F.greatest(k, i))), lambda m: (F.col("own") == 1) | (m["i"] != m["j"]))
    large = F.concat(here, meet("above", lambda k: key(of, i, of + 1, k)), meet("below", lambda k: key(of - 1, k, of, i))).cast(_MEETS)
    minus = F.lit(-1)
    bin_ = F.struct(F.pmod(F.xxhash64("label"), F.lit(bins)).alias("g1"), minus.alias("c"), minus.alias("i"), minus.alias("d"), minus.alias("j"))
    return F.when(of.isNull(), F.array(bin_).cast(_MEETS)).otherwise(large)


def _fits(placed: DataFrame) -> bool:
    """Whether all places are small enough for a broadcast."""
    return placed.count() * PLACED_BYTES <= BROADCAST_BYTES


def _documents(found: DataFrame) -> DataFrame:
    return found.where("kind = 2").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), "c", "d")


def _plausible_pairs(sharing: DataFrame, percent: int, bins: int) -> DataFrame:
    """(a, b): pairs of sets of one group (rep, n, label, bits; materialized) that may be linked, as many as span them.

    Small groups go to a task by the bin; a group of more than TOGETHER sets is dealt to blocks, of which every two meet.
    """
    large = sharing.groupBy("label").agg(F.count("*").alias("g")).where(F.col("g") > TOGETHER)
    large = materialize(large.select("label", F.ceil(F.col("g") / TOGETHER).cast("int").alias("blocks")), "large-groups")
    cut = sharing.join(sized(large, GROUP_BYTES), "label", "left")
    own = F.pmod(F.xxhash64("rep", "n"), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != own))
    cells = cut.select("rep", "n", "label", "bits", F.coalesce(own, F.lit(-1)).alias("own"), F.explode(other).alias("k"))
    cells = cells.select("rep", "n", "label", "bits", F.least("own", "k").alias("i"), F.greatest("own", "k").alias("j"))
    cells = cells.withColumn("bin", F.pmod(F.xxhash64("label", "i", "j"), F.lit(bins)))

    def compare(table):
        label, i, j, rep, n = (table.column(c).to_numpy() for c in ("label", "i", "j", "rep", "n"))
        bits = table.column("bits").to_pylist()
        order = np.lexsort((n, j, i, label))
        place = np.stack([label, i, j])[:, order]
        edge = np.flatnonzero(np.r_[True, (place[:, 1:] != place[:, :-1]).any(axis=0), True]).tolist()
        out = [np.zeros((2, 0), np.int64)]
        for lo, hi in zip(edge, edge[1:]):
            own = order[lo:hi]
            pairs = plausible(n[own], [bits[k] for k in own.tolist()], percent)
            out.append(rep[own[np.array(pairs, np.int64).reshape(-1, 2).T]])
        a, b = np.concatenate(out, axis=1)
        release(2)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("bin").applyInArrow(compare, "a long, b long")


def _linked_sets(docs: DataFrame, words: int, percent: int, postings: int, every: bool):
    """Signatures and documents as candidates gives them, the distinct sets (n, c, d, rep), and links (a, b) between their reps."""
    spark = docs.sparkSession
    bins = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = candidates(docs, words, percent)
    info = _documents(found)
    # One representative per distinct set, the least id: grouped with partial minima.
    same_set = found.where("kind = 2 and b > 0").groupBy(F.col("b").alias("n"), "c", "d")
    classes = materialize(same_set.agg(F.min("a").alias("rep"), F.first("bits").alias("bits")), "classes")
    # A group per head; those of sets that stand for one another are one.
    same = components(found.where("kind = 5").select("a", "b"))
    heads = found.where("kind = 1").select(F.col("a").alias("node"), F.col("b").alias("head")).distinct()
    heads = heads.unionByName(heads.select(F.col("head").alias("node"), "head").distinct()).unionByName(same.select("node", F.col("node").alias("head")))
    of = same.select(F.col("node").alias("head"), "component")
    groups = heads.join(of, "head", "left").select("node", F.coalesce("component", "head").alias("label")).distinct()
    sharing = classes.withColumn("node", F.col("c").bitwiseAND(F.lit(_NODE))).join(groups, "node").select("rep", "n", "label", "bits")
    near = components(_plausible_pairs(materialize(sharing, "sharing"), percent, bins))
    members = classes.join(near, classes["rep"] == near["node"]).select("rep", "n", F.col("component").alias("label")).distinct()
    members = materialize(members, "members")
    count = materialize(members.groupBy("label").agg(F.count("*").alias("g"), F.sum("n").alias("all")).where("g > 1"), "groups")
    placed = members.join(sized(count, GROUP_BYTES), "label")  # by broadcast, where it fits: a hot group's members stay where they are
    edges = F.array(*(F.lit(e) for e in _classes(percent, 1 << 40)))
    large = placed.where(F.col("all") > postings).withColumn("class", F.size(F.filter(edges, lambda e: e <= F.col("n"))))
    blocks = large.groupBy("label", "class").agg(F.ceil(F.sum("n") / (postings / 2)).cast("int").alias("m"))
    near = lambda by, name: blocks.select("label", (F.col("class") - by).alias("class"), F.col("m").alias(name))
    large = large.join(near(0, "own"), ["label", "class"]).join(near(1, "above"), ["label", "class"], "left").join(near(-1, "below"), ["label", "class"], "left")
    large = large.withColumn("i", F.pmod(F.xxhash64("rep"), F.col("own")).cast("int")).select(*_PLACED)
    small = placed.where(F.col("all") <= postings).select("rep", "label", *(F.lit(None).cast("int").alias(c) for c in _PLACED[2:]))
    placed = materialize(small.unionByName(large), "placed")

    def whole(batches):
        for batch in slices(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets(batch.column(2), words)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sets, pa.binary())], ["rep", "places", "s"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    places = placed.groupBy("rep").agg(F.collect_list(F.struct(*_PLACED[1:])).alias("places"))
    places = F.broadcast(places) if _fits(placed) else places
    sets = texts.join(places, texts["doc_id"] == places["rep"]).select("rep", "places", "text")
    # An id that several texts have is one node, so each of them may find its links.
    sets = sets.mapInArrow(whole, f"rep long, places {places.schema['places'].dataType.simpleString()}, s binary")
    dealt = sets.select("rep", "s", F.explode("places").alias("p")).select("rep", "s", "p.*").select("rep", "label", "s", F.explode(_meets(bins)).alias("m")).select("rep", "label", "s", "m.*")

    def look(table):
        label, rep = table.column("label").to_numpy(), table.column("rep").to_numpy()
        held = table.column("s").to_pylist()
        out = []
        order = np.lexsort((rep, label))
        for _, places in groupby(order.tolist(), key=lambda i: label[i]):
            places = list(places)
            links = search([np.frombuffer(held[i], np.uint64) for i in places], percent, every)
            out += [(int(rep[places[i]]), int(rep[places[j]])) for i, j in links]
        release(2)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return found, classes, dealt.groupBy("g1", "c", "i", "d", "j").applyInArrow(look, "a long, b long")


def all_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, postings: int = POSTINGS) -> DataFrame:
    """a, b, a_copies, b_copies: every linked pair of different sets, as their least ids (a < b), each
    for a_copies * b_copies pairs of documents; copies of one set are linked as well and not listed."""
    found, _, links = _linked_sets(docs, words, percent, postings, True)
    copies = _documents(found).where("n > 0").groupBy("n", "c", "d").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies"))
    copies = materialize(copies, "copies")
    side = lambda k: copies.select(F.col("rep").alias(k), F.col("copies").alias(f"{k}_copies"))
    pairs = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_copies", "b_copies")


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, postings: int = POSTINGS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs; of the links only a spanning set is verified."""
    found, classes, links = _linked_sets(docs, words, percent, postings, False)
    info = _documents(found)
    some = info.where("n > 0")
    # An id that several texts have joins their sets.
    several = some.groupBy("doc_id").agg(F.min(F.struct("n", "c", "d")).alias("lo"), F.max(F.struct("n", "c", "d")).alias("hi")).where("lo <> hi").select("doc_id")
    same = some.join(several, "doc_id").join(classes, ["n", "c", "d"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = materialize(components(links.unionByName(same)), "linked")
    best = classes.join(joined, classes["rep"] == joined["node"], "left").select("n", "c", "d", F.coalesce("component", "rep").alias("component"))
    out = some.join(best, ["n", "c", "d"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    empty = info.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    nulls = found.where("kind = 3").select(F.lit(None).cast("long").alias("doc_id"), F.col("b").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(empty).unionByName(nulls)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs but one per component, the least id; columns unchanged."""
    linked = link_components(docs, words, percent)
    gone = linked.where("component_id < doc_id").select("doc_id").distinct()
    gone = materialize(gone, "near-copies")
    return docs.join(sized(gone, 16), "doc_id", "left_anti")
