"""Suffix-array removal of byte strings that an earlier document has.

A byte goes if it lies in a ``WIDTH``-byte string that also starts in a document with a
smaller id.  Texts are shuffled once, into parts, and read three times from there:

1. Anchors.  Of every WIDTH bytes in a row the GRAM-byte string with the least hash is an
   anchor, so equal strings have equal anchors at equal offsets.  Parts send their distinct
   anchor hashes to buckets, which send back those that two documents have.
2. Contexts.  A part sends, once per distinct context, the bytes around such an anchor
   that WIDTH-byte strings over it can reach, with the least id that has them.  A bucket
   sorts the suffixes that begin those strings (``suffixes``): neighbours that share WIDTH
   bytes are the same string, and the least id of each run goes back to the parts.
3. Cuts.  A part marks the strings whose least id is below the document's own.

Contexts are named by the place of one holder in their part; wherever hashes group contexts or
strings, bytes are compared, and those that only share a hash are told apart (``_exact``).

Skew: what a part sends is distinct (copies in a part collapse), so a bucket gets at most a
few entries per part for an anchor.  Anchors met in HOT or more contexts inside one part
(the edges of a very common passage) are sent string by string under the string's own hash
instead, which spreads them over the buckets.  Nothing is dropped or sampled.

Edge cases: a null text has no bytes; a null id neither loses nor lends bytes; rows that
repeat an id do not affect each other; texts below WIDTH bytes stay whole; an empty table
gives no rows.  Own columns come back in the struct ``doc``, so none clashes with a result's name.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release, text_bytes
from .hashing import grams, mix, prefixes, ragged, sliding, spans
from .suffixes import sort_suffixes

WIDTH = 50
GRAM = 19
HOT = 8
#: Text bytes of a part, which is in memory at once with its anchors; parts per bucket.
PART_BYTES, PARTS_A_BUCKET = 1 << 20, 8
CACHE = 1 << 16

_U = np.uint64
_SEND = "bucket int, part int, least binary, pre binary, len binary, place binary, ctx binary"
_REPLY = "part int, place binary, frm binary, to binary, low binary, hot binary"
ALONE, SEVERAL = 255, 128
#: In a place: of a string sent alone.
_BY_ITSELF = 1 << 62
CHUNK = 1 << 14


class _Part:
    """The documents of one part end to end, with their anchors."""

    def __init__(self, table: pa.Table, width: int, gram: int):
        # Shuffled rows come in any order; places hold in this one.
        table = table.combine_chunks()
        by = pc.sort_indices(table.select(["__id", "__text"]), sort_keys=[("__id", "ascending"), ("__text", "ascending")])
        self.table = table = table.take(by).combine_chunks()
        text = table.column("__text").combine_chunks() if table.num_rows else pa.array([], pa.string())
        self.raw, self.at = text_bytes(text)
        ids = table.column("__id").to_numpy()
        self.known = ~np.isnan(ids) if ids.dtype.kind == "f" else np.ones(len(ids), bool)
        self.ids = table.column("__id").fill_null(0).to_numpy().astype(np.int64)
        # Some documents at a time, so that the arrays of hashes stay in the processor's cache.
        block = self.at[1:] // CACHE
        cut = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)] if len(block) else np.zeros(1, np.int64)
        found = [_anchors_of(self.raw[self.at[i] : self.at[j]], self.at[i : j + 1] - self.at[i], self.known[i:j], width, gram) for i, j in zip(cut, cut[1:])]
        base = [int(self.at[i]) for i in cut[:-1]]
        self.q, self.lo, self.hi = (np.concatenate([f[k] + o for f, o in zip(found, base)] or [np.zeros(0, np.int64)]) for k in range(3))
        self.h, self.c = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.uint64)]) for k in (3, 4))
        self.doc = np.searchsorted(self.at, self.q, "right") - 1

    @cached_property
    def s(self):
        return prefixes(self.raw)


def _anchors_of(raw, at, known, width, gram):
    """(place, from, to, hash, context hash) of the anchors, with the bytes of the strings they stand for."""
    s = prefixes(raw)
    w = width - gram + 1
    g = grams(s, gram)
    least = sliding(g, w, np.minimum)
    end = np.repeat(np.where(known, at[1:], 0), np.diff(at))[: len(least)]
    least[np.arange(len(least)) + width > end] = 0  # strings that leave their document
    # A string's anchor is the leftmost gram of least hash in it.  Strings in a row with the same least
    # hash share it, up to the anchor's own place.
    edge = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]) if len(least) else np.zeros(0, np.int64)
    lo, last = edge, np.r_[edge[1:], len(least)][: len(edge)] - 1
    some = least[lo] > 0
    lo, last = lo[some], last[some]
    step = np.arange(w)
    q = lo + (g[lo[:, None] + step] == least[lo][:, None]).argmax(1)
    if (last > q).any():  # text that repeats itself: string by string
        redo = last > q
        each = ragged(lo[redo], last[redo] - lo[redo] + 1)
        own = np.concatenate([x + (g[x[:, None] + step] == least[x][:, None]).argmax(1) for x in np.array_split(each, len(each) // 4096 + 1)])
        edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        lo, last, q = (np.r_[x[~redo], y] for x, y in ((lo, each[edge]), (last, each[np.r_[edge[1:], len(each)] - 1]), (q, own[edge])))
        by = np.argsort(lo)
        lo, last, q = lo[by], last[by], q[by]
    hi = last + width
    return q, lo, hi, g[q], mix(spans(s, lo, hi) + (q - lo).astype(np.uint64))


def _short(h) -> np.ndarray:
    """The upper 48 bits: enough to find anchors that several documents may have."""
    return h >> _U(16)


def _pack(h48) -> bytes:
    return h48.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _key(h, c):
    return mix(h * _U(3) + c)


def _unique_min(key, ids):
    """(index of a first holder, least id) per distinct key, and each row's place among them."""
    order = np.lexsort((ids, key))
    new = np.r_[True, key[order][1:] != key[order][:-1]] if len(order) else np.zeros(0, bool)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], ids[order[new]], place


def _exact(raw, key, lo, lens, pre, ids):
    """_unique_min of the contexts raw[lo : lo + lens] by their bytes; key: a hash of them."""
    first, least, place = _unique_min(key, ids)
    holder = first[place]
    differs = (lens != lens[holder]) | (pre != pre[holder])
    same = np.flatnonzero(~differs & (holder != np.arange(len(key))))
    for some in np.array_split(same, len(same) // CHUNK + 1):
        if len(some):
            own = lens[some]
            unlike = raw[ragged(lo[some], own)] != raw[ragged(lo[holder[some]], own)]
            differs[some] = np.logical_or.reduceat(unlike, np.cumsum(own) - own)
    if not differs.any():
        return first, least, place
    # Hashes collided: the classes concerned are told apart by their bytes.
    names: dict[tuple[int, bytes], int] = {}
    label = place.copy()
    for i in np.flatnonzero(np.isin(place, place[differs])):
        label[i] = len(first) + names.setdefault((int(pre[i]), raw[lo[i] : lo[i] + lens[i]].tobytes()), len(names))
    return _unique_min(label, ids)


def _bucket(h, buckets):
    h = mix(h + _U(1))  # anchors are least hashes, so small ones: spread them anew
    return ((h >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)


def _cut(bucket):
    """Ascending bucket numbers -> (number, from, to)."""
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(edge, np.r_[edge[1:], len(bucket)])]


def _anchors(part: _Part, number: int, buckets: int, hot: int):
    """Rows (bucket, part, anchors of one document, of several, of many contexts)."""
    h = _short(part.h)
    pair = np.lexsort((part.doc, h))
    h, doc = h[pair], part.doc[pair]
    new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    several = np.zeros(int(new.sum()), bool)
    several[group[1:][(h[1:] == h[:-1]) & (part.ids[doc[1:]] != part.ids[doc[:-1]])]] = True
    h = h[new]
    context = np.unique(_key(part.h, part.c), return_index=True)[1]
    many, n = np.unique(_short(part.h[context]), return_counts=True)
    b = _bucket(h << _U(16), buckets)
    by = np.argsort(b, kind="stable")
    b, h, several = b[by], h[by], several[by]
    heated = np.isin(h, many[n >= hot])
    for number_b, lo, hi in _cut(b):
        one, two, three = h[lo:hi][~several[lo:hi]], h[lo:hi][several[lo:hi] & ~heated[lo:hi]], h[lo:hi][heated[lo:hi]]
        yield number_b, number, _pack(one), _pack(two), _pack(three)


def _survivors(parts, ones, twos, threes):
    """Rows (part, anchors that two documents have, those of many contexts)."""
    one, two, three = ([_unpack(x) for x in col] for col in (ones, twos, threes))
    every = np.sort(np.concatenate([*one, *two, *three]))
    kept = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *two, *three]))
    hot = np.unique(np.concatenate(three))
    for part, a, b, c in zip(parts, one, two, three):
        own = np.concatenate([a, b, c])
        own = own[_isin(own, kept)]
        if len(own):
            heated = _isin(own, hot)
            yield part, _pack(own[~heated]), _pack(own[heated])


def _isin(x, table):
    if not len(table):
        return np.zeros(len(x), bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def _contexts(part: _Part, number: int, kept, hot, buckets: int, width: int):
    """Rows as _SEND: distinct contexts of kept anchors, distinct strings over hot ones (marked ALONE).

    Hashes are not sent, the bucket makes them from the bytes; SEVERAL marks a context that
    more than one document of the part has.
    """
    cold = np.flatnonzero(_isin(_short(part.h), kept))
    h, c, lo, hi, pre, ids = part.h[cold], part.c[cold], part.lo[cold], part.hi[cold], (part.q - part.lo)[cold], part.ids[part.doc[cold]]
    start = _strings(part, np.flatnonzero(_isin(_short(part.h), hot)), width)
    if len(start):
        own = mix(spans(part.s, start, start + width))
        doc = np.searchsorted(part.at, start, "right") - 1
        zero = np.zeros(len(start), np.int64)
        h, c, lo, hi, pre, ids = (np.r_[a, b] for a, b in ((h, own), (c, zero.astype(np.uint64)), (lo, start), (hi, start + width), (pre, zero + ALONE), (ids, part.ids[doc])))
    lens, by_itself = hi - lo, pre == ALONE
    at, least, place = _exact(part.raw, _key(h, c), lo, lens, pre, ids)
    several = np.zeros(len(at), bool)
    several[place[ids != least[place]]] = True
    b = _bucket(h[at], buckets)
    order = np.lexsort((h[at], b))
    b, at, least, several = b[order], at[order], least[order], several[order]
    lens = lens[at]
    where = lo[at] + _BY_ITSELF * by_itself[at]
    text = part.raw[ragged(lo[at], lens)]
    edge = np.r_[0, np.cumsum(lens)]
    squeeze = zstandard.ZstdCompressor().compress
    for number_b, i, j in _cut(b):
        marked = (lens[i:j] + SEVERAL * several[i:j]).astype(np.uint8)
        yield number_b, number, least[i:j].tobytes(), pre[at[i:j]].astype(np.uint8).tobytes(), marked.tobytes(), where[i:j].tobytes(), squeeze(text[edge[i] : edge[j]].tobytes())


def _strings(part: _Part, anchors, width):
    """Distinct starts of the width-byte strings over these anchors."""
    lo, n = part.lo[anchors], np.maximum(part.hi[anchors] - part.lo[anchors] - width + 1, 0)
    return np.unique(ragged(lo, n))


def _hashed(text, lo, hi, pre, alone, gram):
    """(anchor hash, context hash) of each context, some at a time."""
    h, c = np.empty(len(lo), np.uint64), np.empty(len(lo), np.uint64)
    block = hi // CACHE
    cut = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)]
    for i, j in zip(cut, cut[1:]):
        s = prefixes(text[lo[i] : hi[j - 1]])
        a, b = lo[i:j] - lo[i], hi[i:j] - lo[i]
        h[i:j] = mix(spans(s, a + pre[i:j], np.where(alone[i:j], b, a + pre[i:j] + gram)))
        c[i:j] = np.where(alone[i:j], _U(0), mix(spans(s, a, b) + pre[i:j].astype(np.uint64)))
    return h, c


def _least_ids(table: pa.Table, width: int, gram: int, reach: int):
    """Rows (part, place, from, to, least): per context of a part, runs of string starts (relative to
    the context) and the least id that has those strings.  A bucket is taken CHUNK contexts at
    a time, never parting those of one anchor."""
    cols = {k: table.column(k).to_pylist() for k in ("least", "pre", "len", "place", "ctx")}
    ids, where = (np.concatenate([np.frombuffer(x, np.int64) for x in cols[k]]) for k in ("least", "place"))
    pre, lens = (np.concatenate([np.frombuffer(x, np.uint8) for x in cols[k]]).astype(np.int64) for k in ("pre", "len"))
    several, lens = lens >= SEVERAL, lens % SEVERAL
    loose = zstandard.ZstdDecompressor().decompress
    text = np.frombuffer(b"".join(loose(x) for x in cols["ctx"]), np.uint8)
    part = np.repeat(table.column("part").to_numpy(), [len(x) for x in cols["pre"]])
    del cols
    hi = np.cumsum(lens)
    lo, alone = hi - lens, pre == ALONE
    pre[alone] = 0
    h, c = _hashed(text, lo, hi, pre, alone, gram)
    order = np.argsort(h, kind="stable")
    edge = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    at = np.searchsorted(edge, np.arange(0, len(h), CHUNK))
    cut = np.unique(np.r_[edge[at[at < len(edge)]], len(h)])
    for a, b in zip(cut, cut[1:]):
        some = np.sort(order[a:b])
        own = text[ragged(lo[some], lens[some])]
        yield from _least_of(part[some], where[some], h[some], c[some], ids[some], pre[some], lens[some], several[some], own, width, reach)


def _least_of(part, where, h, c, ids, pre, lens, several, text, width, reach):
    first, least, place = _exact(text, _key(h, c), np.cumsum(lens) - lens, lens, pre, ids)
    rows = np.zeros((len(h), reach), np.uint8)
    rows[np.repeat(np.arange(len(h)), lens), ragged(np.zeros(len(h), np.int64), lens)] = text
    ch, cpre, clen, crow = h[first], pre[first], lens[first], rows[first]
    order = np.argsort(ch, kind="stable")
    size = np.unique(ch[order], return_counts=True)[1]
    shared = np.empty(len(order), bool)
    shared[order] = np.repeat(size, size) > 1
    n = clen - width + 1
    out_least = np.repeat(least, n)
    edge = np.r_[0, np.cumsum(n)]
    some = np.flatnonzero(shared)
    if len(some):
        cls, off = np.repeat(some, n[some]), ragged(np.zeros(len(some), np.int64), n[some])
        segment = mix(ch[cls] + _U(0x9E3779B97F4A7C15) * (cpre[cls] - off + 1).astype(np.uint64))
        o = np.argsort(segment, kind="stable")
        cls, off, segment = cls[o], off[o], segment[o]
        flat = crow.ravel()
        order, same = sort_suffixes(flat, prefixes(flat), cls * reach + off, segment, width)
        run = np.flatnonzero(same < width)
        low = np.minimum.reduceat(least[cls[order]], run)
        out_least[edge[cls[order]] + off[order]] = np.repeat(low, np.diff(np.r_[run, len(order)]))
    # Runs of equal least ids inside a context.
    new = np.r_[True, out_least[1:] != out_least[:-1]]
    new[edge[:-1][n > 0]] = True
    start = np.flatnonzero(new)
    stop = np.r_[start[1:], len(out_least)] - 1
    cls = np.searchsorted(edge, start, "right") - 1
    frm, to, low = start - edge[cls], stop - edge[cls], out_least[start]
    per = np.r_[0, np.cumsum(np.bincount(cls, minlength=len(first)))]
    by = np.argsort(part, kind="stable")
    for number, i, j in _cut(part[by]):
        own = by[i:j]
        n = per[place[own] + 1] - per[place[own]]
        r, k = ragged(per[place[own]], n), np.repeat(where[own], n)
        # Of use only to a document above the least id.
        of_use = (low[r] < np.repeat(ids[own], n)) | np.repeat(several[own], n)
        r, k = r[of_use], k[of_use]
        if len(r):
            yield number, k.tobytes(), frm[r].astype(np.uint8).tobytes(), to[r].astype(np.uint8).tobytes(), low[r].tobytes()


def _cuts(part: _Part, replies: pa.Table, width: int):
    """A removal mask over the part's bytes."""
    place, frm, to, low = (np.concatenate([np.frombuffer(x, t) for x in replies.column(k).to_pylist()] or [np.zeros(0, t)]) for k, t in (("place", np.int64), ("frm", np.uint8), ("to", np.uint8), ("low", np.int64)))
    frm, to = frm.astype(np.int64), to.astype(np.int64)
    depth = np.zeros(len(part.raw) + 1, np.int32)

    def mark(chosen, lo, lens, pre, key, ids):
        """The replies chosen, to all that are equal to the holders they name; lo is ascending."""
        if not chosen.any():
            return
        holder = np.searchsorted(lo, place[chosen] % _BY_ITSELF)
        some = np.flatnonzero(_isin(key, np.unique(key[holder])))
        of = _exact(part.raw, key[some], lo[some], lens[some], pre[some], ids[some])[2]
        asked = of[np.searchsorted(some, holder)]
        order = np.argsort(asked, kind="stable")
        a, b = np.searchsorted(asked[order], of, "left"), np.searchsorted(asked[order], of, "right")
        r, who = np.flatnonzero(chosen)[order][ragged(a, b - a)], np.repeat(some, b - a)
        cut = low[r] < ids[who]
        np.add.at(depth, (lo[who] + frm[r])[cut], 1)
        np.add.at(depth, (lo[who] + to[r] + width)[cut], -1)

    mark(place < _BY_ITSELF, part.lo, part.hi - part.lo, part.q - part.lo, _key(part.h, part.c), part.ids[part.doc])
    if (place >= _BY_ITSELF).any():
        # Strings over hot anchors were sent alone; where none was, none is found.
        hot = np.unique(_unpack(b"".join(replies.column("hot").to_pylist())))
        start = _strings(part, np.flatnonzero(_isin(_short(part.h), hot)), width)
        zero = np.zeros(len(start), np.int64)
        mark(place >= _BY_ITSELF, start, zero + width, zero, mix(spans(part.s, start, start + width)), part.ids[np.searchsorted(part.at, start, "right") - 1])
    return np.cumsum(depth[:-1]) > 0


def _whole_characters(raw, gone):
    """The mask widened to every character that loses a byte."""
    of = np.cumsum((raw & 0xC0) != 0x80)
    lost = np.zeros(int(of[-1]) + 1 if len(of) else 0, bool)
    lost[of[gone]] = True
    return lost[of]


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT, characters: bool = False) -> DataFrame:
    """doc (a struct of the other columns of docs), kept (binary), n_bytes, n_removed, spans (removed byte runs).

    characters: one that lost some of its bytes goes as a whole, so kept is text.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = size // PART_BYTES + 1
    buckets = parts // PARTS_A_BUCKET + 1
    reach = width - gram + width
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("__part")
    texts = docs.select(number, F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text"), F.struct(*others).alias("__row"))

    def anchors(key, table):
        rows = list(_anchors(_Part(table, width, gram), key[0].as_py(), buckets, hot))
        release(2)
        return _table(rows, "bucket int, part int, one binary, two binary, three binary")

    def survivors(key, table):
        rows = list(_survivors(*(table.column(c).to_pylist() for c in ("part", "one", "two", "three"))))
        release(2)
        return _table(rows, "part int, kept binary, hot binary")

    def contexts(key, table, known):
        part = _Part(table, width, gram)
        kept, heated = (np.sort(_unpack(b"".join(known.column(c).to_pylist()))) for c in ("kept", "hot"))
        rows = list(_contexts(part, key[0].as_py(), kept, heated, buckets, width)) if table.num_rows else []
        if len(heated) and rows:  # echoed by the bucket: the part's own list of hot anchors
            rows.append((rows[0][0], key[0].as_py(), *[b""] * 4, _pack(heated)))
        release(2)
        return _table(rows, _SEND)

    def least_ids(key, table):
        bare = [len(x) == 0 for x in table.column("pre").to_pylist()]
        echoed = [(p, b"", b"", b"", b"", x) for p, x, e in zip(table.column("part").to_pylist(), table.column("ctx").to_pylist(), bare) if e]
        table = table.filter(pa.array([not e for e in bare]))
        rows = [(*r, b"") for r in _least_ids(table, width, gram, reach)] if table.num_rows else []
        release(2)
        return _table(rows + echoed, _REPLY)

    def cuts(key, table, replies):
        part = _Part(table, width, gram)
        gone = _cuts(part, replies, width)
        if characters:
            gone = _whole_characters(part.raw, gone)
        n, at = table.num_rows, part.at
        before = np.r_[0, np.cumsum(gone)]
        kept_at = at - before[at]
        kept = part.raw[~gone]
        new = gone & ~np.r_[False, gone[:-1]]
        new[at[:-1][np.diff(at) > 0]] |= gone[at[:-1][np.diff(at) > 0]]
        lo = np.flatnonzero(new)
        last = gone & ~np.r_[gone[1:], False]
        tail = at[1:][np.diff(at) > 0] - 1
        last[tail] |= gone[tail]
        hi = np.flatnonzero(last) + 1
        doc = np.searchsorted(at, lo, "right") - 1
        runs = pa.StructArray.from_arrays([pa.array(lo - at[doc], pa.int64()), pa.array(hi - at[doc], pa.int64())], ["lo", "hi"])
        edge = np.searchsorted(lo, at).astype(np.int32)
        held = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(kept_at.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.binary())
        arrays = [part.table.column("__row").combine_chunks(), held, pa.array(np.diff(at)), pa.array(before[at[1:]] - before[at[:-1]]), pa.ListArray.from_arrays(pa.array(edge), runs)]
        release(2)
        return pa.Table.from_arrays(arrays, ["doc", "kept", "n_bytes", "n_removed", "spans"])

    by_part = texts.groupBy("__part")
    sent = by_part.applyInArrow(anchors, "bucket int, part int, one binary, two binary, three binary")
    known = sent.groupBy("bucket").applyInArrow(survivors, "part int, kept binary, hot binary")
    spread = by_part.cogroup(known.groupBy("part")).applyInArrow(contexts, _SEND)
    replies = spread.groupBy("bucket").applyInArrow(least_ids, _REPLY)
    schema = T.StructType().add("doc", texts.schema["__row"].dataType).add("kept", "binary").add("n_bytes", "long").add("n_removed", "long")
    schema = schema.add("spans", T.ArrayType(T.StructType().add("lo", "long").add("hi", "long")))
    return by_part.cogroup(replies.groupBy("part")).applyInArrow(cuts, schema)


def _table(rows, ddl) -> pa.Table:
    names, kinds = zip(*((x.split()[0], {"int": pa.int32(), "binary": pa.binary()}[x.split()[1]]) for x in ddl.split(", ")))
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(names))


def cleaned(docs: DataFrame) -> DataFrame:
    """docs with the repeats cut from text, whole characters at a time (and n_chars counted again); columns unchanged.

    A null text stays null where docs has one.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("own")
    done = remove_repeats(docs.select("doc_id", "text", own, F.col("text").isNull().alias("null")), characters=True)
    null, text, own = F.col("doc.null"), F.col("kept").cast("string"), F.col("doc.own")
    made = {"text": F.when(~null, text)}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(null, own["n_chars"]).otherwise(F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return done.select(*((made[c] if c in made else own[c]).alias(c) for c in docs.columns))
