"""Brute-force versions: plain Python over a small list of rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def removed(docs):
    """docs: (doc_id, text) -> {row: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    raws = [(i, (t or "").encode()) for i, t in docs]
    least = {}
    for i, raw in raws:
        if i is not None:
            for p in range(len(raw) - 49):
                g = raw[p : p + 50]
                least[g] = min(i, least.get(g, i))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        if i is not None:
            for p in range(len(raw) - 49):
                if least[raw[p : p + 50]] < i:
                    gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def rules(text):
    raw = (text or "").encode()
    words = WORD.findall(raw)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(raw.count(c) for c in b"#*$%&|<>")
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if n[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), chars, symbols, dup, len(hit)


def shingles(text, k=3):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    w = WORD.findall(raw)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def components(docs, k=3, percent=90):
    """(doc_id, text) rows -> {doc_id: (n_shingles, component)}; an id is one node, whatever texts it has (n_shingles: of the last)."""
    rows = [(i, shingles(t, k)) for i, t in docs if i is not None]
    lists = defaultdict(list)
    for r, (_, s) in enumerate(rows):
        for x in s:
            lists[x].append(r)
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r, (i, s) in enumerate(rows):
        shared = Counter(q for x in s for q in lists[x] if q < r)
        for q, n in shared.items():
            if 100 * n >= percent * (len(s) + len(rows[q][1]) - n):
                a, b = find(i), find(rows[q][0])
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in rows}


def crc(ids):
    import struct

    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def runs(words):
    """(start, length, period) of all runs, by start and period: every stretch of matches for every period, named by its least."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i) + 1
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))
