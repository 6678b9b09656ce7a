"""Token ids of whole texts, by a public tokenizer file, inside Spark tasks.

The tokenizers library encodes; this module only remembers what it has encoded.  A text is
cut at places where the file's own pre-tokenizer cuts in any case, so the ids of the pieces,
end to end, are the ids of the text.  Equal pieces of a batch are encoded once, and the ids
of frequent ones are remembered by the worker.

The cuts hold for two settings of a file's normalizer and pre-tokenizer, named below; any
other file gets whole texts, and so does a text that holds the string of an added token, which
the library takes for that token.  White space below is ASCII white space, a run of it being cut

* ``byte`` files: before the run, and before its last character if a word follows; that
  one goes with the word if it is a space and is a piece of its own if not.  A text where other
  white space touches a run is encoded whole.
* ``word`` files (white space dropped): before and after the run.

Both are cut between a letter that keeps its kind when normalized (here ASCII, Latin-1) and
a run of ASCII punctuation (no apostrophe) that ends the word.

A piece of Latin letters alone is one word to the pre-tokenizer, so it goes straight to the
library's BPE model; probes at the start hold the two ways together, and a file where they
differ has only the second.

Memory: pieces are remembered in two generations of ``MEMO_BYTES``.  A full younger one takes
the place of the older; what is used again moves to the younger, so rare pieces leave.
"""

from __future__ import annotations

import json
import os
import re
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_bytes
from .hashing import ragged

#: Bytes of one generation of remembered pieces, and what a piece takes besides its letters and ids.
MEMO_BYTES = 24 << 20
_ENTRY = 240
#: Longer pieces are not remembered.
LONG = 100
#: Pieces in work at once: those of a slice of 2 MB (streams.SLICE), so that a slice looks up each different piece once.
PIECES = 1 << 19

# Settings of tokenizer files for which the cuts hold.
_BYTE_SETTINGS = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
_WORD_SETTINGS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
# End of fixed values.

_PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PROBES = ("a", "The", " the", "Über", " naïveté", "ÀÖØÞßÿ", " antidisestablishmentarianism", "QzxWvK")
_OTHER_SPACE = "\x1c-\x1f\x85\xa0 ᠎ -     　"
_TOUCHING = re.compile(f"[ \t-\r][{_OTHER_SPACE}]|[{_OTHER_SPACE}][ \t-\r]")

_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_TAIL = np.isin(_BYTES, list(b"!\"#$%&)*,-./:;?@]_}~"))
_ASCII_LETTER = np.isin(_BYTES, list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
#: Second bytes of the letters U+00C0 to U+00FF, all of which begin with C3.
_LATIN_SECOND = (_BYTES >= 0x80) & (_BYTES <= 0xBF) & (_BYTES != 0x97) & (_BYTES != 0xB7)
#: Bytes with which a character of other white space begins.
_OTHER_LEAD = np.isin(_BYTES, [0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3])


def _byte_letters() -> dict[int, str]:
    """Byte-level spelling of the space and the letters of _PLAIN: printable bytes stand for themselves, the others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in shown]
    name = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(name[b] for b in chr(c).encode()) for c in range(256) if c == 32 or chr(c).isalpha()}


def _tails(raw: np.ndarray, space: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where punctuation that ends a word begins, after a letter."""
    tail = _TAIL[raw] & ~first
    ends = np.r_[space[1:] | first[1:], True]
    # Runs of tail bytes, of those the ones that end a word.
    lo = np.flatnonzero(tail & ~np.r_[False, tail[:-1]])
    hi = np.flatnonzero(tail & ~np.r_[tail[1:], False])
    lo = lo[ends[hi]]
    letter = _ASCII_LETTER[raw[lo - 1]] | (_LATIN_SECOND[raw[lo - 1]] & (raw[np.maximum(lo - 2, 0)] == 0xC3))
    return lo[letter & (lo > 0)]


def word_cuts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which bytes begin a piece, for a file that drops white space; first: those that begin a text."""
    space = _SPACE[raw]
    cut = first.copy()
    cut[1:] |= space[1:] != space[:-1]
    cut[_tails(raw, space, first)] = True
    return cut


def byte_cuts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The same for a byte-level file."""
    space = _SPACE[raw]
    cut = first.copy()
    inner = ~first[1:]
    before, here = space[:-1], space[1:]
    cut[1:] |= here & ~before
    last = np.flatnonzero(before & ~here & inner)  # of runs that a word follows
    cut[last] = True
    cut[last[raw[last] != 32] + 1] = True
    cut[_tails(raw, space, first)] = True
    return cut


def touching(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Texts in which other white space touches ASCII white space."""
    where = np.flatnonzero(_SPACE[raw])
    odd = np.zeros(len(where), bool)
    for step in (1, -1, -2, -3):
        odd |= _OTHER_LEAD[raw[np.clip(where + step, 0, len(raw) - 1)]]
    texts = np.unique(np.searchsorted(at, where[odd], "right") - 1)
    return np.array([i for i in texts if _TOUCHING.search(raw[at[i] : at[i + 1]].tobytes().decode())], np.int64)


class Encoder:
    """encode(texts): the ids of whole texts."""

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        made = json.loads(t.to_str())
        settings = made["normalizer"], made["pre_tokenizer"]
        known = all(x["special"] for x in made["added_tokens"]) and not made["truncation"] and not made["padding"]
        # Texts that hold an added token's string are left to the library as a whole.
        self._added = "|".join(re.escape(x["content"]) for x in made["added_tokens"] if x["content"]), any(x["normalized"] for x in made["added_tokens"])
        self._words = known and settings == _WORD_SETTINGS
        self._cuts = word_cuts if self._words else byte_cuts if known and settings == _BYTE_SETTINGS else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._size, self._most = 0, memo_bytes
        self._model, self._letters = t.model, _byte_letters()
        self._raw = [pack("<I", i) for i in range(t.get_vocab_size())]
        probes = [p for p in _PROBES if not (self._words and p[0] == " ")]
        same = self._cuts and self._words_of(probes) == self._library(probes)
        self._plain = _PLAIN.fullmatch if same else lambda piece: None

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces of Latin letters."""
        spelled = "\n".join(pieces)
        if self._words:
            spelled = spelled.lower()
        if spelled.isascii():
            spelled = spelled.replace(" ", self._letters[32])
        else:
            spelled = spelled.translate(self._letters)
        tokenize, raw, join = self._model.tokenize, self._raw, b"".join
        return [join([raw[token.id] for token in tokenize(w)]) for w in spelled.split("\n")]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that are not remembered."""
        found: dict[str, bytes] = {}
        plain = list(filter(self._plain, pieces))
        for kind in (str.isascii, lambda p: not p.isascii()):
            own = list(filter(kind, plain))
            if own:
                found.update(zip(own, self._words_of(own)))
        rest = [p for p in pieces if p not in found]
        found.update(zip(rest, self._library(rest)))
        return [found[p] for p in pieces]

    def _learnt(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, from memory or from the library."""
        young = self._young
        out = list(map(young.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        if not missing:
            return out
        names = [pieces[i] for i in missing]
        held = list(map(self._old.get, names))
        new = [p for p, x in zip(names, held) if x is None]
        ids = iter(self._new(new))
        held = [next(ids) if x is None else x for x in held]
        for i, x in zip(missing, held):
            out[i] = x
        short = {p: x for p, x in zip(names, held) if len(p) <= LONG}
        young.update(short)
        self._size += sum(map(len, short)) + sum(map(len, short.values())) + _ENTRY * len(short)
        if self._size > self._most:
            self._young, self._old, self._size = {}, young, 0
        return out

    @property
    def spells_bytes(self) -> bool:
        """Whether the ids of a text spell its bytes, one after another."""
        return self._cuts is byte_cuts

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint32 end to end, int64 offsets of n + 1) of a text column; null counts as empty."""
        if self._cuts is None:
            return self._whole(column)
        pattern, any_case = self._added
        held = pc.fill_null(pc.match_substring_regex(column, pattern, ignore_case=any_case), False) if pattern else None
        if not pattern or not pc.any(held).as_py():
            return self._by_pieces(column)
        ids, edge = self._by_pieces(pc.if_else(held, pa.scalar("", column.type), column))
        own, at = self._whole(column.filter(held))
        which = np.flatnonzero(held.to_numpy(zero_copy_only=False))
        size = np.zeros(len(column), np.int64)
        size[which] = np.diff(at)
        return np.insert(ids, np.repeat(edge[which], np.diff(at)), own), edge + np.r_[0, np.cumsum(size)]

    def _whole(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self._library([x or "" for x in column.to_pylist()])
        return np.frombuffer(b"".join(found), "<u4"), np.r_[0, np.cumsum([len(x) // 4 for x in found], dtype=np.int64)]

    def _by_pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, at = text_bytes(column)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        first = np.zeros(len(raw), bool)
        first[at[:-1][np.diff(at) > 0]] = True
        cut = self._cuts(raw, first)
        if not self._words:
            for i in touching(raw, at):
                cut[at[i] + 1 : at[i + 1]] = False
        edge = np.r_[np.flatnonzero(cut), len(raw)]
        whole = np.ascontiguousarray(raw)
        out, per = [], []
        for lo in range(0, len(edge) - 1, PIECES):
            own = edge[lo : lo + PIECES + 1]
            a, b = int(own[0]), int(own[-1])
            pieces = pa.Array.from_buffers(pa.large_string(), len(own) - 1, [None, pa.py_buffer(own - a), pa.py_buffer(whole[a:b])])
            coded = pieces.dictionary_encode()
            known = self._learnt(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            size = np.fromiter(map(len, known), np.int64, len(known)) // 4
            flat, start = np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size
            which = coded.indices.to_numpy()
            out.append(flat[ragged(start[which], size[which])])
            per.append(size[which])
        before = np.r_[0, np.cumsum(np.concatenate(per))]
        return np.concatenate(out), before[np.searchsorted(edge, at)]


def binaries(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The ids of each text as little-endian bytes, over one buffer."""
    data = np.ascontiguousarray(ids, "<u4")
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets * 4), pa.py_buffer(data)]).cast(pa.binary())


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of binaries."""
    raw, at = text_bytes(column)
    return np.ascontiguousarray(raw).view("<u4"), at // 4


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
