"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger row keeps the measurements and a
failure bit per rule.  A policy is a named, versioned set of rule bits, applied to the
ledger later without reading a text again, and ablations are bitwise aggregates of it.

Edge cases: a null text has no words and fails ``few_words``; null ids, repeated rows and
extra columns pass through row by row, but for own columns with a measurement's name or ``fail_bits``, which the
ledger's replace (`keep_documents` keeps them); an empty table gives an empty ledger.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

#: Rule name -> failure condition on the measurements, in bit order.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
    "repeated_lines": "10 * n_dup_lines > 6 * n_lines",
    "shouting": "2 * n_upper_words > n_words",
    "many_words": "n_words > 100000",
    "few_letters": "10 * n_letter_words < 8 * n_words",
    "numbers": "10 * n_number_words > 3 * n_words",
    "single_letters": "2 * n_single_words > n_words",
    "long_word": "longest_word > 1000",
    "links": "10 * n_link_words > n_words",
    "braces": "20 * n_braces > n_words",
    "no_common_words": "100 * n_common_words < n_words",
    "one_word": "10 * n_top_word > 3 * n_words",
    "few_distinct": "n_words >= 50 and n_words <= 2000 and 10 * n_distinct_words < n_words",
    "short_lines": "n_lines >= 5 and 2 * n_short_lines > n_lines",
    "bullets": "10 * n_bullet_lines > 9 * n_lines",
    "ellipses": "10 * n_ellipsis_lines > 3 * n_lines",
    "no_sentence_ends": "n_lines >= 5 and n_ended_lines = 0",
    "repeated_line_text": "10 * dup_line_bytes > 3 * text_bytes",
    "repeated_fives": "100 * n_repeat_fives > 30 * n_words",
    "filler": "n_fillers > 0",
}
BASE = ("few_words", "repeated_words")
#: Policy version -> the rules that reject a document.
STRICT = (*BASE, "symbols", "word_length", "repeated_lines", "shouting")
POLICIES = {"base-1": BASE, "strict-1": STRICT, "web-1": tuple(RULES)}

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words",
    "n_letter_words", "n_number_words", "n_single_words", "longest_word", "n_link_words", "n_braces", "n_common_words", "n_top_word", "n_distinct_words",
    "n_short_lines", "n_bullet_lines", "n_ellipsis_lines", "n_ended_lines", "dup_line_bytes", "text_bytes", "n_repeat_fives", "n_fillers",
)
#: So many measures are enough for the rules of STRICT.
FIRST = 7
_SPACE, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"

# Frequent words of English, German, French and Spanish; filler text.
COMMON = ("a", "and", "are", "be", "for", "have", "in", "is", "of", "that", "the", "this", "to", "was", "with", "auf", "das", "der", "die", "ein", "für", "ist", "mit", "nicht", "und", "von", "zu", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "pour", "que", "un", "une", "con", "del", "el", "es", "las", "los", "no", "por", "se", "una", "y")
FILLER = "lorem ipsum"
# End of fixed values.

_COMMON = frozenset(w.encode() for w in COMMON)
_LETTER = re.compile(b"[A-Za-z\x80-\xff]").search
_ENDS, _BULLETS, _ELLIPSES = (b".", b"!", b"?", b'"'), (b"-", b"*", "•".encode()), (b"...", "…".encode())
_LINKS = (b"http://", b"https://", b"www.")
#: Kinds of words, as bits; a word may be several.
_KINDS = ("letter", "number", "single", "link", "common")


class _Kinds(dict):
    """The kinds of words seen so far."""

    def __missing__(self, w: bytes) -> int:
        if len(w) > 9 and w.isalpha():  # letters of ASCII, more than any common word has
            kind = 1
        else:
            is_ = (_LETTER(w) is not None, w.isdigit(), len(w) < 5 and len(w.decode()) == 1, w.startswith(_LINKS), w.lower().strip(b".,;:!?") in _COMMON)
            kind = sum([1 << i for i, yes in enumerate(is_) if yes])
        self[w] = kind
        return kind


def _repeated(words: list[bytes], width: int) -> int:
    """Words in windows of so many words that the text has twice or more."""
    windows = list(zip(*(words[k:] for k in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = last = 0
    for i, w in enumerate(windows):
        if w in often:
            repeated += i + width - max(i, last)
            last = i + width
    return repeated


def measure(text: str | None, kinds: dict[bytes, int] | None = None, first: bool = False) -> tuple[int, ...]:
    """MEASURES of one text (or the FIRST of them); words are runs of other than ASCII white space.  kinds: a _Kinds shared by texts."""
    if not text:
        return (0,) * (FIRST if first else len(MEASURES))
    raw = text.encode()
    words = raw.split()
    spaces = sum(raw.count(b) for b in _SPACE)
    symbols = sum(raw.count(b) for b in _SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = _repeated(words, 3)
    distinct = set(lines)
    basic = len(words), len(text) - spaces, symbols, len(lines) - len(distinct), repeated, len(lines), sum(map(bytes.isupper, words))
    if first:
        return basic
    kinds = _Kinds() if kinds is None else kinds
    counts = Counter(words)
    tally: dict[int, int] = {}
    for kind, n in zip(map(kinds.__getitem__, counts), counts.values()):
        tally[kind] = tally.get(kind, 0) + n
    letter, number, single, link, common = (sum(n for kind, n in tally.items() if kind >> i & 1) for i in range(len(_KINDS)))
    again = sum(map(len, lines)) - sum(map(len, distinct)) if len(distinct) < len(lines) else 0
    bare = [line.strip() for line in lines]
    return (
        *basic,
        letter, number, single, max(map(len, counts), default=0), link, raw.count(b"{") + raw.count(b"}"), common, max(counts.values(), default=0), len(counts),
        sum(len(x.split(None, 3)) < 3 for x in bare), sum(x.startswith(_BULLETS) for x in bare), sum(x.endswith(_ELLIPSES) for x in bare), sum(x.endswith(_ENDS) for x in bare),
        again, len(raw), _repeated(words, 5) if repeated else 0, raw.lower().count(FILLER.encode()),
    )


def bits(names) -> int:
    return sum(1 << i for i, name in enumerate(RULES) if name in names)


def ledger(docs: DataFrame, text: str = "text", first: bool = False) -> DataFrame:
    """docs with MEASURES (long) and fail_bits (int); the text column is read once and left out.

    first: only the FIRST measures and the rules of STRICT, the bits of the others being 0.
    """
    measures = MEASURES[:FIRST] if first else MEASURES
    keep = [f for f in docs.schema.fields if f.name not in {text, "fail_bits", *MEASURES}]
    src = docs.select(*(F.col(f"`{f.name}`") for f in keep), F.col(f"`{text}`").cast("string").alias(text))
    names = [f.name for f in keep]

    def run(batches):
        for batch in slices(batches, text):
            kinds = _Kinds()
            rows = [measure(x, kinds, first) for x in batch.column(len(names)).to_pylist()]
            found = [pa.array(v, pa.int64()) for v in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *found], [*names, *measures])

    schema = src.select(*(F.col(f"`{n}`") for n in names)).schema
    for m in measures:
        schema = schema.add(m, "long")
    out = src.mapInArrow(run, schema)
    failed = sum((F.expr(f"if({rule}, {1 << i}, 0)") for i, (name, rule) in enumerate(RULES.items()) if not first or name in STRICT), F.lit(0))
    return out.withColumn("fail_bits", failed)


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger written to the shared folder and read back: policies and ablations need no text after that."""
    return materialize(ledger(docs), "ledger")


def passes(policy: str, fail_bits: str = "fail_bits") -> Column:
    return F.col(fail_bits).bitwiseAND(bits(POLICIES[policy])) == 0


def ablation(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and how many more the policy keeps without it.

    One pass: counts per distinct bit pattern first, then bitwise sums over those few rows.
    """
    mask = bits(POLICIES[policy])
    patterns = led.groupBy(F.col("fail_bits").bitwiseAND(mask).alias("b")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << i).alias("bit")) for i, name in enumerate(RULES) if name in POLICIES[policy]))
    each = patterns.select("b", "n", F.explode(rules).alias("r")).select("b", "n", "r.rule", "r.bit")
    hit = F.col("b").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("b") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("b") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )


def keep_documents(docs: DataFrame, policy: str = "strict-1") -> DataFrame:
    """The rows of docs that pass the policy, columns unchanged."""
    led = ledger(docs.withColumn("__row", F.struct(*(F.col(f"`{c}`") for c in docs.columns))).select("__row", "text"), first=set(POLICIES[policy]) <= set(STRICT))
    return led.where(passes(policy)).select("__row.*")
