"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import quality

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_COMMON = ", ".join(f"'{w}'" for w in quality.COMMON)


def _repeats(width: int) -> str:
    """doc_id, n: words in windows of so many that the text has twice or more."""
    window = " || chr(10) || ".join(f"w[i + {k}]" for k in range(width))
    return f"""(WITH g AS (SELECT doc_id, i, {window} AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS i FROM d)),
  m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM g) WHERE n > 1)
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + {width})) AS j FROM m) GROUP BY doc_id)"""


_BITS = " + ".join(f"{1 << i} * ({rule})::INT" for i, rule in enumerate(quality.RULES.values()))
_POLICY = f"(fail_bits & {quality.bits(quality.STRICT)}) = 0"
OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
l AS (SELECT doc_id, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
li AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (n < 3) AS n_short_lines, count(*) FILTER (bare[1] IN ('-', '*', '•')) AS n_bullet_lines,
  count(*) FILTER (suffix(bare, '...') OR suffix(bare, '…')) AS n_ellipsis_lines, count(*) FILTER (bare[-1] IN ('.', '!', '?', '"')) AS n_ended_lines FROM l GROUP BY doc_id),
lr AS (SELECT doc_id, sum((k - 1) * strlen(line))::BIGINT AS dup_line_bytes FROM (SELECT doc_id, line, count(*) AS k FROM l GROUP BY 1, 2) GROUP BY doc_id),
u AS (SELECT doc_id, v, count(*) AS k FROM (SELECT doc_id, unnest(w) AS v FROM d) GROUP BY 1, 2),
wo AS (SELECT doc_id, sum(k * length(v)) AS word_chars, sum(k) FILTER (regexp_matches(v, '[A-Z]') AND NOT regexp_matches(v, '[a-z]')) AS n_upper_words,
  sum(k) FILTER (regexp_matches(v, '[A-Za-z]|[^\x00-\x7F]')) AS n_letter_words, sum(k) FILTER (regexp_full_match(v, '[0-9]+')) AS n_number_words, sum(k) FILTER (length(v) = 1) AS n_single_words,
  max(strlen(v)) AS longest_word, sum(k) FILTER (prefix(v, 'http://') OR prefix(v, 'https://') OR prefix(v, 'www.')) AS n_link_words,
  sum(k) FILTER (trim({_LOWER.format("v")}, '.,;:!?') IN ({_COMMON})) AS n_common_words, max(k) AS n_top_word, count(*) AS n_distinct_words FROM u GROUP BY doc_id),
x AS (SELECT doc_id, len(w) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(r3.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_upper_words, 0)::BIGINT AS n_upper_words, coalesce(n_letter_words, 0)::BIGINT AS n_letter_words,
  coalesce(n_number_words, 0)::BIGINT AS n_number_words, coalesce(n_single_words, 0)::BIGINT AS n_single_words, coalesce(longest_word, 0)::BIGINT AS longest_word, coalesce(n_link_words, 0)::BIGINT AS n_link_words,
  length(regexp_replace(t, '[^{{}}]', '', 'g')) AS n_braces, coalesce(n_common_words, 0)::BIGINT AS n_common_words, coalesce(n_top_word, 0)::BIGINT AS n_top_word, coalesce(n_distinct_words, 0)::BIGINT AS n_distinct_words,
  coalesce(n_short_lines, 0) AS n_short_lines, coalesce(n_bullet_lines, 0) AS n_bullet_lines, coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines, coalesce(n_ended_lines, 0) AS n_ended_lines,
  coalesce(dup_line_bytes, 0) AS dup_line_bytes, strlen(t)::BIGINT AS text_bytes, coalesce(r5.n, 0) AS n_repeat_fives,
  ((strlen(t) - strlen(replace({_LOWER.format("t")}, '{quality.FILLER}', ''))) // {len(quality.FILLER)})::BIGINT AS n_fillers
  FROM d LEFT JOIN li USING (doc_id) LEFT JOIN lr USING (doc_id) LEFT JOIN wo USING (doc_id) LEFT JOIN {_repeats(3)} r3 USING (doc_id) LEFT JOIN {_repeats(5)} r5 USING (doc_id)),
b AS (SELECT *, ({_BITS})::INT AS fail_bits FROM x)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, {_POLICY} AS kept FROM b
"""

#: Bytes as hex digits, two each, in pieces of 300 places: every string of 50 with the least document that has it, then islands of covered bytes and the gaps between them.
OP4 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
q AS (SELECT doc_id, n, pos, substr(h, 2 * pos + 1, 698) AS h FROM (SELECT doc_id, h, n, unnest(range(0, n - 49, 300)) AS pos FROM d WHERE n >= 50)),
g AS (SELECT doc_id, pos + i AS i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, pos, h, unnest(range(least(300, n - 49 - pos))) AS i FROM q)),
l AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT g.doc_id, i FROM g JOIN l USING (s) WHERE l.first < g.doc_id),
e AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM c),
r AS (SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e) GROUP BY doc_id, run),
k AS (SELECT r.doc_id, count(*) AS n_spans, sum(hi - lo)::BIGINT AS n_removed, list(struct_pack(lo := lo, hi := hi) ORDER BY lo) AS runs FROM r GROUP BY r.doc_id),
p AS (SELECT d.doc_id, n, n_removed, n_spans, h, list_zip(list_prepend(0, list_transform(runs, lambda x: x.hi)), list_append(list_transform(runs, lambda x: x.lo), n)) AS kept FROM d LEFT JOIN k USING (doc_id))
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
 sha256(CASE WHEN n_spans IS NULL THEN unhex(h) ELSE unhex(array_to_string(list_transform(kept, lambda x: substr(h, (2 * x[1] + 1)::BIGINT, (2 * (x[2] - x[1]))::BIGINT)), '')) END) AS kept_sha256
FROM p
"""

def _ablation(policy: str) -> str:
    names = [n for n in quality.RULES if n in quality.POLICIES[policy]]
    mask = quality.bits(names)
    return f"""
WITH led AS ({OP5}), r AS (SELECT unnest({names}) AS rule, unnest({[quality.bits([n]) for n in names]}) AS bit)
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits & {mask} = bit) AS n_failed_alone, count(*) FILTER (fail_bits & {mask} = 0) AS n_kept FROM led, r GROUP BY rule
"""


ABLATION, WEB_ABLATION = _ablation("strict-1"), _ablation("web-1")

_U = "((('0x' || substr(md5(doc_id::VARCHAR || '|' || {path}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def _draw(path: str, children: str) -> str:
    """The child of least -ln(u) / w; children: SQL list of structs (c, w)."""
    u = _U.format(path=f"{path} || '>' || v.c::VARCHAR")
    return f"list_sort(list_transform({children}, lambda v: {{'d': -ln({u}) / v.w, 'c': v.c}}))[1].c"


def _tree(extra: bool) -> str:
    top = "[{'c': 0, 'w': 12.0::DOUBLE}, {'c': 1, 'w': 12.0::DOUBLE}" + (", {'c': 2, 'w': 1.0::DOUBLE}]" if extra else "]")
    racks = "CASE WHEN r = 2 THEN [{'c': 0, 'w': 1.0::DOUBLE}] ELSE [{'c': 0, 'w': 4.0::DOUBLE}, {'c': 1, 'w': 4.0::DOUBLE}, {'c': 2, 'w': 4.0::DOUBLE}] END"
    leaves = "CASE WHEN r = 2 THEN [{'c': 24, 'w': 1.0::DOUBLE}] ELSE list_transform([0, 1, 2, 3], lambda i: {'c': ((r * 3 + k) * 4 + i)::INT, 'w': 1.0::DOUBLE}) END"
    step1 = f"SELECT doc_id, {_draw(repr(''), top)} AS r FROM documents"
    step2 = f"SELECT *, {_draw('r::VARCHAR', racks)} AS k FROM ({step1})"
    return f"SELECT doc_id, {_draw('r::VARCHAR || ' + repr('/') + ' || k::VARCHAR', leaves)} AS s FROM ({step2})"


#: The table of CRC-32 (reflected polynomial 0xEDB88320), and a text's CRC over it, byte by byte.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])))"

def _id_crc(doc_id: str) -> str:
    """The unsigned CRC-32 of a decimal id; tab: a column with the table."""
    return _CRC.replace("b)", f"list_transform(string_split({doc_id}::VARCHAR, ''), lambda v: ascii(v)::BIGINT))")


OP9 = f"""
WITH a AS ({_tree(False)}), b AS ({_tree(True)}),
c AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b, (SELECT {_CRC_TABLE}) AS tab FROM documents),
d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, floor(256 * ({_U.format(path="'slot'")}))::INT AS bin FROM documents)
SELECT doc_id, size, ({_CRC})::BIGINT AS text_crc32, 'key' AS law, a.s::INT AS shard, row_number() OVER (PARTITION BY a.s ORDER BY bin, doc_id) - 1 AS slot, b.s::INT AS grown_shard
FROM d JOIN a USING (doc_id) JOIN b USING (doc_id) JOIN c USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, h FROM (
  SELECT doc_id, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
  UNION ALL SELECT doc_id, array_to_string(w, chr(10)) FROM d WHERE len(w) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 90 * (nx.n + ny.n - o)),
c AS (SELECT doc_id AS v, doc_id AS r FROM d UNION SELECT e.y, c.r FROM c JOIN e ON e.x = c.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(c.r) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.v = d.doc_id GROUP BY 1, 2
"""

_STEP, _POINTS = 173961102589771, 1 << 48
OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 't') AS skey, len({_WORDS})::BIGINT AS size,
  ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS h FROM documents),
l AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY skey ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
w AS (SELECT skey, sum(size)::BIGINT AS source_size, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY skey) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY skey),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio, (sum(source_size) OVER ())::DOUBLE AS total FROM w),
v AS (SELECT *, (total - (sum(cap) OVER q - cap)) / (sum(weight) OVER () - (sum(weight) OVER q - weight)) AS level FROM r WINDOW q AS (ORDER BY ratio, skey ROWS UNBOUNDED PRECEDING)),
f AS (SELECT arg_min(level, (ratio, skey)) AS final FROM v WHERE ratio >= level),
t AS (SELECT skey, source_size, total, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * weight) END AS target FROM v, f),
e AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY skey DESC) = 1 THEN {_POINTS} ELSE floor({_POINTS}::DOUBLE * sum(target) OVER (ORDER BY skey ROWS UNBOUNDED PRECEDING) / total)::BIGINT END AS hi FROM t),
b AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY skey), 0) AS lo FROM e),
p AS (SELECT slot, ((slot::HUGEINT * {_STEP}) % {_POINTS})::BIGINT AS u FROM (SELECT unnest(range(0, (SELECT ceil(sum(size) / 64)::BIGINT FROM d))) AS slot)),
s AS (SELECT slot, skey, row_number() OVER (PARTITION BY skey ORDER BY slot) - 1 AS rank FROM p JOIN b ON u >= lo AND u < hi),
n AS (SELECT skey, count(*) AS drawn FROM s GROUP BY skey),
x AS (SELECT doc_id, l.skey, size, start, source_size, target, least(coalesce(drawn, 0) * 64, 3 * source_size) AS stop FROM l JOIN b USING (skey) LEFT JOIN n USING (skey)),
y AS (SELECT *, start + epoch * source_size AS lo FROM x, (SELECT unnest([0, 1, 2]) AS epoch)),
z AS (SELECT doc_id, size, source_size, target, skey, start, least(lo + size, stop) - lo AS got, CASE WHEN size > 0 AND lo < stop THEN lo // 64 END AS r0, (least(lo + size, stop) - 1) // 64 AS r1 FROM y)
SELECT doc_id, z.size, source_size, target, coalesce(sum(got) FILTER (r0 IS NOT NULL), 0)::BIGINT AS taken, min(slot) AS first_slot, coalesce(sum(r1 - r0 + 1), 0)::BIGINT AS n_pieces
FROM z LEFT JOIN s ON s.skey = z.skey AND s.rank = z.r0 GROUP BY doc_id, z.skey, start, z.size, source_size, target
"""

#: Runs as islands of equal words p apart, for every period p of a quarter of the document at most.
OP11 = rf"""
WITH t AS (SELECT doc_id, text, {_WORDS} AS w, (SELECT {_CRC_TABLE}) AS tab FROM documents),
h AS (SELECT doc_id, w, len(w) AS n, ({_id_crc("doc_id")})::BIGINT AS h FROM t),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM h),
e AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END) END AS w FROM a),
u AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM e),
m AS (SELECT a.doc_id, b.i - a.i AS p, a.i FROM u a JOIN u b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND b.i - a.i <= a.n // 4),
g AS (SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM m),
s AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM g GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(6, 4 * p)),
r AS (SELECT doc_id, start, length, min(p) AS period FROM s GROUP BY doc_id, start, length),
k AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS rank FROM r) WHERE rank = 1),
c AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM u WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = u.doc_id AND u.i >= r.start + r.period AND u.i < r.start + r.length) GROUP BY doc_id)
SELECT e.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
 sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256, n AS n_words
FROM e LEFT JOIN k USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_LEAF = "sha256({})".format(" || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text")))
#: Level by level: g names the tree (a language, or the tree over them), size the nodes of a level.
OP13 = f"""
WITH RECURSIVE t AS (SELECT *, (SELECT {_CRC_TABLE}) AS tab FROM documents),
d AS (SELECT doc_id, coalesce('s' || lang, '') AS g, {_LEAF.format(n_chars="n_chars")} AS leaf, {_LEAF.format(n_chars="(n_chars::HUGEINT + 1)")} AS changed, ({_id_crc("doc_id")}) % 7 = 0 AS picked FROM t),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS size FROM d),
up AS (SELECT g, 0 AS level, i, size, leaf AS node FROM l
 UNION ALL SELECT g, level + 1, i // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM up WHERE size > 1 GROUP BY g, level, i // 2, size),
s AS (SELECT g, node, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS size FROM up WHERE size = 1),
top AS (SELECT 0 AS level, i, size, node FROM s
 UNION ALL SELECT level + 1, i // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM top WHERE size > 1 GROUP BY level, i // 2, size),
n AS (SELECT g, level, i, node FROM up UNION ALL SELECT 'top', level, i, node FROM top),
walk AS (SELECT doc_id, g AS own, g, leaf, 0 AS level, i, size, '' AS siblings, CASE WHEN picked THEN changed ELSE leaf END AS folded FROM l
 UNION ALL SELECT doc_id, own, CASE WHEN w.size > 1 THEN w.g ELSE 'top' END, leaf, CASE WHEN w.size > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.size > 1 THEN w.i // 2 ELSE s.i END, CASE WHEN w.size > 1 THEN (w.size + 1) // 2 ELSE s.size END,
  CASE WHEN w.size > 1 THEN siblings || coalesce(n.node, '') ELSE siblings END,
  CASE WHEN w.size = 1 THEN folded WHEN w.i % 2 = 1 THEN sha256(n.node || folded) ELSE sha256(folded || coalesce(n.node, '')) END
 FROM walk w LEFT JOIN n ON n.g = w.g AND n.level = w.level AND n.i = xor(w.i, 1) LEFT JOIN s ON s.g = w.g WHERE w.size > 1 OR w.g <> 'top')
SELECT doc_id, leaf, s.node AS subroot, r.node AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = r.node AS verified
FROM walk w JOIN s ON s.g = w.own, (SELECT node FROM top WHERE size = 1) r WHERE w.g = 'top' AND w.size = 1
"""

EDITED = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next FROM documents)
SELECT doc_id, n AS n_chars, sha256(substr(t, 1, n - n // 3) || substr(next, 1, n // 3)) AS edited_sha256 FROM d
"""

ORACLES: dict[str, str] = {"op4_suffix_dedup": OP4, "op5_rule_ledger": OP5, "ledger_ablation": ABLATION, "web_ablation": WEB_ABLATION, "edited_texts": EDITED, "op7_golden_mix": OP7, "op9_hash_tree": OP9, "op10_toccurrence_join": OP10, "op11_periodic_runs": OP11, "op13_merkle_manifest": OP13}
