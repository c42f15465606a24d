"""DuckDB SQL over the driver tables with the same rows as the queries."""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS least FROM win GROUP BY win),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(generate_series(i, i + 12)) AS p
        FROM win JOIN firsts USING (win) WHERE least < doc_id)
  GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM words LEFT JOIN gone USING (doc_id)
  WHERE ps IS NULL OR NOT list_contains(ps, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8 = r"""
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
phrase AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM phrase),
spots AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d),
occ AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM spots, lens WHERE i + n - 1 <= len(w))
  JOIN phrase USING (n, p)),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS q FROM (SELECT DISTINCT doc_id, i, n FROM occ))
  GROUP BY doc_id),
own AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""

# Texts as hexadecimal strings, two letters a byte; runs of 200 bytes by md5.
OP7 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
part AS (
  SELECT doc_id, 500 * p AS base, substring(h, 1000 * p + 1, 1398) AS hp, least(500, n - 199 - 500 * p) AS m
  FROM (SELECT doc_id, h, n, unnest(range(0, (n - 199 + 499) // 500)) AS p FROM d WHERE n >= 200)),
pos AS (
  SELECT doc_id, base + j AS i, md5(substring(hp, 2 * j + 1, 400)) AS k
  FROM (SELECT doc_id, base, hp, unnest(range(0, m)) AS j FROM part)),
rep AS (SELECT doc_id, i FROM pos JOIN (SELECT k FROM pos GROUP BY k HAVING count(*) > 1) USING (k)),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM rep),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked) GROUP BY doc_id, g),
pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM spans
  UNION ALL SELECT doc_id, max(b), max(n) FROM spans JOIN d USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS kh
  FROM pieces JOIN d USING (doc_id) WHERE e > s GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE coalesce(kh, '') END)) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Whether each line is above the limits of its host; words of 3-word windows.
OP11 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (
  SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line, unnest(generate_series(1, len(string_split(t, chr(10))))) AS place FROM d),
worded AS (
  SELECT doc_id, source, place, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw,
    translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
hosts AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
frequent AS (
  SELECT f.source, f.norm
  FROM (SELECT source, norm, count(DISTINCT doc_id) AS n FROM worded GROUP BY source, norm) f
  JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE n > 10 AND n * 1000 > docs),
gone AS (
  SELECT doc_id, sum(len(lw)) AS removed
  FROM worded w JOIN frequent f ON w.norm = f.norm AND w.source IS NOT DISTINCT FROM f.source GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM worded GROUP BY doc_id),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_rep
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM win JOIN (SELECT doc_id, win FROM win GROUP BY doc_id, win HAVING count(*) > 1) USING (doc_id, win))
  GROUP BY doc_id),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed_words <= n_words AS kept
FROM base
"""


def _crc32(text: str) -> str:
    """CRC-32 of a string of ASCII letters, bit by bit."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_transform(range(0, 8), lambda j: (unicode(substr({text}, i, 1)) >> j) & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"


def _made(state: str, role: str, cost: int, letter: str, text: str = "''") -> str:
    """An edit in front of the edits of a later state."""
    return f"{{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a, 'o': list_prepend('{role}:' || {text}, {state}.o)}}"


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


_NO = "CASE WHEN {} THEN {} ELSE {{'c': 1000000000::BIGINT, 'a': '', 'o': []::VARCHAR[]}} END"


def _consumed(state: int) -> str:
    """The cheapest edit that uses up the row, from one state."""
    to = (2, 2, 3, 2)[state]
    role = "assistant" if to == 3 else "user"
    keeps = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}[state]
    more = "CASE WHEN cut THEN 5 ELSE 0 END"
    options = [f"{{'c': s{state}.c + 2, 'a': 'D' || s{state}.a, 'o': s{state}.o}}",
               _NO.format("NOT gone", f"{{'c': s{to}.c + 1 + {more}, 'a': 'R' || s{to}.a, 'o': list_prepend('{role}:' || text, s{to}.o)}}")]
    options += [_NO.format(f"NOT gone AND left(role, 1) = '{x}'", f"{{'c': s{q}.c + {more}, 'a': 'K' || s{q}.a, 'o': list_prepend(role || ':' || text, s{q}.o)}}") for x, q in keeps]
    return _least(*options)


OP12 = rf"""
WITH RECURSIVE hit AS (
  SELECT *, {_crc32("key")} % 20 AS kind
  FROM (SELECT conv_id, turn, role, text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations)),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE kind <> 0),
placed AS (
  SELECT conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(role, 1, 256), substr(text, 1, 256), sha256(strlen(role) || ':' || role || text)) AS i
  FROM hurt),
marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ends,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM placed),
rows AS (SELECT *, blank OR again AS gone, ends AND NOT blank AND NOT again AS cut FROM marked),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (i > 1 AND coalesce(pair, '') NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS s0, {{'c': 10::BIGINT, 'a': 'II', 'o': ['user:', 'assistant:']}} AS s1,
    {{'c': 5::BIGINT, 'a': 'I', 'o': ['assistant:']}} AS s2, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS s3
  FROM counts
  UNION ALL
  SELECT conv_id, i - 1, {_least("s0", _made("u", "user", 5, "I"))}, {_least("s1", _made("u", "user", 5, "I"))}, u, s3
  FROM (
    SELECT conv_id, i, s0, s1, {_least("s2", _made("s3", "assistant", 5, "I"))} AS u, s3
    FROM (
      SELECT conv_id, i, s0, s1, s2, {_least("s3", _made("u0", "user", 5, "I"))} AS s3
      FROM (
        SELECT *, {_least("s2", _made("s3", "assistant", 5, "I"))} AS u0
        FROM (
          SELECT w.conv_id, w.i, {_consumed(0)} AS s0, {_consumed(1)} AS s1, {_consumed(2)} AS s2, {_consumed(3)} AS s3
          FROM walk w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.i = r.i)))))
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.s0.c, 0) AS cost, coalesce(w.s0.a, '') AS audit,
  sha256(coalesce(array_to_string(w.s0.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk w ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = 0
"""

_LEAF = "sha256({} || {} || {} || {} || {})".format(*(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "text")))

OP13 = rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_LEAF} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_LEAF.replace("CAST(text AS VARCHAR)", "replace(text, chr(10), '')")} ELSE {_LEAF} END AS shown
  FROM documents),
placed AS (
  SELECT *, coalesce('s' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
roots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, n, h FROM roots
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
sides AS (
  SELECT tree, lvl, pos, coalesce(lag(h, 2) OVER r, '') || coalesce(lag(h, 1) OVER r, '') AS l, coalesce(lead(h, 1) OVER r, '') || coalesce(lead(h, 2) OVER r, '') AS r
  FROM nodes WHERE n > 1 WINDOW r AS (PARTITION BY tree, lvl, pos // 3 ORDER BY pos)),
top_sides AS (
  SELECT lvl, pos, coalesce(lag(h, 2) OVER r, '') || coalesce(lag(h, 1) OVER r, '') AS l, coalesce(lead(h, 1) OVER r, '') || coalesce(lead(h, 2) OVER r, '') AS r
  FROM top WHERE n > 1 WINDOW r AS (PARTITION BY lvl, pos // 3 ORDER BY pos)),
levels AS (SELECT unnest(range(0, 40)) AS lvl),
below AS (
  SELECT p.tree, p.pos, list(s.l || ',' || s.r ORDER BY s.lvl) AS steps
  FROM placed p, levels v JOIN sides s ON s.tree = p.tree AND s.lvl = v.lvl AND s.pos = p.pos // CAST(pow(3, v.lvl) AS BIGINT) GROUP BY p.tree, p.pos),
above AS (
  SELECT p.tree, list(s.l || ',' || s.r ORDER BY s.lvl) AS steps
  FROM roots p, levels v JOIN top_sides s ON s.lvl = v.lvl AND s.pos = p.pos // CAST(pow(3, v.lvl) AS BIGINT) GROUP BY p.tree),
paths AS (
  SELECT p.doc_id, p.leaf, p.shown, q.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, list_concat(coalesce(b.steps, []), coalesce(a.steps, [])) AS steps
  FROM placed p JOIN roots q ON q.tree = p.tree LEFT JOIN below b ON b.tree = p.tree AND b.pos = p.pos LEFT JOIN above a ON a.tree = p.tree),
folded AS (
  SELECT *, list_reduce(list_prepend(shown, steps), lambda f, s: sha256(split_part(s, ',', 1) || f || split_part(s, ',', 2))) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), ',', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""
