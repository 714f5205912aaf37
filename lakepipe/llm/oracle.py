"""DuckDB SQL for the operators that SQL can express.

Not expressed: 1 (boosted trees), 2 (signatures), 3 (largest-first dealing,
CRC-32), 4 (diagonal runs), 8 (gradient descent), 12 (message passing).  Tests
compare these with brute-force versions, or judge them on held-out rows.
"""

from __future__ import annotations

from lakepipe.llm import fm_index, k2_treap, mix_blocks, recompress, repetition, spelling

PLAIN = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Documents numbered, with their words.
DOCS = f"""d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source,
  regexp_extract_all(coalesce(text, ''), '{PLAIN}') AS ws FROM documents)"""


def _windows(n: int, words: str = "ws", table: str = "d") -> str:
    """Row, first place (from 1) and content of all runs of n words."""
    return f"""SELECT r, i, md5(array_to_string({words}[i:i + {n - 1}], ' ')) AS h FROM (
      SELECT r, {words}, unnest(range(1, len({words}) - {n - 2})) AS i FROM {table} WHERE len({words}) >= {n})"""


def _repetition() -> str:
    grams = sorted({*repetition.COVER_LIMITS, repetition.BASE_GRAM})
    parts, joins = [], []
    for n in grams:
        parts.append(f"""w{n} AS ({_windows(n)}),
  c{n} AS (SELECT r, count(*) AS words, sum(length(ws[p])) AS chars FROM (
    SELECT DISTINCT r, unnest(range(i, i + {n})) AS p FROM w{n}
    JOIN (SELECT r, h FROM w{n} GROUP BY r, h HAVING count(*) > 1) USING (r, h)) JOIN d USING (r) GROUP BY r)""")
        joins.append(f"LEFT JOIN c{n} USING (r)")
    cover = {n: f"coalesce(c{n}.chars, 0) / greatest(word_chars, 1)::DOUBLE" for n in repetition.COVER_LIMITS}
    b = repetition.BASE_GRAM
    failed = f"(n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.BASE_PERCENT} * n_words)"
    good = " AND ".join([f"dup_line_share <= {repetition.LINE_LIMIT}", *[f"cover_{n} <= {x}" for n, x in repetition.COVER_LIMITS.items()]])
    return f"""WITH {DOCS}, {', '.join(parts)},
  l AS (SELECT r, line, row_number() OVER (PARTITION BY r, line) > 1 AS again FROM (
    SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{PLAIN}')),
  ls AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(length(line)) FILTER (again), 0) AS dup,
    sum(length(line)) AS chars FROM l GROUP BY r),
  m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(c{b}.words, 0)::BIGINT AS n_repeat_words, coalesce(dup, 0) / greatest(coalesce(ls.chars, 0), 1)::DOUBLE AS dup_line_share,
    {', '.join(f'{x} AS cover_{n}' for n, x in cover.items())} FROM d {' '.join(joins)} LEFT JOIN ls USING (r))
SELECT *, {failed} AS base_failed, NOT {failed} AND {good} AS kept FROM m"""


_N = recompress.WINDOW
_REPEATS = f"""WITH {DOCS}, w AS ({_windows(_N)}),
  gone AS (SELECT DISTINCT r, unnest(range(i, i + {_N})) AS p FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
  kept AS (SELECT r, string_agg(ws[p], ' ' ORDER BY p) AS text FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)
    ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) USING (r) LEFT JOIN kept USING (r)"""

_M = fm_index.WINDOW
_CONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LETTERS}') AS ws FROM documents),
  b AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LETTERS}') AS ws FROM benchmark),
  g AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS h FROM (
    SELECT item, ws, least(len(ws), {_M}) AS n, unnest(range(1, greatest(len(ws) - {_M - 1}, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
  w AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS h FROM (
    SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM g) ON len(ws) >= n)),
  o AS (SELECT r, n, i, item FROM w JOIN g USING (n, h)),
  hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM o) GROUP BY r),
  named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {fm_index.ONE_IN} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

_B, _PRIMES = mix_blocks.BLOCK_WORDS, mix_blocks.PRIMES
_MIX = f"""WITH {DOCS},
  t AS (SELECT r, doc_id, source, len(ws)::BIGINT AS size, md5(text) AS k,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(text)), 1, 12))::BIGINT AS place FROM d),
  s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM t GROUP BY source),
  s1 AS (SELECT *, [{', '.join(map(str, mix_blocks.WEIGHTS))}][number % {len(mix_blocks.WEIGHTS)} + 1] AS weight,
    {mix_blocks.MOST_TIMES} * source_size AS cap FROM s0),
  s2 AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among FROM s1),
  s3 AS (SELECT *, cap * among <= rest * weight AS isfull FROM s2),
  s4 AS (SELECT *, max(CASE WHEN NOT isfull THEN rest::DOUBLE / among::DOUBLE END) OVER () AS share FROM s3),
  s AS (SELECT source, number, source_size, CASE WHEN isfull THEN cap::DOUBLE ELSE share * weight END AS target,
    CAST(ceil(source_size / {_B}.0) AS BIGINT) AS blocks FROM s4),
  z AS (SELECT *, CASE WHEN blocks > 0 THEN CAST(floor(target * blocks / source_size + 0.5) AS BIGINT) ELSE 0 END AS slots FROM s),
  p AS (SELECT t.*, number, coalesce(sum(size) OVER (PARTITION BY number ORDER BY place & {mix_blocks.RANGES - 1}, place, doc_id NULLS FIRST, k, r
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM t JOIN z ON t.source IS NOT DISTINCT FROM z.source WHERE size > 0),
  g AS (SELECT number, r, block, least(a + size, (block + 1) * {_B}) - greatest(a, block * {_B}) AS words FROM (
    SELECT *, unnest(range(a // {_B}, (a + size - 1) // {_B} + 1)) AS block FROM p)),
  q AS (SELECT number, blocks, slot // blocks AS turn, slot % blocks AS x FROM (
    SELECT number, blocks, unnest(range(0, slots)) AS slot FROM z WHERE slots > 0)),
  f AS (SELECT DISTINCT number, blocks, turn, list_filter([{', '.join(map(str, _PRIMES))}], lambda v: blocks % v <> 0) AS fit FROM q),
  times AS (SELECT number, (fit[(number + turn) % len(fit) + 1] * x + (number * 7919 + turn * 104729 + 1) * 1299709) % blocks AS block, count(*) AS n
    FROM q JOIN f USING (number, blocks, turn) GROUP BY 1, 2),
  took AS (SELECT r, sum(words * n) AS taken FROM g JOIN times USING (number, block) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM t JOIN z ON t.source IS NOT DISTINCT FROM z.source LEFT JOIN took USING (r)"""


def _canonical(url: str) -> str:
    rest = f"regexp_replace(regexp_replace({url}, '#[\\s\\S]*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    host = f"regexp_replace(regexp_replace(lower(regexp_extract({rest}, '^[^/?]*', 0)), '^www\\.', ''), ':(80|443)$', '')"
    path = f"regexp_replace(regexp_extract({rest}, '^[^/?]*([^?]*)', 1), '/+$', '')"
    query = (f"regexp_replace(regexp_replace(regexp_extract({rest}, '^[^?]*\\?([\\s\\S]*)$', 1), "
             f"'(^|&)(utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&', '')")
    return f"{host} || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END"


_REVISITS = f"""WITH p AS (SELECT page_id AS p, {_canonical('url')} AS u, substr(md5(coalesce(html, '')), 1, 16) AS tag, page_id * 97 AS time FROM pages),
  res AS (SELECT u, time, max({{'id': p * 2, 'tag': tag, 'modified': time - p % 13, 'p': p}}) AS x FROM p GROUP BY u, time),
  rev AS (SELECT p * 2 + 1 AS record_id, u, p, CASE WHEN p % 11 = 0 THEN time - 50 ELSE time + (p % 7 + 1) * 3600 END AS later,
    CASE WHEN p % 5 = 0 THEN 'other' WHEN p % 5 = 1 THEN NULL ELSE tag END AS tag, time - p % 13 AS modified FROM p),
  j AS (SELECT rev.*, res.time AS had, res.x FROM rev ASOF LEFT JOIN res ON rev.u = res.u AND rev.later > res.time),
  v AS (SELECT *, CASE WHEN had IS NULL THEN 'missing' WHEN CASE WHEN tag IS NOT NULL THEN tag = x.tag ELSE modified = x.modified END
    THEN 'resolved' ELSE 'changed' END AS verdict FROM j)
SELECT record_id, u AS canonical_url, CASE WHEN verdict = 'resolved' THEN x.id END AS response_id, verdict,
  CASE WHEN verdict = 'resolved' THEN 'cache-control=max-age=60;content-type=text/html;date=' || later || ';etag="' || x.tag
    || '";server=s' || (x.p % 3) END AS headers FROM v"""

_K = k2_treap
_RANKED = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LETTERS}') AS ws FROM documents),
  s AS (SELECT count(*) FILTER (len(ws) > 0) AS n, sum(len(ws))::BIGINT AS l FROM d),
  q AS (SELECT i, item_id, unnest(list_distinct(ws)) AS term FROM (SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LETTERS}') AS ws FROM benchmark)),
  t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  w AS (SELECT term, floor({_K.WEIGHT} * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
  c AS (SELECT i, item_id, r, doc_id, sum(w * (({_K.SCALE} * tf) // ({_K.SATURATE} * tf + {_K.LENGTH} * ({_K.M_BASE} + ({_K.M_SHARE} * t.n * s.n) // s.l))))::BIGINT AS score
    FROM q JOIN t USING (term) JOIN w USING (term), s GROUP BY ALL HAVING score > 0),
  k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= {_K.TOP}"""

#: CRC-32 by its table, as DuckDB has no function for it.
_S = spelling
_SPELLING = f"""WITH t AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
  r AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run, FROM documents),
  l AS (SELECT head, translate(run, '{UPPER}', '{LOWER}') AS run FROM r WHERE length(run) >= {_S.MIN_LETTERS}),
  u AS (SELECT head, run, count(*) AS k, hex(encode(head || run)) AS x FROM l GROUP BY head, run),
  h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM u, t),
  w AS (SELECT CASE WHEN h % {_S.TYPO_IN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n
    FROM h GROUP BY 1 HAVING length(word) >= {_S.MIN_LETTERS} AND sum(k) >= {_S.MIN_COUNT}),
  p AS (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM w),
  g AS (SELECT DISTINCT word, n, substr(word, 1, i) || substr(word, i + 2) AS cut FROM p WHERE i < length(word)),
  s AS (SELECT word, n, i, substr(word, 1, i) || '*' || substr(word, i + 2) AS hole FROM p WHERE i < length(word)),
  e AS (SELECT a.word, b.word AS other, b.n AS m FROM s a JOIN s b USING (hole) WHERE a.word <> b.word
    UNION ALL SELECT g.word, w.word, w.n FROM g JOIN w ON g.cut = w.word UNION ALL SELECT w.word, g.word, g.n FROM g JOIN w ON g.cut = w.word),
  b AS (SELECT word, count(*) AS n_near, first({{'w': other, 'm': m}} ORDER BY m DESC, encode(other)) AS best FROM e GROUP BY word),
  f AS (SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best.m >= {_S.FORM_TIMES} * n THEN best.w END AS form,
    CASE WHEN best.m >= {_S.FORM_TIMES} * n THEN best.m END::BIGINT AS form_n FROM w LEFT JOIN b USING (word)),
  c AS (WITH RECURSIVE c AS (SELECT word, word AS root FROM f UNION SELECT c.word, f.form FROM c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
    SELECT c.word, c.root FROM c JOIN f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN c USING (word)"""

SQL: dict[str, str] = {
    "op5_revisit_resolution": _REVISITS,
    "op6_recompression": _REPEATS,
    "op7_repetition_rules": _repetition(),
    "op9_benchmark_fm_index": _CONTAMINATION,
    "op10_block_mixture": _MIX,
    "op11_k2_treap": _RANKED,
    "op13_trie_node_pairs": _SPELLING,
}
