"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_HOST = "translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1, 's')"
_DOTS = (
    "CASE WHEN regexp_matches({path}, '/\\.\\.?(?:/|\\z)') THEN "
    "list_reduce(string_split({path}, '/'), lambda done, part: CASE WHEN part = '..' THEN regexp_replace(done, '/[^/]*\\z', '') "
    "WHEN part = '.' THEN done ELSE done || '/' || part END) "
    "|| CASE WHEN regexp_matches({path}, '/\\.\\.?\\z') THEN '/' ELSE '' END ELSE {path} END"
)
_NODE = (
    "CASE WHEN strpos({url}, '://') > 0 THEN lower(left({url}, strpos({url}, '://') - 1)) || '://' || "
    + _HOST
    + " || ({dotless}) || regexp_extract({rest}, '^[^?#]*(\\?[^#]*)', 1) END"
)


def _rest(url: str) -> str:
    return f"(CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) END)"


def _host(url: str) -> str:
    return _HOST.format(rest=_rest(url))


def _path(url: str) -> str:
    return _PATH.format(rest=_rest(url))


def _node(url: str) -> str:
    return _NODE.format(url=url, rest=_rest(url), dotless=_DOTS.format(path=_path(url)))


def _ruled(table: str) -> str:
    """The longest fitting rule of each distinct host and path."""
    return f"""
    SELECT DISTINCT t.host, t.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS ruling
    FROM (SELECT DISTINCT host, path FROM {table}) t JOIN rules r
      ON (t.host = r.host OR ends_with(t.host, '.' || r.host)) AND starts_with(t.path, r.path)
    GROUP BY t.host, t.path"""


ORACLE["op1_url_aliases"] = rf"""
WITH RECURSIVE rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
tags AS (SELECT url, unnest(regexp_extract_all(html, '<(?:link|meta)\b[^>]*>', 0, 'is')) AS tag FROM pages),
raw AS (
    SELECT url, trim(replace(CASE
        WHEN regexp_matches(tag, '\brel\s*=\s*["'']?\s*canonical\b', 'is')
        THEN coalesce(nullif(regexp_extract(tag, '\bhref\s*=\s*"([^"]*)"', 1, 'is'), ''),
                      nullif(regexp_extract(tag, '\bhref\s*=\s*''([^'']*)''', 1, 'is'), ''),
                      nullif(regexp_extract(tag, '\bhref\s*=\s*([^\s>"'']+)', 1, 'is'), ''))
        WHEN regexp_matches(tag, '\bhttp-equiv\s*=\s*["'']?\s*refresh\b', 'is')
        THEN regexp_extract(tag, '\bcontent\s*=\s*["'']?[^"''>;]*;\s*url\s*=\s*["'']?([^"''>]*)', 1, 'is')
        END, '&amp;', '&')) AS link FROM tags),
resolved AS (
    SELECT url, CASE
        WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN link
        WHEN strpos(url, '://') = 0 OR link = '' OR regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN NULL
        WHEN starts_with(link, '//') THEN left(url, strpos(url, '://')) || link
        WHEN starts_with(link, '/') THEN left(url, strpos(url, '://') + 2) || {_host("url")} || link
        WHEN starts_with(link, '?') THEN left(url, strpos(url, '://') + 2) || {_host("url")} || {_path("url")} || link
        WHEN starts_with(link, '#') THEN url
        ELSE left(url, strpos(url, '://') + 2) || {_host("url")}
             || coalesce(nullif(regexp_replace({_path("url")}, '[^/]*\z', ''), ''), '/') || link END AS target
    FROM raw WHERE link IS NOT NULL),
edges AS (SELECT DISTINCT a, b FROM (SELECT {_node("url")} AS a, {_node("target")} AS b FROM resolved)
          WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
    SELECT a, a FROM both_ways
    UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
reached AS (SELECT node, other, {_host("other")} AS host, {_path("other")} AS path FROM reach),
reached_rules AS ({_ruled("reached")}),
parts AS (SELECT page_id, coalesce({_host("url")}, '') AS host, coalesce({_path("url")}, '') AS path, {_node("url")} AS node FROM pages),
part_rules AS ({_ruled("parts")}),
aliases AS (
    SELECT node, min(other) AS alias, bool_or(coalesce(ruling = 'allow', false)) AS allowed,
           bool_or(coalesce(ruling = 'block', false)) AS blocked
    FROM reached LEFT JOIN reached_rules USING (host, path) GROUP BY node)
SELECT CAST(page_id AS BIGINT) AS page_id, host, path, rule,
       coalesce(ruling, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, alias
FROM parts LEFT JOIN part_rules USING (host, path) LEFT JOIN aliases USING (node)
"""

ORACLE["op10_suffix_dedup"] = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (
  SELECT r, p, md5(b[p + 1 : p + 200]) AS h
  FROM (SELECT r, b, unnest(range(0, octet_length(b) - 199)) AS p FROM texts WHERE octet_length(b) >= 200)),
repeated AS (SELECT r, p FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
marked AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 200 AS same FROM repeated),
grouped AS (SELECT r, p, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g FROM marked),
spans AS (SELECT r, min(p) AS s, max(p) + 200 AS e FROM grouped GROUP BY r, g),
starts AS (
  SELECT r, s, e, coalesce(lag(e) OVER w, 0) AS before FROM (
    SELECT r, s, e FROM spans UNION ALL SELECT r, octet_length(b), octet_length(b) FROM texts)
  WINDOW w AS (PARTITION BY r ORDER BY s, e)),
kept AS (
  SELECT t.r, string_agg(hex(t.b[before + 1 : s]), '' ORDER BY s, e) AS rest, sum(e - s) AS n_removed, count(*) - 1 AS n_spans
  FROM starts x JOIN texts t ON x.r = t.r GROUP BY t.r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(rest)) AS kept_sha256
FROM kept JOIN texts USING (r)
"""

_BLANK = "\\x20\\x09-\\x0D"
_CLASSES = ["a-z", "A-Z", "0-9", _BLANK, ".,;:!?\'\'\"()\\-", "#*$%&|<>"]
_ASCII_REST = "\\x00-\\x08\\x0E-\\x1F+/=@\\[\\\\\\]^_`{}~\\x7F"


def _count(letters: str) -> str:
    return f"length(text) - length(regexp_replace(text, '[{letters}]', '', 'g'))"


_SHAPES = ", ".join([_count(c) for c in [*_CLASSES, _ASCII_REST]] + ["length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))"])


def _divergence(bins: str, group: str) -> str:
    """Jensen-Shannon distance of columns a and b of a table of histogram bins."""
    term = "sum(CASE WHEN {0} > 0 THEN {0} * log2({0} / ((a + b) / 2)) ELSE 0 END)"
    share = f"SELECT {group}, a / sum(a) OVER w AS a, b / sum(b) OVER w AS b FROM {bins} WINDOW w AS (PARTITION BY {group})"
    return f"SELECT {group}, round(sqrt(greatest(0, {term.format('a')} + {term.format('b')}) / 2), 6) AS js FROM ({share}) GROUP BY {group}"


ORACLE["op6_quality_rules"] = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+') AS words,
    regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[!-/:-@\\[-`{{-~]', '', 'g'), '[^{_BLANK}]+') AS plain FROM documents),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts WHERE len(words) > 2)),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r),
rows AS (
  SELECT r, string_split(text, chr(10)) AS every, list_filter(every, lambda l: regexp_matches(l, '[^{_BLANK}]')) AS lines FROM texts),
base AS (
  SELECT t.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, {_count(_CLASSES[-1])} AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, [{_SHAPES}] AS shape
  FROM texts t JOIN rows USING (r) LEFT JOIN covered c USING (r)),
languages AS (SELECT lang FROM base GROUP BY lang HAVING sum(len(plain)) >= 5000),
shapes AS (
  SELECT lang, k, sum(n) AS n FROM (SELECT lang, unnest(shape) AS n, generate_subscripts(shape, 1) AS k FROM base) s
  WHERE EXISTS (SELECT 1 FROM languages l WHERE l.lang IS NOT DISTINCT FROM s.lang) GROUP BY ALL),
shape_bins AS (
  SELECT x.r, CAST(x.n AS DOUBLE) AS a, CAST(s.n AS DOUBLE) AS b
  FROM (SELECT r, lang, unnest(shape) AS n, generate_subscripts(shape, 1) AS k FROM base WHERE n_words >= 50) x
  JOIN shapes s ON x.lang IS NOT DISTINCT FROM s.lang AND x.k = s.k),
shape_js AS ({_divergence("shape_bins", "r")}),
counted AS (SELECT r, lang, word, count(*) AS n FROM (SELECT r, lang, unnest(plain) AS word FROM texts) GROUP BY ALL),
corpus AS (
  SELECT lang, word, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS every FROM counted GROUP BY lang, word QUALIFY every >= 5000),
common AS (SELECT * FROM corpus QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 50),
word_bins AS (
  SELECT b.r, b.len_plain, coalesce(CAST(c.n AS DOUBLE), 0) AS a, CAST(m.n AS DOUBLE) AS b, m.every
  FROM (SELECT r, lang, len(plain) AS len_plain FROM base WHERE n_words >= 200) b
  JOIN common m ON b.lang IS NOT DISTINCT FROM m.lang LEFT JOIN counted c ON c.r = b.r AND c.word = m.word),
all_bins AS (
  SELECT r, a, b FROM word_bins
  UNION ALL SELECT r, any_value(len_plain) - sum(a), any_value(every) - sum(b) FROM word_bins GROUP BY r),
word_js AS ({_divergence("all_bins", "r")}),
judged AS (
  SELECT b.*, s.js AS js_chars, w.js AS js_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base b LEFT JOIN shape_js s USING (r) LEFT JOIN word_js w USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, js_chars, js_words, base_failed,
  NOT base_failed AND coalesce(js_chars, 0) <= 0.32 AND coalesce(js_words, 0) <= 0.33 AS kept
FROM judged
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLE["op11_decontamination"] = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w, least(len(w), 10) AS n FROM benchmark),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS v
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items WHERE n > 0)),
places AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item FROM places JOIN windows USING (n, v)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def _rounds(rounds: int) -> str:
    """Assign all parts to the entries, and move the entries, so many times; then assign once more."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""
seen{i} AS MATERIALIZED (
  SELECT r, p, arg_min(e, d * 16 + e) AS e, min(d) AS d
  FROM (SELECT a.r, a.p, b.e, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))) AS d
        FROM parts a JOIN book{i} b USING (p)) GROUP BY r, p)""")
        if i < rounds:
            out.append(f"""
book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.x, b.x) AS x FROM book{i} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS x FROM (
      SELECT p, e, i, CAST((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM seen{i} JOIN parts USING (r, p)) GROUP BY p, e, i)
    GROUP BY p, e) n USING (p, e))""")
    return ",".join(out)


ORACLE["op12_vector_codes"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[len(v) * p // 8 + 1 : len(v) * (p + 1) // 8] AS x FROM kept, (SELECT unnest(range(8)) AS p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x
  FROM parts JOIN (SELECT r, vec_id FROM kept ORDER BY vec_id LIMIT 16) USING (r)),{_rounds(6)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM seen6 GROUP BY r),
books AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM book6))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""

_BITS = "flatten(list_transform(split(CAST(c AS VARCHAR), ''), lambda d: list_transform(range(8), lambda b: (ascii(d) >> b) & 1)))"
_CRC = (
    f"xor(4294967295, list_reduce(list_prepend(4294967295, CAST({_BITS} AS BIGINT[])), "
    "lambda x, b: CASE WHEN ((x & 1) <> b) THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"
)

ORACLE["op13_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id AS c, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST) AS said
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shared AS (SELECT c, said, {_CRC} % 9 AS h FROM own),
built AS MATERIALIZED (
  SELECT a.c, list_concat(coalesce(b.said, [])[1 : a.h], a.said[a.h + 1 :]) AS said FROM shared a LEFT JOIN own b ON b.c = a.c - a.c % 5),
paths AS MATERIALIZED (
  SELECT c, d, sha256(CAST(to_json(said[1 : d]) AS VARCHAR)) AS k, sha256(CAST(to_json(said[1 : d - 1]) AS VARCHAR)) AS above,
    CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(said[d][2])) END AS b, d = len(said) AS ends
  FROM (SELECT c, said, unnest(range(len(said) + 1)) AS d FROM built)),
nodes AS MATERIALIZED (
  SELECT d, k, any_value(above) AS above, min(c) AS c, count(*) AS n, any_value(b) AS b,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ends FROM paths GROUP BY d, k),
children AS (SELECT d - 1 AS d, above AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
under AS (SELECT DISTINCT a.d, a.k, b.d AS d2, b.k AS k2 FROM paths a JOIN paths b ON a.c = b.c AND b.d >= a.d),
sums AS (
  SELECT u.d, u.k, sum((n.n - 1) * n.b) AS saved, count(*) FILTER (x.n_children IS NULL) AS n_leaves
  FROM under u JOIN nodes n ON n.d = u.d2 AND n.k = u.k2 LEFT JOIN children x ON x.d = u.d2 AND x.k = u.k2 GROUP BY u.d, u.k)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(x.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.k = n.k LEFT JOIN children x ON x.d = n.d AND x.k = n.k
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.above
"""
