"""The registered queries as DuckDB SQL over the same tables, written independently of the Spark plans."""

from __future__ import annotations

from shelfmark import schemas as S
from shelfmark.plans.requests import FEED_SEARCHES_SQL, PREFIXES_SQL, SEARCHES_SQL

# Spelt out here, not taken from the code under test; accents are stripped by DuckDB's own table.
TOKEN = r"[\p{L}\p{M}\p{N}_]+(?:[.''’][\p{L}\p{M}\p{N}_]+)*"
RUN = r"[\p{L}\p{N}]+"
HEX = "[a-f0-9]{6}$"
BUDGET = "CASE WHEN length({0}) <= 2 THEN 0 WHEN length({0}) <= 5 THEN 1 ELSE 2 END"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {trim(x)} = '')"


def fold(x: str) -> str:
    folded = f"translate(strip_accents(lower({x})), 'øđðłħŧıŋ', 'oddlhtin')"
    for source, target in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("ĳ", "ij")):
        folded = f"replace({folded}, '{source}', '{target}')"
    return folded


def clean(x: str) -> str:
    return trim(f"regexp_replace({x}, '{HEX}', '')")


def key(name: str, description: str) -> str:
    part = lambda c: f"lower({trim(f'coalesce({c}, {chr(39) * 2})')})"
    return f"{part(name)} || '::' || {part(description)}"


def main_term(x: str) -> str:
    cleaned = clean(x)
    word = f"regexp_split_to_array({cleaned}, '\\s+')[1]"
    return f"lower(CASE WHEN length({word}) >= 3 AND NOT regexp_matches({word}, '[0-9]') THEN {word} ELSE {cleaned} END)"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '{TOKEN}')"


def joined(x: str) -> str:
    return f"array_to_string({x}, '|')"


def raw_grams(x: str) -> str:
    runs = f"list_filter(regexp_extract_all(coalesce({x}, ''), '{RUN}'), lambda r: length(r) >= 2)"
    cut = f"list_transform({runs}, lambda r: list_transform(range(2, least(20, length(r)) + 1), lambda n: left(r, n)))"
    return f"flatten({cut})"


def grams(x: str) -> str:
    return f"list_transform({raw_grams(x)}, lambda g: {fold('g')})"


def marked(x: str, terms: str) -> str:
    pieces = f"regexp_extract_all({x}, '(?:{TOKEN})|(?s:.)')"
    wrapped = f"list_transform({pieces}, lambda p: CASE WHEN list_contains({terms}, lower(p)) THEN '<strong>' || p || '</strong>' ELSE p END)"
    return f"array_to_string({wrapped}, '')"


def document_columns(name: str = "name", description: str = "description") -> str:
    return (
        f"{name} AS \"nameSpell\", {clean(name)} AS \"nameSpellClean\", {key(name, description)} AS \"uniqueKey\", "
        f"{fold(key(name, description))} AS \"normalizedKey\""
    )


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
OP = "CASE event_type WHEN 'signup' THEN 'CREATED' WHEN 'error' THEN 'DELETED' ELSE 'UPDATED' END"

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand || ' ' || p_type AS description,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_partkey AS seq_id,
         TIMESTAMP '2024-02-01 00:00:00' + to_seconds(p_partkey) AS seq_ts
  FROM part)"""

CHANGES = f"""changes AS (
  SELECT ts AS seq_ts, event_id AS seq_id, {OP} AS op, CAST(user_id AS VARCHAR) AS id,
         'product ' || user_id AS name, 'rev ' || {K} AS description,
         CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(10,2)) END AS price, {K} AS k, event_type, props
  FROM events)"""

FOLDED = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq_ts, seq_id) AS pos FROM changes),
gone AS (SELECT id, max(pos) AS d FROM placed WHERE op = 'DELETED' GROUP BY id),
live AS (SELECT p.* FROM placed p LEFT JOIN gone g ON p.id = g.id WHERE p.pos > coalesce(g.d, -1)),
starts AS (SELECT id, min(pos) AS f FROM live GROUP BY id),
applied AS (SELECT l.* FROM live l JOIN starts s ON l.id = s.id WHERE l.pos = s.f OR l.op = 'UPDATED'),
numbered AS (
  SELECT *, lag(price) OVER w AS before, row_number() OVER w AS n,
         row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS from_end
  FROM applied WINDOW w AS (PARTITION BY id ORDER BY pos)),
moved AS (
  SELECT id, max(seq_ts) AS at FROM numbered WHERE n = 1 OR before IS NULL OR price <> before GROUP BY id),
folded AS (
  SELECT n.id, n.name, n.description, n.price, n.seq_ts AS "updatedAt", m.at AS "priceChangedAt"
  FROM numbered n JOIN moved m ON n.id = m.id WHERE n.from_end = 1)"""

ENCODED = """encoded AS (
  SELECT *, '{"id":' || to_json(id) || ',"name":' || to_json(name) || ',"description":' || to_json(description)
    || CASE WHEN op = 'DELETED' THEN '}' ELSE ',"price":' || CAST(price AS VARCHAR) || '}' END AS body
  FROM changes)"""

MESSAGES = """messages AS (
  SELECT seq_ts, seq_id, op, k, k % 5 AS retry_count,
    CASE WHEN event_type = 'click' THEN props
         WHEN event_type = 'purchase' AND k < 50 THEN left(body, length(body) - 1)
         WHEN event_type = 'error' AND k < 20 THEN left(body, length(body) - 1) || ',"price":1}'
         WHEN event_type = 'signup' AND k < 10 THEN '{"id":null,"name":"x"}'
         WHEN event_type = 'signup' AND k < 15 THEN '{"id":"1","name":{"text":"x"},"price":2}'
         WHEN event_type = 'signup' AND k < 20 THEN '{"id":"1","name":"x","description":["y"]}'
         WHEN event_type = 'signup' AND k < 25 THEN left(body, length(body) - 1) || ',"updatedAt":"garbage"}'
         WHEN event_type = 'signup' AND k < 30 THEN left(body, length(body) - 1) || ',"priceChangedAt":"2024-01-05T06:07:08Z"}'
         WHEN event_type = 'signup' AND k < 35 THEN '{"id":7,"name":true,"price":"12.5"}'
         WHEN event_type = 'signup' AND k < 40 THEN '{"id":"1","name":"x","price":"cheap"}'
         ELSE body END AS payload
  FROM encoded)"""

QUEUE_CASE = " ".join(f"WHEN '{op}' THEN '{queue}'" for op, queue in S.QUEUE_OF_OP.items())
KEY_CASE = " ".join(f"WHEN '{op}' THEN '{route}'" for op, route in S.ROUTING_KEY_OF_OP.items())

QUEUED = f"""queued AS (
  SELECT seq_ts, seq_id, op, retry_count,
    CASE WHEN k < 20 THEN '{S.QUEUE_RETRY}' WHEN k < 40 THEN '{S.QUEUE_DEAD}' ELSE CASE op {QUEUE_CASE} END END AS queue,
    CASE retry_count WHEN 1 THEN '"' || replace(payload, '"', '\\"') || '"'
                     WHEN 2 THEN '  ' || payload || ' ' || chr(10) ELSE payload END AS payload,
    CASE WHEN k < 20 THEN seq_ts + INTERVAL 5 SECOND END AS available_at,
    CASE WHEN k >= 20 AND k < 40 THEN seq_ts END AS dead_at
  FROM messages)"""

ALLOWED = "[" + ", ".join(f"'{k}'" for k in S.DOCUMENT_KEYS) + "]"
ALLOWED_DELETED = "[" + ", ".join(f"'{k}'" for k in S.DELETED_KEYS) + "]"
DECODED = f"""judged AS (
  SELECT *, CASE WHEN NOT json_valid(payload) THEN 'malformed'
      WHEN len(list_filter(json_keys(payload), lambda x: NOT list_contains(
        CASE WHEN op = 'DELETED' THEN {ALLOWED_DELETED} ELSE {ALLOWED} END, x))) > 0 THEN 'unknown key'
      WHEN len(list_filter(json_keys(payload), lambda x: json_type(json_extract(payload, '$.' || x)) IN ('OBJECT', 'ARRAY'))) > 0 THEN 'bad type'
      WHEN json_extract_string(payload, '$.id') IS NULL THEN 'missing id'
      WHEN json_extract_string(payload, '$.price') IS NOT NULL
        AND TRY_CAST(json_extract_string(payload, '$.price') AS DECIMAL(10,2)) IS NULL THEN 'bad price'
      WHEN len(list_filter(['updatedAt', 'priceChangedAt'], lambda x: json_extract_string(payload, '$.' || x) IS NOT NULL
        AND TRY_CAST(json_extract_string(payload, '$.' || x) AS TIMESTAMPTZ) IS NULL)) > 0 THEN 'bad time' END AS error
  FROM messages),
decoded AS (
  SELECT *, CASE WHEN error IS NULL THEN json_extract_string(payload, '$.id') END AS id,
    CASE WHEN error IS NULL THEN json_extract_string(payload, '$.name') END AS name,
    CASE WHEN error IS NULL THEN json_extract_string(payload, '$.description') END AS description,
    CASE WHEN error IS NULL THEN CAST(json_extract_string(payload, '$.price') AS DOUBLE) END AS price
  FROM judged)"""

VALIDATED = f"""requests AS (
  SELECT event_id AS row_id,
    CASE WHEN event_type = 'error' THEN ' ' || chr(9) || ' ' WHEN event_type = 'purchase' THEN repeat('abc', {K})
         ELSE 'product ' || user_id END AS name,
    CASE WHEN event_type = 'click' AND {K} < 30 THEN NULL ELSE 'rev ' || {K} END AS description,
    CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(14,4)) * 1000000 WHEN {K} = 0 THEN NULL
         ELSE CAST(value AS DECIMAL(14,4)) - 50 END AS price
  FROM events),
messages AS (
  SELECT *, CASE WHEN {blank('name')} THEN '{S.NAME_REQUIRED}' WHEN length(name) > 255 THEN '{S.NAME_TOO_LONG}' END AS e_name,
    CASE WHEN {blank('description')} THEN '{S.DESCRIPTION_REQUIRED}' END AS e_description,
    CASE WHEN price IS NULL THEN '{S.PRICE_REQUIRED}' WHEN price <= 0 THEN '{S.PRICE_POSITIVE}'
         WHEN round(price, 2) >= 100000000 THEN '{S.PRICE_OUT_OF_RANGE}' END AS e_price
  FROM requests)"""

COMPACT = r"""regexp_replace({0}, '("(?:[^"\\]|\\.)*")|\s+', '\1', 'g')"""


def tidy(x: str) -> str:
    text = trim(f"""replace(replace({x}, '\\\\', '\\'), '\\"', '"')""")
    bracketed = f"((starts_with({text}, '{{') AND ends_with({text}, '}}')) OR (starts_with({text}, '[') AND ends_with({text}, ']')))"
    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' THEN '[Empty message]' "
        f"WHEN {bracketed} AND json_valid({text}) THEN {COMPACT.format(text)} ELSE {text} END"
    )


def normalized(x: str) -> str:
    text = f"""regexp_replace({trim(f"coalesce({x}, '')")}, '^"+|"+$', '', 'g')"""
    for escaped, plain in (("\\r", ""), ("\\n", ""), ('\\"', '"'), ("\\\\", "\\")):
        text = f"replace({text}, '{escaped}', '{plain}')"
    return f"CASE WHEN json_valid({text}) THEN {COMPACT.format(text)} ELSE {text} END"


LINES = "lines AS (SELECT CAST(doc_id AS VARCHAR) AS id, unnest(t) AS name, generate_subscripts(t, 1) - 1 AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents))"

# --- search fragments -------------------------------------------------------------------------------------

REQUESTS = f"""asked AS (
  SELECT *, CASE WHEN page < 0 THEN 'negative page' WHEN size < 1 THEN 'empty page'
      WHEN sort_field NOT IN ('price', 'name', 'id', 'uniqueKey', 'updatedAt', 'priceChangedAt') THEN 'unknown sort field' END AS error
  FROM (SELECT * REPLACE (coalesce(page, 0) AS page, coalesce(size, 12) AS size),
               {blank('query')} AS is_blank, split_part(coalesce(sort, 'price,asc'), ',', 1) AS sort_field,
               lower(split_part(coalesce(sort, 'price,asc'), ',', 2)) = 'desc' AS is_desc FROM ({SEARCHES_SQL})))"""

FIELDS = f"""field_tokens AS (
  SELECT id, price, name, 'name' AS field, {tokens('name')} AS toks FROM products
  UNION ALL SELECT id, price, name, 'description', {tokens('description')} FROM products),
tf AS (
  SELECT f.field, f.id, t.term, any_value(f.price) AS price, count(*) AS tf, any_value(len(f.toks)) AS dl
  FROM field_tokens f, unnest(f.toks) AS t(term) GROUP BY ALL),
stats AS (SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY ALL),
field_stats AS (SELECT field, count(*) AS n_docs, avg(len(toks)) AS avg_len FROM field_tokens WHERE len(toks) > 0 GROUP BY field)"""

SPELL = f"""words AS (
  SELECT term, count(DISTINCT id) AS df
  FROM (SELECT id, unnest({tokens(clean('name'))}) AS term FROM products) GROUP BY term),
first_token AS (SELECT query_id, query, {tokens('query')}[1] AS tok FROM asked WHERE NOT is_blank),
options AS (
  SELECT query_id, query, term, df, 1 - d / least(length(tok), length(term)) AS sim
  FROM (SELECT f.*, w.term, w.df, damerau_levenshtein(f.tok, w.term) AS d,
               coalesce((SELECT df FROM words o WHERE o.term = f.tok), 0) AS own
        FROM first_token f JOIN words w ON left(f.tok, 1) = left(w.term, 1))
  WHERE length(tok) >= 4 AND d BETWEEN 1 AND 2 AND df > own),
spelled AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, df DESC, term) AS position
  FROM options WHERE sim >= 0.5 QUALIFY position <= 3),
fixed AS (
  SELECT a.*, CASE WHEN NOT is_blank THEN coalesce(s.list[1], a.query) END AS corrected,
         coalesce(s.list, CAST([] AS VARCHAR[])) AS suggestions
  FROM asked a LEFT JOIN (SELECT query_id, list(term ORDER BY position) AS list FROM spelled
                          WHERE term <> lower(query) GROUP BY query_id) s ON a.query_id = s.query_id)"""

IN_BOUNDS = "(min_price IS NULL OR CAST(price AS DOUBLE) >= min_price) AND (max_price IS NULL OR CAST(price AS DOUBLE) <= max_price)"


def matches(source: str, text: str, budget: str) -> str:
    """Query tokens with the indexed terms they stand for, then (query_id, id, field, term)."""
    return f"""wanted AS (
  SELECT DISTINCT query_id, min_price, max_price, unnest({tokens(text)}) AS token FROM {source} WHERE NOT is_blank AND error IS NULL),
meaning AS (
  SELECT w.query_id, w.min_price, w.max_price, v.term,
         max(1 - damerau_levenshtein(w.token, v.term) / least(length(w.token), length(v.term))) AS sim
  FROM wanted w JOIN (SELECT DISTINCT term FROM tf) v ON damerau_levenshtein(w.token, v.term) <= {budget}
  GROUP BY ALL),
matched AS (
  SELECT m.query_id, m.sim, t.* FROM meaning m JOIN tf t ON m.term = t.term WHERE {IN_BOUNDS})"""


FUZZY = BUDGET.format("w.token")

HITS = f"""hit AS (
  SELECT DISTINCT query_id, id FROM matched
  UNION ALL SELECT a.query_id, p.id FROM asked a, products p WHERE a.is_blank AND a.error IS NULL AND {IN_BOUNDS}),
ranked AS (
  SELECT h.query_id, h.id, a.page, a.size,
    row_number() OVER (PARTITION BY h.query_id ORDER BY
      CASE WHEN sort_field = 'price' THEN CAST(CASE WHEN is_desc THEN -p.price ELSE p.price END AS DOUBLE) END NULLS LAST,
      CASE WHEN NOT is_desc THEN CASE sort_field WHEN 'name' THEN p.name WHEN 'id' THEN p.id WHEN 'uniqueKey' THEN {key('p.name', 'p.description')} END END NULLS LAST,
      CASE WHEN is_desc THEN CASE sort_field WHEN 'name' THEN p.name WHEN 'id' THEN p.id WHEN 'uniqueKey' THEN {key('p.name', 'p.description')} END END DESC NULLS LAST,
      h.id) AS rank,
    count(*) OVER (PARTITION BY h.query_id) AS total_hits
  FROM hit h JOIN asked a ON h.query_id = a.query_id JOIN products p ON h.id = p.id),
paged AS (
  SELECT query_id, rank, id, total_hits, CAST(ceil(total_hits / size) AS BIGINT) AS total_pages
  FROM ranked WHERE rank > page * size AND rank <= (page + 1) * size)"""

SHOWN = f""", terms AS (SELECT query_id, list(DISTINCT term) AS terms FROM meaning GROUP BY query_id)
    SELECT g.query_id, g.rank, g.id, {marked('p.name', 'coalesce(t.terms, CAST([] AS VARCHAR[]))')} AS name,
      {marked('p.description', 'coalesce(t.terms, CAST([] AS VARCHAR[]))')} AS description, CAST(p.price AS DOUBLE) AS price,
      p.name AS "nameSpell", {clean('p.name')} AS "nameSpellClean", {key('p.name', 'p.description')} AS "uniqueKey",
      TIMESTAMP '2024-01-31' AS "updatedAt", TIMESTAMP '2024-01-31' AS "priceChangedAt",
      g.total_hits, g.total_pages, CASE WHEN lower(f.corrected) <> lower(f.query) THEN f.corrected END AS corrected_query
    FROM paged g JOIN products p ON g.id = p.id JOIN fixed f ON g.query_id = f.query_id LEFT JOIN terms t ON g.query_id = t.query_id"""

# The same over the folded feed, which has times of its own.
FEED_PRODUCTS = 'products AS (SELECT id, name, description, price, "updatedAt", "priceChangedAt" FROM folded)'
FEED_NUMBER = """CASE sort_field WHEN 'price' THEN CAST(p.price AS DOUBLE) WHEN 'updatedAt' THEN epoch(p."updatedAt")
      WHEN 'priceChangedAt' THEN epoch(p."priceChangedAt") END"""
FEED_HITS = HITS.replace(
    "CASE WHEN sort_field = 'price' THEN CAST(CASE WHEN is_desc THEN -p.price ELSE p.price END AS DOUBLE) END",
    f"CASE WHEN is_desc THEN -({FEED_NUMBER}) ELSE {FEED_NUMBER} END",
)
FEED_SHOWN = SHOWN.replace('TIMESTAMP \'2024-01-31\' AS "updatedAt", TIMESTAMP \'2024-01-31\' AS "priceChangedAt"', 'p."updatedAt", p."priceChangedAt"')

VOCABULARY = f"""first_rows AS (SELECT name FROM products ORDER BY id LIMIT 100),
catalog_terms AS (
  SELECT term, row_number() OVER (ORDER BY term) AS position
  FROM (SELECT DISTINCT {main_term('name')} AS term FROM first_rows WHERE NOT {blank('name')})
  WHERE length(term) >= 3 QUALIFY position <= 15)"""

FALLBACK = "[" + ", ".join(f"'{t}'" for t in S.FALLBACK_SUGGESTIONS) + "]"

# --- autocomplete fragments -------------------------------------------------------------------------------

PREFIXES = f"""prefixes AS (
  SELECT prefix_id, lower({trim('prefix')}) AS prefix FROM ({PREFIXES_SQL}) WHERE NOT {blank('prefix')})"""


def idf(n: str, df: str) -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"


def weight(tf: str, dl: str, avg_len: str) -> str:
    return f"({tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * {dl} / {avg_len})))"


def best(name: str, hits: str) -> str:
    return f"""{name} AS (
  SELECT prefix_id, id, name, score, row_number() OVER (PARTITION BY prefix_id ORDER BY score DESC, name, id) AS rank
  FROM (SELECT prefix_id, id, name, round(score, 6) AS score FROM {hits}) QUALIFY rank <= 10)"""


BY_PREFIX = f"""names AS (SELECT id, name, {tokens(fold('name'))} AS toks FROM products),
name_terms AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT id, unnest(toks) AS term FROM names) GROUP BY term),
name_field AS (SELECT count(*) AS n_docs, avg(len(toks)) AS avg_len FROM names WHERE len(toks) > 0),
phrase AS (SELECT prefix_id, {tokens(fold('prefix'))} AS want FROM prefixes),
last_terms AS (
  SELECT p.prefix_id, p.want, t.term, t.df FROM phrase p JOIN name_terms t ON starts_with(t.term, p.want[-1])
  QUALIFY row_number() OVER (PARTITION BY p.prefix_id ORDER BY t.term) <= 20),
phrase_hits AS (
  SELECT l.prefix_id, l.want, l.term, l.df, n.id, n.name, len(n.toks) AS dl,
    len(list_filter(range(1, len(n.toks) - len(l.want) + 2), lambda i: n.toks[i + len(l.want) - 1] = l.term
        AND n.toks[i : i + len(l.want) - 2] = l.want[1 : len(l.want) - 1])) AS tf
  FROM last_terms l JOIN names n ON list_contains(n.toks, l.term)),
lead AS (
  SELECT prefix_id, sum({idf('n_docs', 'df')}) AS lead_idf
  FROM (SELECT prefix_id, unnest(want[1 : len(want) - 1]) AS term FROM phrase) q JOIN name_terms t ON q.term = t.term, name_field
  GROUP BY prefix_id),
prefix_hits AS (
  SELECT h.prefix_id, h.id, any_value(h.name) AS name,
    sum(({idf('n_docs', 'h.df')} + coalesce(lead_idf, 0)) * {weight('h.tf', 'h.dl', 'avg_len')}) AS score
  FROM phrase_hits h LEFT JOIN lead d ON h.prefix_id = d.prefix_id, name_field WHERE h.tf > 0 GROUP BY h.prefix_id, h.id),
{best('stage1', 'prefix_hits')}"""

BY_CONTAINS = f"""indexed AS (
  SELECT DISTINCT id, name, 'word' AS field, unnest({tokens('name')}) AS term FROM products
  UNION ALL SELECT DISTINCT id, name, 'edge', unnest({grams('name')}) FROM products),
patterns AS (
  SELECT prefix_id, '(?s:.*' || replace(replace(regexp_replace(prefix, '([^\\p{{L}}\\p{{N}}_*?])', '\\\\\\1', 'g'), '*', '.*'), '?', '.') || '.*)' AS pattern
  FROM prefixes),
contains_hits AS (
  SELECT p.prefix_id, i.id, any_value(i.name) AS name, CAST(count(DISTINCT i.field) AS DOUBLE) AS score
  FROM patterns p JOIN indexed i ON regexp_full_match(i.term, p.pattern) GROUP BY p.prefix_id, i.id),
{best('stage2', 'contains_hits')}"""

BY_FUZZY = f"""name_grams AS (SELECT id, name, {grams('name')} AS toks FROM products),
gram_tf AS (
  SELECT g.id, any_value(g.name) AS name, t.term, count(*) AS tf, any_value(len(g.toks)) AS dl
  FROM name_grams g, unnest(g.toks) AS t(term) GROUP BY g.id, t.term),
gram_stats AS (SELECT term, count(*) AS df FROM gram_tf GROUP BY term),
gram_field AS (SELECT count(*) AS n_docs, avg(len(toks)) AS avg_len FROM name_grams WHERE len(toks) > 0),
gram_tokens AS (SELECT DISTINCT prefix_id, unnest({tokens(fold('prefix'))}) AS token FROM prefixes),
near AS (
  SELECT token, term, df, sim FROM (
    SELECT token, term, df, damerau_levenshtein(token, term) AS d,
           1 - damerau_levenshtein(token, term) / least(length(token), length(term)) AS sim
    FROM (SELECT DISTINCT token FROM gram_tokens), gram_stats)
  WHERE d <= {BUDGET.format('token')}
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY sim DESC, term) <= 20),
fuzzy_hits AS (
  SELECT q.prefix_id, g.id, any_value(g.name) AS name,
         sum(n.sim * {idf('n_docs', 'n.df')} * {weight('g.tf', 'g.dl', 'avg_len')}) AS score
  FROM gram_tokens q JOIN near n ON q.token = n.token JOIN gram_tf g ON n.term = g.term, gram_field
  GROUP BY q.prefix_id, g.id),
{best('stage3', 'fuzzy_hits')}"""

HISTORY = """history AS (
  SELECT CAST(day(seq_ts) AS BIGINT) AS version, date_trunc('day', seq_ts)::TIMESTAMP AS created_at,
    CASE op WHEN 'DELETED' THEN '.system' WHEN 'CREATED' THEN 'labels' ELSE 'products' END AS table_name,
    seq_id, id, name, description, CAST(price AS DOUBLE) AS price
  FROM changes)"""

ORACLE: dict[str, str] = {
    "list_products": with_(PRODUCTS) + "SELECT id, name, description, CAST(price AS DOUBLE) AS price FROM products",
    "lookup_products": with_(PRODUCTS)
    + """SELECT l_orderkey || '-' || l_linenumber AS request_id, CAST(l_orderkey AS VARCHAR) AS id, p.name, p.description,
      CAST(p.price AS DOUBLE) AS price, p.id IS NOT NULL AS found
    FROM lineitem LEFT JOIN products p ON CAST(l_orderkey AS VARCHAR) = p.id""",
    "seed_if_empty": with_(PRODUCTS)
    + f"""SELECT id, CAST(price AS DOUBLE) AS price, 'empty' AS target, CASE WHEN first THEN '{S.QUEUE_CREATED}' END AS queue,
      CASE WHEN first THEN '{{"id":' || to_json(id) || ',"name":' || to_json(name) ||
      ',"description":' || to_json(description) || ',"price":' || CAST(price AS VARCHAR) || '}}' END AS payload
    FROM (SELECT sha256('[' || to_json(name) || ',' || to_json(description) || ']') AS id, name, description, price,
                 row_number() OVER (PARTITION BY name, description ORDER BY seq_id) = 1 AS first FROM products)""",
    "encode_events": with_(CHANGES, ENCODED)
    + f"SELECT seq_id, CASE op {QUEUE_CASE} END AS queue, CASE op {KEY_CASE} END AS routing_key, body AS payload FROM encoded",
    "decode_events": with_(CHANGES, ENCODED, MESSAGES, DECODED)
    + "SELECT seq_id, op, error, id, name, description, price FROM decoded",
    "write_catalog": with_(PRODUCTS)
    + f"""SELECT id, name, CAST(price AS DOUBLE) AS price, {clean('name')} AS "nameSpellClean",
      {key('name', 'description')} AS "uniqueKey", TIMESTAMP '2024-01-31' AS "updatedAt" FROM products""",
    "validate_products": with_(VALIDATED)
    + f"""SELECT row_id, CAST(len(e) AS BIGINT) AS n_errors, {joined('e')} AS errors FROM (
      SELECT row_id, list_filter(['name=' || e_name, 'description=' || e_description, 'price=' || e_price], lambda x: x IS NOT NULL) AS e
      FROM messages)""",
    "valid_products": with_(VALIDATED)
    + """SELECT row_id, name, description, CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price FROM messages
    WHERE e_name IS NULL AND e_description IS NULL AND e_price IS NULL""",
    "rejected_products": with_(VALIDATED)
    + """SELECT row_id, 'name' AS field, e_name AS message FROM messages WHERE e_name IS NOT NULL
    UNION ALL SELECT row_id, 'description', e_description FROM messages WHERE e_description IS NOT NULL
    UNION ALL SELECT row_id, 'price', e_price FROM messages WHERE e_price IS NOT NULL""",
    "clean_name": with_(LINES) + f"SELECT id, line, {clean('name')} AS cleaned FROM lines",
    "unique_key": with_(PRODUCTS) + f"SELECT id, {key('name', 'description')} AS unique_key FROM products",
    "normalized_key": f"SELECT doc_id, {fold(key('lang', 'text'))} AS normalized_key FROM documents",
    "product_document": with_(PRODUCTS)
    + f"""SELECT id, name, description, CAST(price AS DOUBLE) AS price, {document_columns()},
      TIMESTAMP '2024-01-31' AS "updatedAt", TIMESTAMP '2024-01-31' AS "priceChangedAt" FROM products""",
    "main_term": with_(LINES) + f"SELECT id, line, {main_term('name')} AS term FROM lines",
    "price_filter": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_retailprice AS price FROM part WHERE p_retailprice BETWEEN 905 AND 950",
    "match_highlight": """SELECT doc_id, CASE WHEN pos = 0 THEN text
      ELSE left(text, pos - 1) || '<mark>' || substr(text, pos, 2) || '</mark>' || substr(text, pos + 2) END AS marked
    FROM (SELECT *, strpos(lower(text), 'en') AS pos FROM documents)""",
    "tidy_message": with_(CHANGES, ENCODED, MESSAGES, QUEUED) + f"SELECT seq_id, {tidy('payload')} AS message FROM queued",
    "normalize_message": with_(CHANGES, ENCODED, MESSAGES, QUEUED)
    + f"SELECT seq_id, {normalized('payload')} AS message FROM queued",
    "duplicate_creates": with_(PRODUCTS, CHANGES, FOLDED)
    + """SELECT p.seq_id, p.id, CASE WHEN f.id IS NOT NULL THEN f.id
      WHEN p.seq_id <> min(p.seq_id) OVER (PARTITION BY p.name, p.description)
        THEN first_value(p.id) OVER (PARTITION BY p.name, p.description ORDER BY p.seq_id) END AS holder
    FROM products p LEFT JOIN (SELECT name, description, min(id) AS id FROM folded GROUP BY ALL) f
      ON p.name = f.name AND p.description = f.description""",
    "duplicate_updates": with_(PRODUCTS, CHANGES)
    + """, updates AS (
      SELECT c.seq_id, c.id, p.name AS c_name, p.description AS c_description,
        CASE c.event_type WHEN 'purchase' THEN o.name ELSE p.name END AS name,
        CASE c.event_type WHEN 'purchase' THEN o.description WHEN 'click' THEN p.description || ' rev ' || o.id
             ELSE p.description END AS description
      FROM changes c JOIN products p ON c.id = p.id JOIN products o ON CAST(c.k AS VARCHAR) = o.id WHERE c.op <> 'CREATED')
    SELECT seq_id, id, true AS found, (name <> c_name OR description <> c_description) AND EXISTS (
      SELECT 1 FROM products x WHERE x.name = u.name AND x.description = u.description AND x.id <> u.id) AS duplicate
    FROM updates u""",
    "dedupe_by_id": with_(CHANGES, FOLDED)
    + """SELECT id, seq_id, description, CAST(price AS DOUBLE) AS price FROM changes c
    WHERE op = 'CREATED' AND NOT EXISTS (SELECT 1 FROM folded f WHERE f.id = c.id)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq_ts, seq_id) = 1""",
    "dedupe_by_key": with_(PRODUCTS, CHANGES, FOLDED)
    + f"""SELECT id, seq_id, "normalizedKey", price FROM (
      SELECT id, seq_id, {fold(key('name', 'description'))} AS "normalizedKey", CAST(price AS DOUBLE) AS price FROM products)
    WHERE "normalizedKey" NOT IN (SELECT {fold(key('name', 'description'))} FROM folded)
    QUALIFY row_number() OVER (PARTITION BY "normalizedKey" ORDER BY seq_id) = 1""",
    "distinct_names_topk": """WITH ranked AS (
      SELECT p_brand AS brand, p_name AS name, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS r FROM part),
    best AS (SELECT brand, name, min(r) AS b FROM ranked WHERE r <= 10 AND name IS NOT NULL GROUP BY ALL)
    SELECT brand, name, row_number() OVER (PARTITION BY brand ORDER BY b) AS position FROM best""",
    "apply_created": with_(PRODUCTS, CHANGES, FOLDED)
    + f""", batch AS (SELECT *, {fold(key('name', 'description'))} AS k FROM products),
    open AS (SELECT * FROM batch WHERE id NOT IN (SELECT id FROM folded)
      AND k NOT IN (SELECT {fold(key('name', 'description'))} FROM folded)),
    won AS (SELECT k, min(seq_id) AS seq_id FROM open GROUP BY k)
    SELECT b.seq_id, b.id, CASE WHEN b.id IN (SELECT id FROM folded) THEN 'ignored_id'
      WHEN b.seq_id IN (SELECT seq_id FROM won) THEN 'created' ELSE 'ignored_key' END AS outcome FROM batch b""",
    "apply_updated": with_(PRODUCTS, CHANGES, FOLDED)
    + """SELECT coalesce(p.id, f.id) AS id, coalesce(p.name, f.name) AS name, coalesce(p.description, f.description) AS description,
      CAST(coalesce(p.price, f.price) AS DOUBLE) AS price, coalesce(p.seq_ts, f."updatedAt") AS "updatedAt",
      CASE WHEN p.id IS NULL OR p.price = f.price THEN f."priceChangedAt" ELSE p.seq_ts END AS "priceChangedAt"
    FROM products p FULL JOIN folded f ON p.id = f.id""",
    "apply_deleted": with_(PRODUCTS, CHANGES)
    + """SELECT id, name, description, CAST(price AS DOUBLE) AS price FROM products
    WHERE id NOT IN (SELECT id FROM changes WHERE op = 'DELETED')""",
    "fold_changes": with_(CHANGES, FOLDED)
    + f"""SELECT id, name, description, CAST(price AS DOUBLE) AS price, "updatedAt", "priceChangedAt", {document_columns()} FROM folded""",
    "price_changed_at": with_(CHANGES, FOLDED) + 'SELECT id, "priceChangedAt" FROM folded',
    "versioned_update": with_(CHANGES)
    + f""", judged AS (
      SELECT *, row_number() OVER (PARTITION BY id, k ORDER BY seq_ts, seq_id) = 1 AS won, k % 5 AS tries FROM changes WHERE op = 'UPDATED')
    SELECT seq_id, id, CAST(k AS BIGINT) AS expected_version, won,
      CASE WHEN won THEN NULL WHEN tries >= 3 THEN '{S.QUEUE_DEAD}' ELSE '{S.QUEUE_RETRY}' END AS queue,
      CAST(CASE WHEN won THEN tries WHEN tries < 3 THEN tries + 1 END AS BIGINT) AS retry_count,
      CASE WHEN NOT won AND tries < 3 THEN seq_ts + INTERVAL 5 SECOND END AS available_at,
      CASE WHEN NOT won AND tries >= 3 THEN seq_ts END AS dead_at
    FROM judged""",
}

OUTCOMES = """outcomes AS (
  SELECT seq_id, id, op, CASE op WHEN 'CREATED' THEN CASE WHEN alive THEN 'ignored_id' ELSE 'created' END
    WHEN 'UPDATED' THEN CASE WHEN alive THEN 'updated' ELSE 'created_from_update' END
    ELSE CASE WHEN alive THEN 'deleted' ELSE 'ignored_missing' END END AS outcome
  FROM (SELECT *, coalesce(
      max(pos) FILTER (WHERE op <> 'DELETED') OVER w > coalesce(max(pos) FILTER (WHERE op = 'DELETED') OVER w, 0), false) AS alive
    FROM placed WINDOW w AS (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""
PLACED = FOLDED[: FOLDED.index("gone AS")].rstrip().rstrip(",")

# In the feed with shared names an id's key never changes, so a walk along each key's events decides all outcomes.
WALKED = """feed AS (
  SELECT seq_id, id, op, right(id, 1) AS k, row_number() OVER (PARTITION BY right(id, 1) ORDER BY seq_ts, seq_id) AS n
  FROM every_change),
walk(k, n, alive, seq_id, op, outcome) AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM feed
  UNION ALL
  SELECT f.k, f.n,
    CASE WHEN f.op = 'DELETED' THEN list_filter(w.alive, lambda x: x <> f.id)
         WHEN list_contains(w.alive, f.id) OR (f.op = 'CREATED' AND len(w.alive) > 0) THEN w.alive
         ELSE list_append(w.alive, f.id) END,
    f.seq_id, f.op,
    CASE WHEN f.op = 'DELETED' THEN CASE WHEN list_contains(w.alive, f.id) THEN 'deleted' ELSE 'ignored_missing' END
         WHEN list_contains(w.alive, f.id) THEN CASE f.op WHEN 'CREATED' THEN 'ignored_id' ELSE 'updated' END
         WHEN f.op = 'UPDATED' THEN 'created_from_update'
         WHEN len(w.alive) > 0 THEN 'ignored_key' ELSE 'created' END
  FROM walk w JOIN feed f ON f.k = w.k AND f.n = w.n + 1),
changes AS (
  SELECT c.* REPLACE ('Product ' || right(c.id, 1) AS name, 'rev' AS description)
  FROM every_change c JOIN walk w ON c.seq_id = w.seq_id
  WHERE outcome IN ('created', 'updated', 'created_from_update', 'deleted'))"""
EVERY_CHANGE = CHANGES.replace("changes AS", "every_change AS", 1)

STREAMED = f"""parts AS (SELECT *, CAST(floor(seq_id * 5 / (SELECT count(*) FROM events)) AS BIGINT) AS p FROM judged),
times AS (SELECT p, max(max(seq_ts)) OVER (ORDER BY p) AS moment FROM parts GROUP BY p),
ended AS (
  SELECT j.seq_id, j.op, j.error, j.p, d.moment AS died,
    (SELECT max(moment) FROM times) AS now
  FROM parts j LEFT JOIN times d ON d.p = j.p + {S.MAX_ATTEMPTS} WHERE j.error IS NOT NULL)"""

DOC_FIELDS = f"""field_tokens AS (SELECT CAST(doc_id AS VARCHAR) AS id, 'text' AS field, {tokens('text')} AS toks FROM documents),
tf AS (SELECT field, id, term, count(*) AS tf FROM (SELECT field, id, unnest(toks) AS term FROM field_tokens) GROUP BY ALL),
stats AS (SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY ALL),
field_stats AS (SELECT field, count(*) AS n_docs, avg(len(toks)) AS avg_len FROM field_tokens WHERE len(toks) > 0 GROUP BY field)"""
POSTINGS = """SELECT field, term, id, count(*) AS tf, string_agg(CAST(position AS VARCHAR), '|' ORDER BY position) AS positions
    FROM (SELECT field, id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS position FROM field_tokens) GROUP BY ALL"""
STATS = """SELECT s.field, term, df, cf, n_docs, round(avg_len, 6) AS avg_len FROM stats s JOIN field_stats f ON s.field = f.field"""

ORACLE |= {
    "fold_changes_unique": with_(EVERY_CHANGE, WALKED, FOLDED).replace("WITH", "WITH RECURSIVE", 1)
    + """SELECT id, name, description, CAST(price AS DOUBLE) AS price, "updatedAt", "priceChangedAt" FROM folded""",
    "apply_outcomes_unique": with_(EVERY_CHANGE, WALKED).replace("WITH", "WITH RECURSIVE", 1)
    + "SELECT op, outcome, count(*) AS n FROM walk WHERE outcome IS NOT NULL GROUP BY op, outcome",
    "stream_queue": with_(CHANGES, ENCODED, MESSAGES, DECODED, STREAMED)
    + f"""SELECT seq_id, op, error, CASE WHEN died IS NULL THEN '{S.QUEUE_RETRY}' ELSE '{S.QUEUE_DEAD}' END AS queue,
      CASE WHEN died IS NULL THEN 5 - p END AS retry_count,
      CASE WHEN died IS NULL THEN now + INTERVAL {S.RETRY_DELAY_SECONDS} SECOND END AS available_at, died AS dead_at
    FROM ended WHERE died IS NULL OR died > now - INTERVAL {S.DEAD_LETTER_DAYS} DAY""",
    "apply_outcomes": with_(CHANGES, PLACED, OUTCOMES) + "SELECT seq_id, id, op, outcome FROM outcomes",
    "apply_outcome_counts": with_(CHANGES, PLACED, OUTCOMES) + "SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome",
    "standard_tokens": f"SELECT CAST(doc_id AS VARCHAR) AS id, {joined(tokens('text'))} AS tokens FROM documents",
    "folded_tokens": f"SELECT CAST(doc_id AS VARCHAR) AS id, {joined(tokens(fold('text')))} AS tokens FROM documents",
    "edge_ngrams": with_(PRODUCTS)
    + f"SELECT id, generate_subscripts(g, 1) - 1 AS position, unnest(g) AS gram FROM (SELECT id, {grams('name')} AS g FROM products)",
    "document_edge_ngrams": f"""SELECT {fold('raw')} AS gram, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT raw, count(*) AS n FROM (SELECT unnest({raw_grams('text')}) AS raw FROM documents) GROUP BY raw) GROUP BY gram""",
    "postings": with_(PRODUCTS, FIELDS) + POSTINGS,
    "document_postings": with_(DOC_FIELDS) + POSTINGS,
    "term_stats": with_(PRODUCTS, FIELDS) + STATS,
    "document_term_stats": with_(DOC_FIELDS) + STATS,
    "keyword_terms": "SELECT p_name AS term, count(*) AS df FROM part GROUP BY p_name",
    "fuzzy_vocab_join": f"""WITH terms AS (SELECT DISTINCT unnest({tokens(fold('text'))}) AS term FROM documents),
    toks AS (SELECT DISTINCT unnest({tokens(fold('text'))}) AS token FROM benchmark)
    SELECT token, term, damerau_levenshtein(token, term) AS distance FROM toks JOIN terms
      ON abs(length(token) - length(term)) <= 2 AND damerau_levenshtein(token, term) <= {BUDGET.format('token')}""",
    "search_all": with_(PRODUCTS, REQUESTS)
    + """SELECT query_id, id, name, CAST(price AS DOUBLE) AS price FROM asked, products
    WHERE is_blank AND error IS NULL AND min_price IS NULL AND max_price IS NULL""",
    "search_exact": with_(PRODUCTS, REQUESTS, FIELDS, matches("asked", "query", "0")) + "SELECT DISTINCT query_id, id FROM matched",
    "search_fuzzy": with_(PRODUCTS, REQUESTS, FIELDS, matches("asked", "query", FUZZY)) + "SELECT DISTINCT query_id, id FROM matched",
    "search_scored": with_(PRODUCTS, REQUESTS, FIELDS, matches("asked", "query", FUZZY))
    + f"""SELECT query_id, id, round(max(score), 4) AS score FROM (
      SELECT m.query_id, m.id, m.field, sum(CASE m.field WHEN 'name' THEN 3 ELSE 1 END * m.sim * {idf('n_docs', 'df')}
        * {weight('m.tf', 'm.dl', 'avg_len')}) AS score
      FROM matched m JOIN stats s ON m.field = s.field AND m.term = s.term JOIN field_stats f ON m.field = f.field GROUP BY ALL)
    GROUP BY query_id, id""",
    "search_sorted_page": with_(PRODUCTS, REQUESTS, FIELDS, matches("asked", "query", FUZZY), HITS)
    + "SELECT query_id, rank, id, total_hits, total_pages FROM paged",
    "search_highlight": with_(PRODUCTS, REQUESTS, FIELDS, matches("asked", "query", FUZZY))
    + f"""SELECT h.query_id, h.id, {marked('p.name', 'h.terms')} AS name, {marked('p.description', 'h.terms')} AS description
    FROM (SELECT query_id, id, list(DISTINCT term) AS terms FROM matched GROUP BY ALL) h JOIN products p ON h.id = p.id""",
    "spell_suggest": with_(PRODUCTS, REQUESTS, SPELL)
    + "SELECT DISTINCT query, position, term AS suggestion FROM spelled WHERE term <> lower(query)",
    "correct_query": with_(PRODUCTS, REQUESTS, SPELL)
    + f"SELECT query_id, query, corrected, {joined('suggestions')} AS suggestions FROM fixed",
    "vocabulary_suggest": with_(PRODUCTS, VOCABULARY) + "SELECT position, term FROM catalog_terms",
    "final_suggestions": with_(PRODUCTS, REQUESTS, SPELL, FIELDS, matches("fixed", "corrected", FUZZY), HITS, VOCABULARY)
    + f""", totals AS (SELECT a.query_id, count(h.id) AS total_hits FROM asked a LEFT JOIN hit h ON a.query_id = h.query_id GROUP BY ALL),
    offered AS (SELECT coalesce(list(term ORDER BY position), {FALLBACK}) AS terms FROM catalog_terms)
    SELECT f.query_id, f.corrected AS corrected_query, CASE WHEN f.error IS NULL THEN t.total_hits END AS total_hits, f.error,
      CASE WHEN f.error IS NULL
        THEN {joined('CASE WHEN len(f.suggestions) = 0 AND t.total_hits <= 3 THEN o.terms ELSE f.suggestions END')} END AS suggestions
    FROM fixed f JOIN totals t ON f.query_id = t.query_id, offered o""",
    "catalog_search": with_(PRODUCTS, REQUESTS, SPELL, FIELDS, matches("fixed", "corrected", FUZZY), HITS) + SHOWN,
    "suggest_prefix": with_(PRODUCTS, PREFIXES, BY_PREFIX) + "SELECT prefix_id, rank, id, name, score FROM stage1",
    "suggest_contains": with_(PRODUCTS, PREFIXES, BY_CONTAINS) + "SELECT prefix_id, rank, id, name, score FROM stage2",
    "suggest_fuzzy": with_(PRODUCTS, PREFIXES, BY_FUZZY) + "SELECT prefix_id, rank, id, name, score FROM stage3",
    "suggest_cascade": with_(PRODUCTS, PREFIXES, BY_PREFIX, BY_CONTAINS, BY_FUZZY)
    + """, every AS (SELECT 1 AS stage, * FROM stage1 UNION ALL SELECT 2, * FROM stage2 UNION ALL SELECT 3, * FROM stage3),
    chosen AS (SELECT * FROM every QUALIFY stage = min(stage) OVER (PARTITION BY prefix_id)),
    named AS (SELECT prefix_id, stage, name, min(rank) AS b FROM chosen WHERE name IS NOT NULL GROUP BY ALL)
    SELECT prefix_id, row_number() OVER (PARTITION BY prefix_id ORDER BY b) AS position, name, CAST(stage AS BIGINT) AS stage FROM named""",
    "route_events": with_(CHANGES, ENCODED, MESSAGES)
    + f"SELECT seq_id, op, CASE op {QUEUE_CASE} END AS queue, CASE op {KEY_CASE} END AS routing_key FROM messages",
    "retry_or_dead": with_(CHANGES, ENCODED, MESSAGES, DECODED)
    + f"""SELECT seq_id, error, CASE WHEN retry_count >= 3 THEN '{S.QUEUE_DEAD}' ELSE '{S.QUEUE_RETRY}' END AS queue,
      CAST(CASE WHEN retry_count < 3 THEN retry_count + 1 END AS BIGINT) AS retry_count,
      CASE WHEN retry_count < 3 THEN seq_ts + INTERVAL 5 SECOND END AS available_at,
      CASE WHEN retry_count >= 3 THEN seq_ts END AS dead_at FROM judged WHERE error IS NOT NULL""",
    "due_retries": with_(CHANGES, ENCODED, MESSAGES, QUEUED)
    + f"""SELECT seq_id, CASE op {QUEUE_CASE} END AS queue, payload, CAST(retry_count AS BIGINT) AS retry_count FROM queued
    WHERE queue = '{S.QUEUE_RETRY}' AND available_at <= TIMESTAMP '2024-01-15'""",
    "expire_dead": with_(CHANGES, ENCODED, MESSAGES, QUEUED)
    + f"""SELECT seq_id, queue, dead_at FROM queued
    WHERE queue <> '{S.QUEUE_DEAD}' OR dead_at > TIMESTAMP '2024-01-31' - INTERVAL 14 DAY""",
    "reprocess_dead": with_(CHANGES, ENCODED, MESSAGES, QUEUED)
    + f"""SELECT seq_id, 'CREATED' AS op, '{S.QUEUE_CREATED}' AS queue, 'products.created' AS routing_key, payload
    FROM (SELECT seq_id, {normalized('payload')} AS payload FROM queued WHERE queue = '{S.QUEUE_DEAD}') WHERE json_valid(payload)""",
    "queue_status": with_(CHANGES, ENCODED, MESSAGES, QUEUED)
    + f"""SELECT q.queue, count(m.seq_id) AS messages, CASE WHEN count(m.seq_id) > 10 THEN 'high' WHEN count(m.seq_id) > 5 THEN 'medium'
      WHEN count(m.seq_id) > 0 THEN 'low' ELSE 'none' END AS level
    FROM (SELECT unnest({S.QUEUES!r}) AS queue) q LEFT JOIN queued m ON q.queue = m.queue GROUP BY q.queue""",
    "queue_peek": with_(CHANGES, ENCODED, MESSAGES, QUEUED)
    + f"""SELECT queue, position, seq_id, {normalized('tidied')} AS message FROM (
      SELECT *, {tidy('payload')} AS tidied, row_number() OVER (PARTITION BY queue ORDER BY seq_ts, seq_id) AS position FROM queued
      QUALIFY position <= 10)""",
    "stream_apply": with_(CHANGES, FOLDED)
    + 'SELECT id, name, description, CAST(price AS DOUBLE) AS price, "updatedAt", "priceChangedAt" FROM folded',
    "stream_search": with_(
        CHANGES, FOLDED, FEED_PRODUCTS, REQUESTS.replace(SEARCHES_SQL, FEED_SEARCHES_SQL), SPELL, FIELDS, matches("fixed", "corrected", FUZZY), FEED_HITS
    )
    + FEED_SHOWN,
    "reindex_catalog": with_(CHANGES, HISTORY)
    + f"""SELECT version + 1 AS version, created_at, table_name, seq_id, id, name, description, price, name AS "nameSpell",
      {clean('name')} AS "nameSpellClean", {key('name', 'description')} AS "uniqueKey" FROM history WHERE version = 12""",
    "snapshot_catalog": with_(PRODUCTS)
    + """SELECT id, name, description, CAST(price AS DOUBLE) AS price, 'snapshot_2024-01-31_00-00-00' AS version,
      TIMESTAMP '2024-01-31' AS created_at, 'products' AS table_name FROM products""",
    "retain_versions": with_(CHANGES, HISTORY) + "SELECT * FROM history QUALIFY dense_rank() OVER (ORDER BY version DESC) <= 7",
    "retain_days": with_(CHANGES, HISTORY) + "SELECT * FROM history WHERE created_at >= TIMESTAMP '2024-01-24'",
    "restore_version": with_(CHANGES, HISTORY) + "SELECT * FROM history WHERE version = 12 AND table_name NOT LIKE '.%'",
}
