"""The request tables the registered queries answer, as rows and as SQL VALUES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark import schemas as S

# (query_id, query, min_price, max_price, page, size, sort)
SEARCHES = [
    (1, "widget", None, None, 0, 12, "price,asc"),
    (2, "widgt", 900.0, 950.0, 0, 5, "price,asc"),
    (3, "gizom", None, None, 1, 4, "price,DESC"),
    (4, "anvli", None, None, 0, 12, "name,asc"),
    (5, "plat", 905.5, None, 1, 5, "price"),
    (6, "rign", None, 930.0, 0, 12, "name,desc"),
    (7, "larg gear", None, None, 2, 6, "price,asc"),
    (8, "xyzzy", None, None, 0, 12, "price,asc"),
    (9, None, None, None, 2, 10, "price,asc"),
    (10, "  ", 920.0, 930.0, 0, 7, "price,desc"),
    (11, "economy Brand", None, None, 0, 12, "id,asc"),
    (12, "widget", 950.0, 900.0, 0, 12, "price,asc"),
    (13, "bolt", None, None, 9999, 12, "price,asc"),
    (14, "Brand#12", None, 980.25, 0, 12, "price,asc"),
    (15, "back\\slash", None, None, 0, 12, "price,asc"),
    (16, "widget", None, None, 1, 12, "price,asc"),
    (17, "---", None, None, 0, 12, "price,asc"),
    (18, "", None, 900.2, 0, 5, "price,asc"),
    (19, None, None, None, 0, 15, "name,desc"),
    (20, "widget", None, None, 0, 5, "uniqueKey,desc"),
    (21, "ring", None, None, 0, 6, "updatedAt,desc"),
    (22, "ring", None, None, 1, 4, "priceChangedAt,asc"),
    (23, "widget", None, None, -1, 12, "price,asc"),
    (24, "widget", None, None, 0, 0, "price,asc"),
    (25, "widgt", None, None, 0, 12, "color,asc"),
    (26, "widget", None, None, None, None, None),
    (27, None, None, None, 0, 3, "uniqueKey"),
]

#: Requests for what the change feed tells about.
FEED_SEARCHES = [
    (1, "product 12", None, None, 0, 12, "price,asc"),
    (2, "prodct", None, None, 1, 9, "price,desc"),
    (3, "rev 7", 20.0, None, 0, 12, "name,asc"),
    (4, "42 17", None, None, 0, 12, "id,desc"),
    (5, "nothing", None, None, 0, 12, "price,asc"),
    (6, None, None, 30.0, 0, 15, "updatedAt,desc"),
    (7, "rve", None, None, 0, 6, "priceChangedAt,asc"),
    (8, "99", None, None, -1, 6, "price,asc"),
]

PREFIXES = [
    (1, "ri"),
    (2, "large g"),
    (3, "idge"),
    (4, "wdiget"),
    (5, "   "),
    (6, "  BLU "),
    (7, "g*r"),
    (8, "zzzzzz"),
    (9, "small ring"),
    (10, "r"),
    (11, "?ol"),
    (12, "ld p"),
    (13, "larg"),
    (14, "larqe"),
    (15, None),
    (16, "old"),
]


def searches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEARCHES, S.SEARCH_REQUEST)


def feed_searches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEED_SEARCHES, S.SEARCH_REQUEST)


def prefixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PREFIXES, S.SUGGEST_REQUEST)


def _sql(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return repr(value)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in rows)


def _searches_sql(rows: list[tuple]) -> str:
    return (
        "SELECT CAST(query_id AS BIGINT) AS query_id, CAST(query AS VARCHAR) AS query, "
        "CAST(min_price AS DOUBLE) AS min_price, CAST(max_price AS DOUBLE) AS max_price, page, size, sort "
        f"FROM (VALUES {_values(rows)}) AS v(query_id, query, min_price, max_price, page, size, sort)"
    )


SEARCHES_SQL = _searches_sql(SEARCHES)
FEED_SEARCHES_SQL = _searches_sql(FEED_SEARCHES)
PREFIXES_SQL = (
    "SELECT CAST(prefix_id AS BIGINT) AS prefix_id, CAST(prefix AS VARCHAR) AS prefix "
    f"FROM (VALUES {_values(PREFIXES)}) AS v(prefix_id, prefix)"
)
