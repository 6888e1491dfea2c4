from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.operators import products, search, spelling, suggest

ITEMS = [
    ("1", "Notebook Gamer", "RTX 4060 16GB", "4500.00"),
    ("2", "Notebook Lenovo Ryzen", "Memory 24GB", "3800.00"),
    ("3", "Monitor LCD 27", "AOC 27 Polegadas 5ms", "989.80"),
    ("4", "Mouse Razer", "DeathAdder Elite", "523.06"),
    ("5", "Headset Gamer", "Razer Kraken X", "399.90"),
    ("6", "Teclado Gamer 00ff3a", "Switch Blue", "399.90"),
    ("7", "Mouse Gamer", "Wireless", "200.00"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, n, d, Decimal(p)) for i, n, d, p in ITEMS], S.PRODUCT)


REQUESTS = {
    1: ("rtx", None, None, 0, 12, "price,asc"),
    2: ("tecado", None, None, 0, 12, "price,asc"),
    3: ("notibook", None, None, 0, 12, "price,desc"),
    4: (None, None, None, 0, 12, "price,asc"),
    5: ("hedsett", None, None, 0, 12, "price,asc"),
    6: ("monitr", None, None, 0, 12, "price,asc"),
    7: ("notbuk", None, None, 0, 12, "price,asc"),
    8: (None, 3000.0, 6000.0, 0, 12, "price,asc"),
    9: ("notebook", 3000.0, 6000.0, 0, 1, "price,asc"),
    10: ("notbook gamer", None, None, 0, 12, "price,asc"),
    11: ("gamer", None, None, 9, 12, "price,asc"),
    12: ("gamer", 500.0, 100.0, 0, 12, "price,asc"),
    13: ("gamer", None, None, 0, 2, "price,asc"),
    14: ("back\\slash", None, None, 0, 12, "price,asc"),
    15: (None, None, None, 1, 3, "name,desc"),
    16: ("gamer", None, None, 1, 2, "price,asc"),
    17: ("gamer", None, None, 0, 12, "weight,asc"),
    18: ("gamer", None, None, -1, 12, "price,asc"),
    19: (None, None, None, 0, 0, "price,asc"),
    20: ("gamer", None, None, None, None, None),
    21: ("mouse notebook", None, None, 0, 12, "price"),
}


@pytest.fixture(scope="module")
def answers(spark, items):
    requests = spark.createDataFrame([(i, *r) for i, r in REQUESTS.items()], S.SEARCH_REQUEST)
    rows, summary = search.search(requests, items)
    hits = {}
    for row in sorted(rows.collect(), key=lambda r: (r["query_id"], r["rank"])):
        hits.setdefault(row["query_id"], []).append(row)
    return hits, {r["query_id"]: r for r in summary.collect()}


def ids(answers, query_id):
    return [r["id"] for r in answers[0].get(query_id, [])]


def test_plain_and_corrected_queries(answers):
    assert ids(answers, 1) == ["1"]
    assert ids(answers, 2) == ["6"] and answers[1][2]["corrected_query"] == "teclado"
    assert ids(answers, 3) == ["1", "2"] and answers[1][3]["corrected_query"] == "notebook"
    assert ids(answers, 5) == ["5"] and ids(answers, 6) == ["3"]
    assert answers[0][2][0]["corrected_query"] == "teclado" and answers[0][1][0]["corrected_query"] is None


def test_a_correction_replaces_the_whole_query(answers):
    assert answers[1][10]["corrected_query"] == "notebook" and ids(answers, 10) == ["2", "1"]


def test_hopeless_query_gets_vocabulary(answers):
    assert ids(answers, 7) == []
    assert answers[1][7]["suggestions"] == ["headset", "monitor", "mouse", "notebook", "teclado"]
    assert answers[1][7]["corrected_query"] == "notbuk" and answers[1][7]["total_hits"] == 0


def test_listing_bounds_pages_and_ties(answers):
    assert ids(answers, 4) == ["7", "5", "6", "4", "3", "2", "1"] and answers[1][4]["corrected_query"] is None
    assert ids(answers, 8) == ["2", "1"]
    assert ids(answers, 9) == ["2"] and answers[0][9][0]["total_hits"] == 2 and answers[0][9][0]["total_pages"] == 2
    assert ids(answers, 11) == [] and answers[1][11]["total_hits"] == 4
    assert ids(answers, 12) == [] and answers[1][12]["total_hits"] == 0
    assert ids(answers, 13) == ["7", "5"] and ids(answers, 16) == ["6", "1"]
    assert [r["rank"] for r in answers[0][16]] == [3, 4]
    assert ids(answers, 15) == ["4", "7", "3"]
    assert ids(answers, 14) == []


def test_refused_requests_keep_their_row(answers):
    errors = {i: answers[1][i]["error"] for i in REQUESTS}
    assert {i: e for i, e in errors.items() if e} == {17: "unknown sort field", 18: "negative page", 19: "empty page"}
    assert not {17, 18, 19} & set(answers[0]) and answers[1][17]["total_hits"] is None
    assert ids(answers, 20) == ["7", "5", "6", "1"]
    assert ids(answers, 21) == ["7", "4", "2", "1"]


def test_hits_are_whole_documents(spark, items):
    stamp = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    stored = products.documents(items, stamp).withColumn("updatedAt", F.when(F.col("id") == "5", stamp))
    requests = spark.createDataFrame([(1, "gamer", None, None, 0, 9, "updatedAt,desc"), (2, None, None, None, 0, 2_000_000_000, "id")], S.SEARCH_REQUEST)
    rows = search.search(requests, stored)[0].orderBy("query_id", "rank").collect()
    assert [r["id"] for r in rows] == ["5", "1", "6", "7", *"1234567"]
    assert rows[2]["nameSpellClean"] == "Teclado Gamer" and rows[0]["uniqueKey"] == "headset gamer::razer kraken x"
    assert rows[0]["updatedAt"] is not None and rows[0]["priceChangedAt"] is not None and rows[1]["updatedAt"] is None


def test_no_step_stores_all_hits(spark, monkeypatch):
    """A listing of 5,000 products of which a page of 3 is shown settles few rows per spec."""
    items = spark.range(5000).selectExpr("cast(id as string) id", "'thing' name", "'d' description", "cast(id as decimal(10,2)) price")
    sizes, settle = [], search.settle
    monkeypatch.setattr(search, "settle", lambda df: sizes.append((df.columns, (out := settle(df)).count())) or out)
    requests = spark.createDataFrame([(1, None, None, None, 0, 3, "price,asc"), (2, "thing", None, None, 1, 2, "id")], S.SEARCH_REQUEST)
    rows, summary = search.search(requests, items)
    assert [r["total_hits"] for r in summary.collect()] == [5000, 5000] and rows.count() == 5
    assert all(n <= 100 for columns, n in sizes if "spec_id" in columns)


def test_highlight_covers_both_fields(answers):
    assert answers[0][1][0]["description"] == "<strong>RTX</strong> 4060 16GB"
    assert answers[0][3][0]["name"] == "<strong>Notebook</strong> Gamer"


def test_deep_pages_use_the_distributed_rank(spark, items, monkeypatch):
    requests = spark.createDataFrame([(i, *r) for i, r in REQUESTS.items()], S.SEARCH_REQUEST)
    usual = {tuple(r) for r in search.search(requests, items)[0].collect()}
    monkeypatch.setattr(search, "DEEP", 1)
    assert {tuple(r) for r in search.search(requests, items)[0].collect()} == usual


def test_empty_catalog_offers_fixed_terms(spark):
    requests = spark.createDataFrame([(1, "mouse", None, None, 0, 12, "price,asc")], S.SEARCH_REQUEST)
    rows, summary = search.search(requests, spark.createDataFrame([], S.PRODUCT))
    assert rows.isEmpty() and summary.first()["suggestions"] == S.FALLBACK_SUGGESTIONS


def test_suggestions_need_a_more_frequent_word(spark):
    words = spark.createDataFrame([("mouse", 5), ("moose", 1), ("house", 9)], "term string, df bigint")
    asked = spark.createDataFrame([("mouse",), ("moose",), ("mose",), ("mo",)], "query string")
    found = {(r["query"], r["position"], r["suggestion"]) for r in spelling.suggest(asked, words).collect()}
    assert found == {("moose", 1, "mouse"), ("mose", 1, "mouse"), ("mose", 2, "moose")}


PREFIXES = ["no", "notebook g", "oteb", "hedset", "  ", "mo*or", "zzzz", "MOUSE", "gamer no", "t?clado"]


def test_cascade(spark, items):
    requests = spark.createDataFrame(list(enumerate(PREFIXES)), S.SUGGEST_REQUEST)
    found = {}
    for row in sorted(suggest.cascade(requests, items).collect(), key=lambda r: (r["prefix_id"], r["position"])):
        found.setdefault(PREFIXES[row["prefix_id"]], []).append((row["stage"], row["name"]))
    assert found["no"] == [(1, "Notebook Gamer"), (1, "Notebook Lenovo Ryzen")]
    assert found["notebook g"] == [(1, "Notebook Gamer")]
    assert {name for _, name in found["oteb"]} == {"Notebook Gamer", "Notebook Lenovo Ryzen"}
    assert found["oteb"][0][0] == 2
    assert found["hedset"] == [(3, "Headset Gamer")]
    assert found["mo*or"][0][0] == 2 and {n for _, n in found["mo*or"]} == {"Monitor LCD 27"}
    assert [name for _, name in found["MOUSE"]] == ["Mouse Gamer", "Mouse Razer"]
    assert found["t?clado"] == [(2, "Teclado Gamer 00ff3a")]
    assert "  " not in found and "zzzz" not in found
    assert found["gamer no"][0][0] == 3
