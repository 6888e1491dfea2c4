import pytest
from pyspark.sql import functions as F

from shelfmark.functions import messages as msg
from shelfmark.functions import text as tx


def value(spark, column_of, text):
    row = spark.createDataFrame([(text,)], "s string").select(column_of(F.col("s")).alias("v")).first()
    return row["v"]


@pytest.mark.parametrize(
    "name, cleaned",
    [("Hub 00ff3a", "Hub"), ("Hub 00FF3A", "Hub 00FF3A"), ("facade", ""), ("\tRTX 4060\n", "RTX 4060"), (None, None)],
)
def test_clean_name(spark, name, cleaned):
    assert value(spark, tx.clean_name, name) == cleaned


@pytest.mark.parametrize(
    "name, term",
    [
        ("Notebook Gamer", "notebook"),
        ("RTX 4060", "rtx"),
        ("3D Printer", "3d printer"),
        ("TV Box", "tv box"),
        ("Hub 00ff3a", "hub"),
        ("facade", ""),
        (None, None),
    ],
)
def test_main_term(spark, name, term):
    assert value(spark, tx.main_term, name) == term


def test_keys(spark):
    rows = spark.createDataFrame([(" Memória ", "DDR5"), ("memoria", "ddr5"), ("x", None)], "n string, d string")
    unique = [r[0] for r in rows.select(tx.unique_key(F.col("n"), F.col("d"))).collect()]
    normal = [r[0] for r in rows.select(tx.normalized_key(F.col("n"), F.col("d"))).collect()]
    assert unique == ["memória::ddr5", "memoria::ddr5", "x::"]
    assert normal[0] == normal[1] == "memoria::ddr5"


def test_fold(spark):
    assert value(spark, tx.fold, "Straße ÆØÅ Ñandú çà ŒUVRE Łódź") == "strasse aeoa nandu ca oeuvre lodz"


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("RTX-4060", ["rtx", "4060"]),
        ("1.5m a_b", ["1.5m", "a_b"]),
        ("Memória, d'água.", ["memória", "d'água"]),
        ("a" * 300, ["a" * 255, "a" * 45]),
        ("---", []),
        (None, []),
    ],
)
def test_standard_tokens(spark, text, tokens):
    assert value(spark, tx.standard_tokens, text) == tokens


def test_folded_tokens(spark):
    assert value(spark, tx.folded_tokens, "Memória Straße") == ["memoria", "strasse"]


def test_edge_ngrams(spark):
    assert value(spark, tx.edge_ngrams, "a Ré-4060") == ["re", "40", "406", "4060"]
    assert value(spark, tx.edge_ngrams, "x" * 25) == ["x" * n for n in range(2, 21)]
    assert value(spark, tx.edge_ngrams, "a b") == []
    assert value(spark, tx.edge_ngrams, None) == []


def test_mark_first(spark):
    mark = lambda term: lambda c: tx.mark_first(c, F.lit(term))
    assert value(spark, mark("NO"), "Mouse Notebook no") == "Mouse <mark>No</mark>tebook no"
    assert value(spark, mark("a.c"), "abc a.c") == "abc <mark>a.c</mark>"
    assert value(spark, mark("zz"), "abc") == "abc"
    assert value(spark, mark(""), "abc") == "abc"


def test_highlight(spark):
    wrap = lambda c: tx.highlight(c, F.array(F.lit("rtx"), F.lit("4060")))
    assert value(spark, wrap, "Nova RTX-4060\n(rtxx)") == "Nova <strong>RTX</strong>-<strong>4060</strong>\n(rtxx)"


@pytest.mark.parametrize(
    "body, tidy",
    [
        (None, "[Empty message]"),
        ("", "[Empty message]"),
        (' {"a" : 1, "b": "x  y"} ', '{"a":1,"b":"x  y"}'),
        ('{\\"a\\": 1}', '{"a":1}'),
        ("{oops}", "{oops}"),
        ("plain", "plain"),
    ],
)
def test_tidy_message(spark, body, tidy):
    assert value(spark, msg.tidy_message, body) == tidy


@pytest.mark.parametrize(
    "body, normal",
    [(None, ""), ('"{\\"a\\": 1}"', '{"a":1}'), ('{"a":\\n 1}\\r', '{"a":1}'), ("oops {", "oops {")],
)
def test_normalize_message(spark, body, normal):
    assert value(spark, msg.normalize_message, body) == normal
