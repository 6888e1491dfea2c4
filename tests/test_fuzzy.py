import random

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import fuzzy


def distances(words_a, words_b, budget):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE a (w VARCHAR)")
    connection.execute("CREATE TABLE b (w VARCHAR)")
    connection.executemany("INSERT INTO a VALUES (?)", [(w,) for w in words_a])
    connection.executemany("INSERT INTO b VALUES (?)", [(w,) for w in words_b])
    return set(
        connection.sql(
            f"SELECT a.w, b.w, damerau_levenshtein(a.w, b.w) FROM a, b WHERE damerau_levenshtein(a.w, b.w) <= {budget}"
        ).fetchall()
    )


AUTO = "CASE WHEN length(a.w) <= 2 THEN 0 WHEN length(a.w) <= 5 THEN 1 ELSE 2 END"


def words(seed, n, letters="abc", longest=9):
    pick = random.Random(seed)
    return sorted({"".join(pick.choice(letters) for _ in range(pick.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("letters, longest", [("ab", 8), ("abc", 9), ("abcdef", 7)])
def test_join_equals_all_pairs(spark, letters, longest):
    a, b = words(1, 250, letters, longest), words(2, 250, letters, longest)
    tokens = spark.createDataFrame([(w,) for w in a], "token string").withColumn("edits", fuzzy.edit_budget(F.col("token")))
    terms = spark.createDataFrame([(w,) for w in b], "term string")
    found = {tuple(r) for r in fuzzy.fuzzy_join(tokens, terms).collect()}
    assert found == distances(a, b, AUTO)


@pytest.mark.parametrize("few", [0, 10**9])
def test_long_words_meet_by_parts(spark, monkeypatch, few):
    """Around the length from which parts are used, and at the greatest; with either way of joining."""
    monkeypatch.setattr(fuzzy, "FEW_KEYS", few)
    pick = random.Random(9)

    def edited(word):
        letters = list(word)
        for _ in range(pick.randint(0, 3)):
            at = pick.randrange(len(letters) - 1)
            kind = pick.randrange(4)
            if kind == 0:
                letters[at : at + 2] = letters[at : at + 2][::-1]
            elif kind == 1:
                del letters[at]
            elif kind == 2:
                letters.insert(at, pick.choice("ab"))
            else:
                letters[at] = pick.choice("ab")
        return "".join(letters)

    base = ["".join(pick.choice("abcdefgh") for _ in range(n)) for n in (21, 23, 24, 25, 26, 28, 40, 255)]
    a, b = ([edited(w) for w in base for _ in range(12)] + base for _ in range(2))
    tokens = spark.createDataFrame([(w, 2) for w in a], "token string, edits int")
    terms = spark.createDataFrame([(w,) for w in b], "term string")
    found = {tuple(r) for r in fuzzy.fuzzy_join(tokens, terms).collect()}
    assert found == distances(a, b, "2") and max(len(x) for x, _, _ in found) >= 253
    keys = spark.createDataFrame([("x" * 255,)], "w string").selectExpr(f"size({fuzzy.token_parts('w')}) n", f"size({fuzzy.term_parts('w')}) m")
    assert keys.first()["n"] <= 125 and keys.first()["m"] == 5


def test_distance_of_known_pairs(spark):
    pairs = [("ca", "abc", 2), ("ab", "ba", 1), ("abcd", "badc", 2), ("tecado", "teclado", 1), ("hedsett", "headset", 2)]
    pairs += [("notbuk", "notebook", None), ("", "ab", 2), ("same", "same", 0), ("über", "ber", 1), ("abcdef", "fedcba", None)]
    found = spark.createDataFrame(pairs, "a string, b string, d int").select("d", fuzzy.edit_distance_upto_2("a", "b").alias("got"))
    assert all(r["d"] == r["got"] for r in found.collect())


def test_plan_is_an_equi_join(spark):
    tokens = spark.createDataFrame([("abc", 1)], "token string, edits int")
    terms = spark.createDataFrame([("abd",)], "term string")
    plan = fuzzy.fuzzy_join(tokens, terms)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
