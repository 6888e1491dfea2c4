from decimal import Decimal

from shelfmark import schemas as S
from shelfmark.operators import products, validation
from shelfmark.sources import events


def test_validation_messages(spark):
    rows = [
        (1, "ok", "d", Decimal("0.01")),
        (2, "  ", "\t", None),
        (3, None, None, Decimal("0")),
        (4, "x" * 256, "d", Decimal("-1")),
        (5, "x", "d", Decimal("123456789.9990")),
        (6, "x", "d", Decimal("99999999.9950")),
    ]
    checked = validation.validate(spark.createDataFrame(rows, "row_id int, name string, description string, price decimal(14,4)"))
    found = {r["row_id"]: [(e["field"], e["message"]) for e in r["errors"]] for r in checked.collect()}
    assert found[1] == []
    assert found[2] == [("name", S.NAME_REQUIRED), ("description", S.DESCRIPTION_REQUIRED), ("price", S.PRICE_REQUIRED)]
    assert found[3] == [("name", S.NAME_REQUIRED), ("description", S.DESCRIPTION_REQUIRED), ("price", S.PRICE_POSITIVE)]
    assert found[4] == [("name", S.NAME_TOO_LONG), ("price", S.PRICE_POSITIVE)]
    assert found[5] == found[6] == [("price", S.PRICE_OUT_OF_RANGE)]
    assert [r["row_id"] for r in validation.accepted(checked).collect()] == [1]
    assert validation.rejected(checked).count() == 10


def test_lookup_repeats_requests(spark):
    items = spark.createDataFrame([("1", "a", "b", Decimal("2.00"))], S.PRODUCT)
    asked = spark.createDataFrame([(i, "1" if i % 3 else "x") for i in range(30)], "request_id int, id string")
    found = products.lookup(asked, items).collect()
    assert len(found) == 30 and all(r["found"] == (r["request_id"] % 3 != 0) for r in found)


def test_seed_only_when_empty(spark, tmp_path):
    """Of equal pairs the first in seed order is kept, whatever its price, and the others are rejected."""
    rows = ['{"name":"a","description":"b","price":1.5}', '{"name":"é","description":"c","price":2}', '{"name":"a","description":"b","price":0.5}']
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "1.json").write_text("[" + ",\n ".join(rows[:2]) + "]")
    (tmp_path / "array" / "2.json").write_text("[" + rows[2] + "]")
    (tmp_path / "lines.json").write_text("\n".join(rows))
    empty = spark.createDataFrame([], S.PRODUCT)
    for path, lines in (("array", False), ("lines.json", True)):
        seed = events.read_seed(spark, str(tmp_path / path), lines)
        inserted, created, rejected = products.seed_if_empty(seed, empty)
        assert {(r["name"], r["price"]) for r in inserted.collect()} == {("a", Decimal("1.50")), ("é", Decimal("2.00"))}
        assert [r["queue"] for r in created.collect()] == [S.QUEUE_CREATED] * 2
        refused = rejected.collect()
        assert [(r["name"], r["price"]) for r in refused] == [("a", Decimal("0.50"))]
        assert refused[0]["holder"] in {r["id"] for r in products.seed_if_empty(seed, empty)[0].collect()}
        found = products.seed_if_empty(seed, spark.createDataFrame([("1", "a", "b", None)], S.PRODUCT))
        assert all(df.isEmpty() for df in found)


def test_decode_is_strict(spark):
    bodies = [
        ("CREATED", '{"id":"1","name":"a","description":"b","price":1.50}', None),
        ("CREATED", '{"id":"1","extra":1}', "unknown key"),
        ("CREATED", '{"id":"1"', "malformed"),
        ("CREATED", "", "malformed"),
        ("CREATED", '{"id":null}', "missing id"),
        ("UPDATED", '{"id":"1","price":"12.5"}', None),
        ("UPDATED", '{"id":"1","price":"cheap"}', "bad price"),
        ("DELETED", '{"id":"1","name":"a","description":"b"}', None),
        ("DELETED", '{"id":"1","price":1}', "unknown key"),
        ("UPDATED", '{"id":"1","updatedAt":"x","uniqueKey":"k"}', "bad time"),
        ("UPDATED", '{"id":"1","updatedAt":"2024-01-05T06:07:08.009Z","priceChangedAt":null}', None),
        ("CREATED", '{"id":"1","name":{"a":1}}', "bad type"),
        ("CREATED", '{"id":["1"]}', "bad type"),
        ("CREATED", '{"id":"1","description":[]}', "bad type"),
        ("DELETED", '{"id":"1","name":{}}', "bad type"),
        ("CREATED", '{"id":7,"name":true,"description":"OBJECT<ARRAY<"}', None),
        ("CREATED", '[{"id":"1"}]', "malformed"),
    ]
    rows = [(None, i, op, body, 0) for i, (op, body, _) in enumerate(bodies)]
    decoded = {r["seq_id"]: r for r in events.decode(spark.createDataFrame(rows, S.MESSAGE)).collect()}
    assert [decoded[i]["error"] for i in range(len(bodies))] == [error for _, _, error in bodies]
    assert decoded[0]["price"] == Decimal("1.50") and decoded[5]["price"] == Decimal("12.50")


def test_duplicate_creates(spark):
    schema = "seq_id int, id string, name string, description string"
    batch = spark.createDataFrame([(1, "n1", "a", "x"), (2, "n2", "a", "x"), (3, "n3", "A", "x"), (4, "n4", "b", "y")], schema)
    existing = spark.createDataFrame([("old", "b", "y")], "id string, name string, description string")
    holders = {r["id"]: r["holder"] for r in products.duplicate_creates(batch, existing).collect()}
    assert holders == {"n1": None, "n2": "n1", "n3": None, "n4": "old"}


def test_duplicate_updates(spark):
    items = spark.createDataFrame([("1", "a", "x", None), ("2", "b", "y", None), ("3", "b", "z", None)], S.PRODUCT)
    schema = "seq_id int, id string, name string, description string"
    asked = [(1, "1", "a", "x"), (2, "1", "b", "y"), (3, "2", "b", "z"), (4, "2", "B", "y"), (5, "9", "a", "x")]
    judged = products.duplicate_updates(spark.createDataFrame(asked, schema), items).collect()
    assert {r["seq_id"]: (r["found"], r["duplicate"]) for r in judged} == {
        1: (True, False),
        2: (True, True),
        3: (True, True),
        4: (True, False),
        5: (False, False),
    }


def test_distinct_names_come_from_the_first_ten(spark):
    ranked = [(1, r, "same" if r % 2 else f"n{r}") for r in range(1, 15)] + [(2, 1, None), (2, 2, "only")]
    names = products.distinct_names(spark.createDataFrame(ranked, "g int, rank int, name string"), "g")
    rows = sorted((r["g"], r["position"], r["name"]) for r in names.collect())
    assert rows == [(1, 1, "same"), (1, 2, "n2"), (1, 3, "n4"), (1, 4, "n6"), (1, 5, "n8"), (1, 6, "n10"), (2, 1, "only")]
