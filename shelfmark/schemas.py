"""Schemas and fixed names shared by the package."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)

PRODUCT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", PRICE),
    ]
)

SEED = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", PRICE),
    ]
)

CHANGE = T.StructType(
    [
        T.StructField("seq_ts", T.TimestampNTZType()),
        T.StructField("seq_id", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", PRICE),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("seq_ts", T.TimestampNTZType()),
        T.StructField("seq_id", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
    ]
)

SEARCH_REQUEST = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("sort", T.StringType()),
    ]
)

SUGGEST_REQUEST = T.StructType(
    [T.StructField("prefix_id", T.LongType()), T.StructField("prefix", T.StringType())]
)

CREATED, UPDATED, DELETED = "CREATED", "UPDATED", "DELETED"

# Queue names and routing keys of the message topology.
QUEUE_CREATED = "products.created.queue"
QUEUE_UPDATED = "products.updated.queue"
QUEUE_DELETED = "products.deleted.queue"
QUEUE_RETRY = "products.retry.5s.queue"
QUEUE_DEAD = "products.dead.queue"
QUEUES = [QUEUE_CREATED, QUEUE_UPDATED, QUEUE_DELETED, QUEUE_RETRY, QUEUE_DEAD]
QUEUE_OF_OP = {CREATED: QUEUE_CREATED, UPDATED: QUEUE_UPDATED, DELETED: QUEUE_DELETED}
ROUTING_KEY_OF_OP = {CREATED: "products.created", UPDATED: "products.updated", DELETED: "products.deleted"}

# Retry policy.
MAX_ATTEMPTS = 3
RETRY_DELAY_SECONDS = 5
DEAD_LETTER_DAYS = 14

# The keys a strict reader of each event accepts.
DOCUMENT_KEYS = [
    "id",
    "name",
    "price",
    "description",
    "nameSpell",
    "nameSpellClean",
    "correctedQuery",
    "uniqueKey",
    "updatedAt",
    "priceChangedAt",
]
DELETED_KEYS = ["id", "name", "description"]
TIME_KEYS = ["updatedAt", "priceChangedAt"]

# Validation messages.
NAME_REQUIRED = "Nome é obrigatório"
DESCRIPTION_REQUIRED = "Descrição é obrigatória"
PRICE_REQUIRED = "Preço é obrigatório"
PRICE_POSITIVE = "Preço deve ser maior que zero"
NAME_TOO_LONG = "name exceeds 255 characters"
PRICE_OUT_OF_RANGE = "price exceeds NUMERIC(10,2)"

# Suggestions offered when the catalog itself yields none.
FALLBACK_SUGGESTIONS = [
    "headset",
    "notebook",
    "monitor",
    "teclado",
    "mouse",
    "ssd",
    "processador",
    "placa de vídeo",
    "memória",
    "fonte",
    "gabinete",
    "water cooler",
    "ventoinha",
    "hub",
    "cabo",
]
