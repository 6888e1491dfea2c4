"""Request validation: one message per field, first rule that fails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.functions.text import is_blank


def validate(requests: DataFrame) -> DataFrame:
    """Add `errors`, an array of (field, message); empty for an acceptable row."""
    name, description, price = F.col("name"), F.col("description"), F.col("price")
    messages = {
        "name": F.when(is_blank(name), S.NAME_REQUIRED).when(F.length(name) > 255, S.NAME_TOO_LONG),
        "description": F.when(is_blank(description), S.DESCRIPTION_REQUIRED),
        "price": F.when(price.isNull(), S.PRICE_REQUIRED)
        .when(price <= 0, S.PRICE_POSITIVE)
        .when(price.try_cast(S.PRICE).isNull(), S.PRICE_OUT_OF_RANGE),
    }
    found = F.array(
        *[
            F.when(message.isNotNull(), F.struct(F.lit(field).alias("field"), message.alias("message")))
            for field, message in messages.items()
        ]
    )
    return requests.withColumn("errors", F.filter(found, lambda e: e.isNotNull()))


def accepted(validated: DataFrame) -> DataFrame:
    """Acceptable rows with the price in the table's type."""
    return (
        validated.filter(F.size("errors") == 0)
        .drop("errors")
        .withColumn("price", F.col("price").cast(S.PRICE))
    )


def rejected(validated: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row id, field, message), one row per failed field."""
    return validated.select(row_id, F.inline("errors"))
