"""Column functions for queue message bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import java_trim

# Fixed value: what an empty body is shown as.
EMPTY_MESSAGE = "[Empty message]"
OUTSIDE_STRINGS = r'("(?:[^"\\]|\\.)*")|\s+'


def parses(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def compact_json(text: Column) -> Column:
    """JSON text without white space outside strings; key order and number spelling stay."""
    return F.regexp_replace(text, OUTSIDE_STRINGS, "$1")


def tidy_message(body: Column) -> Column:
    """Unescape backslashes, then quotes, trim, and compact a body that is a JSON object or array."""
    text = F.replace(body, F.lit("\\\\"), F.lit("\\"))
    text = java_trim(F.replace(text, F.lit('\\"'), F.lit('"')))
    bracketed = (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))
    tidy = F.when(bracketed & parses(text), compact_json(text)).otherwise(text)
    return F.when(body.isNull() | (body == ""), F.lit(EMPTY_MESSAGE)).otherwise(tidy)


def normalize_message(body: Column) -> Column:
    """Trim, drop outer quotes and escaped line breaks, unescape quotes, then backslashes, compact JSON."""
    text = java_trim(F.coalesce(body, F.lit("")))
    text = F.regexp_replace(text, r'^"+|"+$', "")
    for escaped, plain in (("\\r", ""), ("\\n", ""), ('\\"', '"'), ("\\\\", "\\")):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return F.when(parses(text), compact_json(text)).otherwise(text)
