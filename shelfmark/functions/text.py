"""Column functions for names, keys, tokens and n-grams. All are JVM-side expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{M}\p{N}_]+(?:[.'’][\p{L}\p{M}\p{N}_]+)*"
RUN = r"[\p{L}\p{N}]+"
# Fixed value: the suffix that cleaning takes off a name.
HEX_SUFFIX = r"[a-f0-9]{6}$"
JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
MAX_TOKEN = 255

# Lower-case Latin letters without a canonical decomposition.
SINGLE_FOLDS = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ŧ": "t", "ı": "i", "ŋ": "n"}
DOUBLE_FOLDS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij"}


def _fold_table() -> tuple[str, str]:
    """Every lower-case accented Latin letter with the base letter of its decomposition."""
    source, target = [], []
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for code in block:
            char = chr(code)
            base = unicodedata.normalize("NFD", char)[0]
            if char.islower() and base != char and base.isascii() and base.isalpha():
                source.append(char)
                target.append(base)
    return "".join(source) + "".join(SINGLE_FOLDS), "".join(target) + "".join(SINGLE_FOLDS.values())


FOLD_FROM, FOLD_TO = _fold_table()


def java_trim(text: Column) -> Column:
    """Strip every leading and trailing character up to U+0020 (Spark's trim strips spaces only)."""
    return F.regexp_replace(text, JAVA_TRIM, "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (java_trim(text) == "")


def clean_name(name: Column) -> Column:
    """The name without a trailing run of six lower-case hex digits, trimmed."""
    return java_trim(F.regexp_replace(name, HEX_SUFFIX, ""))


def unique_key(name: Column, description: Column) -> Column:
    part = lambda c: F.lower(java_trim(F.coalesce(c, F.lit(""))))
    return F.concat(part(name), F.lit("::"), part(description))


def fold(text: Column) -> Column:
    """Lower-case and strip Latin accents."""
    folded = F.translate(F.lower(text), FOLD_FROM, FOLD_TO)
    for source, target in DOUBLE_FOLDS.items():
        folded = F.replace(folded, F.lit(source), F.lit(target))
    return folded


def normalized_key(name: Column, description: Column) -> Column:
    return fold(unique_key(name, description))


def main_term(name: Column) -> Column:
    """First word of the cleaned name if it has 3+ characters and no digit, else the whole cleaned name."""
    cleaned = clean_name(name)
    word = F.split(cleaned, r"\s+")[0]
    return F.lower(F.when((F.length(word) >= 3) & ~word.rlike(r"\d"), word).otherwise(cleaned))


def mark_first(text: Column, term: Column) -> Column:
    """Wrap the first case-insensitive literal occurrence of the term."""
    at = F.position(F.lower(term), F.lower(text))
    marked = F.concat(
        text.substr(F.lit(1), at - 1),
        F.lit("<mark>"),
        text.substr(at, F.length(term)),
        F.lit("</mark>"),
        text.substr(at + F.length(term), F.length(text)),
    )
    return F.when((F.coalesce(term, F.lit("")) == "") | (at == 0), text).otherwise(marked)


def standard_tokens(text: Column) -> Column:
    """Lower-cased word tokens in text order; an empty array for null. Longer words are cut into pieces."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    pieces = F.transform(
        found,
        lambda t: F.transform(
            F.sequence(F.lit(0), F.floor((F.length(t) - 1) / MAX_TOKEN).cast("int")),
            lambda i: t.substr(i * MAX_TOKEN + 1, F.lit(MAX_TOKEN)),
        ),
    )
    return F.flatten(pieces)


def folded_tokens(text: Column) -> Column:
    """Word tokens, lower-cased and accent-folded. Letters fold to letters, so the text is folded as a whole."""
    return standard_tokens(fold(text))


def runs(text: Column) -> Column:
    """Letter/digit runs, as the n-gram tokenizer sees the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), F.lit(0))


def fold_each(words: Column) -> Column:
    """Fold an array of letter/digit runs with one pass over their joined text."""
    return F.filter(F.split(fold(F.array_join(words, " ")), " "), lambda w: w != "")


def edge_ngrams(text: Column, shortest: int = 2, longest: int = 20) -> Column:
    """Folded prefixes of every letter/digit run, in text order."""
    long_enough = F.filter(runs(text), lambda run: F.length(run) >= shortest)
    prefixes = F.transform(
        long_enough,
        lambda run: F.transform(
            F.sequence(F.lit(shortest), F.least(F.lit(longest), F.length(run))),
            lambda n: run.substr(F.lit(1), n),
        ),
    )
    return fold_each(F.flatten(prefixes))


def highlight(text: Column, terms: Column, before: str = "<strong>", after: str = "</strong>") -> Column:
    """Wrap every token of the text that is one of the terms; all other characters stay."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?:{TOKEN})|(?s:.)"), F.lit(0))
    wrapped = F.transform(
        pieces,
        lambda p: F.when(
            F.array_contains(terms, F.lower(p)), F.concat(F.lit(before), p, F.lit(after))
        ).otherwise(p),
    )
    return F.when(F.coalesce(F.size(terms), F.lit(0)) > 0, F.array_join(wrapped, "")).otherwise(text)
