"""Edit-distance join between request tokens and a vocabulary.

Two strings within k edits share a string reachable from both by at most k deletions. Both sides emit the
hashes of those strings, an equi-join proposes pairs, and each distinct pair is checked exactly. The distance
is Damerau-Levenshtein: an adjacent swap is one edit. Expressions are written as SQL text over column names.

Long words have too many such strings. A long term emits the five parts it is cut into instead: two edits, of which a swap may
touch two parts, leave one part as it is, moved by at most two places. A long token looks for every part at each of
those places, for every length the term may have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import settle

NO_STRINGS = "cast(array() as array<string>)"
NO_HASHES = "cast(array() as array<bigint>)"
FEW_KEYS = 100_000
#: Tokens of more letters than this meet terms by parts; terms within two letters of it emit both kinds of keys.
LONG = 24
PARTS = 5


def edit_budget(token: Column) -> Column:
    """Edits allowed by length: 0 up to two characters, 1 up to five, else 2."""
    return F.when(F.length(token) <= 2, 0).when(F.length(token) <= 5, 1).otherwise(2)


def deletions(text: str, edits: int) -> str:
    """Hashes, tagged with `edits`, of the text and of all strings left after deleting up to that many characters."""
    one = f"concat(left({text}, i - 1), substr({text}, i + 1))"
    two = f"concat(left({one}, j - 1), substr({one}, j + 1))"
    parts = [f"array(xxhash64({edits}, {text}))"]
    if edits >= 1:
        each = f"transform(sequence(1, length({text})), i -> xxhash64({edits}, {one}))"
        parts.append(f"if(length({text}) >= 1, {each}, {NO_HASHES})")
    if edits >= 2:
        inner = f"transform(sequence(i, length({text}) - 1), j -> xxhash64({edits}, {two}))"
        each = f"flatten(transform(sequence(1, length({text}) - 1), i -> {inner}))"
        parts.append(f"if(length({text}) >= 2, {each}, {NO_HASHES})")
    return f"array_distinct(concat({', '.join(parts)}))"


def _part(text: str, length: str, i: str, shift: str = "0") -> str:
    """Hash of part i of a term of some length, as it stands in `text` moved by `shift`; null before the first letter."""
    start, end = f"({length} * {i} div {PARTS})", f"({length} * ({i} + 1) div {PARTS})"
    piece = f"substr({text}, cast({start} + 1 + {shift} as int), cast({end} - {start} as int))"
    return f"if({start} + {shift} >= 0, xxhash64('part', {length}, {i}, {piece}), null)"


def term_parts(term: str) -> str:
    """Hashes of the parts of a long term."""
    return f"transform(sequence(0, {PARTS - 1}), i -> {_part(term, f'length({term})', 'i')})"


def token_parts(token: str) -> str:
    """Hashes of every part that a term within two edits of a long token can share with it."""
    at_shifts = f"transform(sequence(-2, 2), d -> {_part(token, 'n', 'i', 'd')})"
    at_parts = f"flatten(transform(sequence(0, {PARTS - 1}), i -> {at_shifts}))"
    every = f"flatten(transform(sequence(length({token}) - 2, length({token}) + 2), n -> {at_parts}))"
    return f"filter(array_distinct({every}), x -> x is not null)"


def swaps(text: str) -> str:
    """All strings made by exchanging two adjacent characters."""
    swapped = f"concat(left({text}, i - 1), substr({text}, i + 1, 1), substr({text}, i, 1), substr({text}, i + 2))"
    each = f"transform(sequence(1, length({text}) - 1), i -> {swapped})"
    return f"if(length({text}) >= 2, {each}, {NO_STRINGS})"


def edit_distance_upto_2(a: str, b: str) -> Column:
    """Damerau-Levenshtein distance of two columns if it is at most 2, else null.

    A swap costs two plain edits, so a plain distance of 4 needs two swaps and 3 needs at least one.
    """
    return F.expr(
        f"""case
            when levenshtein({a}, {b}, 4) between 0 and 1 then levenshtein({a}, {b}, 4)
            when levenshtein({a}, {b}, 4) = 2
              then if(length({a}) = length({b}) and array_contains({swaps(a)}, {b}), 1, 2)
            when levenshtein({a}, {b}, 4) = 4
              then if(length({a}) = length({b}) and arrays_overlap({swaps(a)}, {swaps(b)}), 2, null)
            when levenshtein({a}, {b}, 4) = 3 and (exists({swaps(a)}, x -> levenshtein(x, {b}, 1) >= 0)
              or exists({swaps(b)}, x -> levenshtein({a}, x, 1) >= 0)
              or arrays_overlap({swaps(a)}, {swaps(b)})) then 2
            end"""
    )


def similarity(distance: Column, a: Column, b: Column) -> Column:
    return 1 - distance / F.least(F.length(a), F.length(b))


def _distinct(words: DataFrame, *columns: str) -> DataFrame:
    """Distinct words over all tasks: they are few bytes but much work each, so partitions must not be merged."""
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.select(*columns).repartition(tasks, columns[0]).distinct()


def fuzzy_join(
    tokens: DataFrame, terms: DataFrame, same_first_letter: bool = False, budgets: tuple[int, ...] = (0, 1, 2)
) -> DataFrame:
    """(token, term, distance) for each token's budget.

    `tokens` has (token, edits) with edits among `budgets`; `terms` has (term). Duplicates are removed first, so
    the size of a join key's group depends on the alphabet, not on how often a word occurs; callers with many
    repeated words pass them through distinct() to combine them before they are moved. Request keys are
    broadcast if counted to be few; otherwise both sides are sorted by key. The vocabulary's keys are never
    broadcast: exploding makes them far larger than the planner's estimate.
    """
    own_keys = " ".join(f"when {edits} then {deletions('token', edits)}" for edits in budgets)
    own_keys = f"if(length(token) > {LONG}, {token_parts('token')}, case edits {own_keys} end)"
    all_keys = ", ".join(
        [f"if(length(term) <= {LONG} + 2, {deletions('term', edits)}, {NO_HASHES})" for edits in budgets]
        + [f"if(length(term) > {LONG} - 2, {term_parts('term')}, {NO_HASHES})"]
    )
    left = settle(_distinct(tokens, "token", "edits").withColumn("_key", F.expr(f"explode({own_keys})")))
    right = _distinct(terms, "term").withColumn("_key", F.expr(f"explode(concat({all_keys}))"))
    close = "abs(length(token) - length(term)) <= edits"
    if same_first_letter:
        close += " and left(token, 1) = left(term, 1)"
    if left.count() <= FEW_KEYS:
        joined = right.join(F.broadcast(left), "_key")
    else:
        joined = left.join(right.hint("merge"), "_key")
    # max(edits) instead of distinct() keeps the costly check below from moving in front of the aggregate.
    proposed = joined.filter(close).groupBy("token", "term").agg(F.max("edits").alias("edits"))
    return (
        proposed.withColumn("distance", edit_distance_upto_2("token", "term"))
        .filter("distance <= edits")
        .select("token", "term", "distance")
    )
