"""Answering a table of autocomplete prefixes from a stored index of names: phrase prefix, then contains, then fuzzy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.operators import analysis, skew
from shelfmark.operators.fuzzy import edit_budget, fuzzy_join, similarity
from shelfmark.operators.products import distinct_names
from shelfmark.session import fresh_path, settle

# Rows shown, and terms a prefix or a token may stand for.
TOP = 10
EXPANSIONS = 20
SCORE_DIGITS = 6
GRAM = 3
#: Terms in a block of the dictionary: more than a prefix may stand for.
BLOCK = 256
#: Fields of the name index: folded words, words as they are, the longest n-grams; and all edge n-grams.
FOLDED, WORD, LONGEST = "folded", "word", "longest"
TABLES = {
    "entries": "term string, id string, tf long, dl int, name string, tokens array<string>, field string",
    "fields": "field string, n_docs long, avg_len double",
    "terms": "term string, df long, number long, block long, field string",
    "heads": "block long, term string",
    "grams": "term string, gram string",
    "pieces": "gram string, n long",
    "longest": "id string, name string, word int, edge int",
}


def clean(requests: DataFrame) -> DataFrame:
    """(prefix_id, prefix): trimmed, lower-cased, blanks dropped."""
    return requests.filter(~tx.is_blank(F.col("prefix"))).select(
        "prefix_id", F.lower(tx.java_trim(F.col("prefix"))).alias("prefix")
    )


def _best(hits: DataFrame) -> DataFrame:
    """The first ten rows per prefix: highest score, then name, then id."""
    rounded = hits.withColumn("score", F.round("score", SCORE_DIGITS))
    order = [F.desc("score"), F.col("name"), F.col("id")]
    return skew.top_k(rounded, ["prefix_id"], order, TOP, ["id"])


@dataclass(frozen=True)
class Names:
    """The stored index of product names that all stages read, written once by `build`.

    `entries` has the terms of every name by field: folded words, words as they are, the longest n-gram of every run, and
    all edge n-grams. `terms` is the ordered dictionary: each field's terms with their frequency, numbered in order and cut into
    blocks of BLOCK, so that the terms with a prefix are neighbours. `heads` has the first word of each block. `grams` lists the
    terms that hold a piece of one to three characters, `pieces` how many do. `longest` has the first names for each pair of lengths of a
    name's longest terms, which is all that a prefix of wildcards can ask for.
    """

    spark: SparkSession
    base: str

    @classmethod
    def build(cls, products: DataFrame, path: str | None = None) -> Names:
        spark = products.sparkSession
        index = cls(spark, path or fresh_path(spark, "names"))
        name = F.col("name")
        # An n-gram contains a text if and only if the longest n-gram of its run does.
        runs = F.transform(F.filter(tx.runs(name), lambda r: F.length(r) >= 2), lambda r: F.left(r, F.lit(20)))
        fields = {FOLDED: tx.folded_tokens(name), WORD: tx.standard_tokens(name), LONGEST: tx.fold_each(runs), analysis.EDGE: tx.edge_ngrams(name)}
        spread = [F.struct(F.lit(f).alias("field"), tokens.alias("tokens")) for f, tokens in fields.items()]
        tokens = products.select("id", "name", F.inline(F.array(*spread)))
        kept = F.when(F.col("field") == FOLDED, F.col("tokens")).alias("tokens")
        terms = F.explode("tokens").alias("term")
        counted = tokens.select("id", "name", "field", kept, F.size("tokens").alias("dl"), terms).groupBy("field", "term", "id")
        firsts = [F.first(c).alias(c) for c in ("dl", "name", "tokens")]
        index._write("entries", counted.agg(F.count("*").alias("tf"), *firsts).repartitionByRange("field", "term").sortWithinPartitions("term"), "field")
        index._write("fields", tokens.filter(F.size("tokens") > 0).groupBy("field").agg(F.count("*").alias("n_docs"), F.avg(F.size("tokens")).alias("avg_len")))

        entries = index.read("entries")
        stats = entries.groupBy("field", "term").agg(F.count("*").alias("df"))
        ranked = skew.distributed_rank(stats, ["field"], [F.col("term")], "number")
        index._write("terms", ranked.withColumn("block", F.floor((F.col("number") - 1) / BLOCK).cast("long")), "field")
        folded = index.terms(FOLDED)
        index._write("heads", folded.groupBy("block").agg(F.min("term").alias("term")))
        words = index.read("terms").filter(F.col("field").isin(WORD, LONGEST)).select("term").distinct()
        index._write("grams", words.select("term", F.explode(_grams_of(F.col("term"))).alias("gram")).repartitionByRange("gram", "term"))
        index._write("pieces", index.read("grams").groupBy("gram").agg(F.count("*").alias("n")))
        longest = [F.max(F.when(F.col("field") == f, F.length("term")).otherwise(0)).alias(c) for f, c in ((WORD, "word"), (LONGEST, "edge"))]
        lengths = entries.filter(F.col("field").isin(WORD, LONGEST)).groupBy("id").agg(F.first("name").alias("name"), *longest)
        index._write("longest", skew.top_k(lengths, ["word", "edge"], [F.col("name"), F.col("id")], TOP, ["id"], rank="_n").drop("_n"))
        return index

    def _write(self, table: str, rows: DataFrame, by: str | None = None) -> None:
        writer = rows.write.partitionBy(by) if by else rows.write
        writer.parquet(f"{self.base}/{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.base}/{table}")

    def entries(self, *fields: str) -> DataFrame:
        return self.read("entries").filter(F.col("field").isin(*fields))

    def terms(self, field: str) -> DataFrame:
        """(term, df, number, block) of a field."""
        return self.read("terms").filter(F.col("field") == field).drop("field")

    def weighted(self, field: str) -> DataFrame:
        """(term, avg_len, _idf) of a field."""
        own = self.read("fields").filter(F.col("field") == field)
        stats = _with_field(self.terms(field), own)
        return stats.select("term", "avg_len", analysis.idf(F.col("n_docs"), F.col("df")).alias("_idf"))

    def first_terms(self, prefixes: DataFrame) -> DataFrame:
        """(last, term): the alphabetically first words that start with each prefix `last`.

        Among the heads of the blocks in order, a prefix comes after the head of the block in which its words begin, or
        they begin with the next one; as a block is longer than the list, no other can have any that count."""
        asked = prefixes.select("last").distinct()
        marks = self.read("heads").select("term", F.lit(1).alias("heads")).unionByName(asked.select(F.col("last").alias("term"), F.lit(0).alias("heads")))
        ordered = marks.select(F.lit(0).alias("all"), "term", F.struct("term", -F.col("heads")).alias("at"), "heads", F.col("heads").alias("upto"))
        placed = skew.running(ordered, "all", F.col("at").asc(), ["upto"]).filter("heads = 0")
        block = F.greatest(F.col("upto") - 1, F.lit(0)).cast("long")
        blocks = placed.select(F.col("term").alias("last"), F.explode(F.array(block, block + 1)).alias("block")).distinct()
        near = self.terms(FOLDED).join(blocks, "block").filter(F.col("term").startswith(F.col("last"))).select("last", "term")
        return skew.top_k(near, ["last"], [F.col("term")], EXPANSIONS, ["term"], rank="_n").drop("_n")


def by_prefix(requests: DataFrame, names: Names) -> DataFrame:
    """Names holding the prefix's tokens in a row, the last one as the start of a word."""
    weighted = names.weighted(FOLDED)
    tokens = tx.folded_tokens(F.col("prefix"))
    asked = (
        requests.select("prefix_id", tokens.alias("wanted"))
        .filter(F.size("wanted") > 0)
        .withColumns(
            {
                "last": F.get("wanted", F.size("wanted") - 1),
                "lead": F.slice("wanted", F.lit(1), F.greatest(F.size("wanted") - 1, F.lit(0))),
            }
        )
    )
    lead_terms = asked.select("prefix_id", F.explode("lead").alias("term"))
    lead_idf = (
        lead_terms.join(weighted, "term").groupBy("prefix_id").agg(F.sum("_idf").alias("_lead_idf"))
    )
    expanded = (
        asked.select("prefix_id", "last", "lead")
        .join(names.first_terms(asked), "last")
        .join(weighted, "term")
        .join(lead_idf, "prefix_id", "left")
        .withColumn("_idf", F.col("_idf") + F.coalesce("_lead_idf", F.lit(0.0)))
        .select("prefix_id", "lead", "term", "_idf", "avg_len")
    )
    matched = skew.join(names.entries(FOLDED), expanded, ["term"])
    width = F.size("lead")
    starts = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size("tokens") - width, F.lit(1))),
        lambda i: (F.get("tokens", i + width - 1) == F.col("term"))
        & (F.slice("tokens", i, width) == F.col("lead")),
    )
    counted = matched.withColumn("tf", F.size(starts)).filter("tf > 0")
    weight = F.col("_idf") * analysis.term_weight(F.col("tf"), F.col("dl"), F.col("avg_len"))
    hits = counted.groupBy("prefix_id", "id").agg(F.first("name").alias("name"), F.sum(weight).alias("score"))
    return _best(hits)


def _with_field(stats: DataFrame, field: DataFrame) -> DataFrame:
    """Add the field's totals, one row in all, to every term."""
    totals = {name: field.select(name).scalar() for name in ("n_docs", "avg_len")}
    return stats.withColumns(totals)


def _pattern(text: Column) -> Column:
    """The prefix as a regular expression: * is any text, ? any character, the rest literal."""
    quoted = F.regexp_replace(text, r"([^\p{L}\p{N}_*?])", r"\\$1")
    return F.concat(F.lit(".*"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit(".*"))


def _grams_of_size(text: Column, size: int) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.filter(F.transform(at, lambda i: text.substr(i, F.lit(size))), lambda g: F.length(g) == size)


def _grams_of(text: Column) -> Column:
    """All substrings of one to three characters."""
    return F.array_distinct(F.concat(*[_grams_of_size(text, size) for size in range(1, GRAM + 1)]))


def by_contains(requests: DataFrame, names: Names) -> DataFrame:
    """Names with a single indexed term that contains the prefix; * and ? are wildcards.

    Terms are matched on the dictionary: an equi-join on the rarest piece of the prefix's literal stretches, then the
    prefix itself, as a pattern if it has wildcards. A prefix with a piece that no term holds has no answer. Word terms and n-gram terms
    are two fields; the score is the number of fields that match. Prefixes of wildcards alone ask for terms of a length.
    """
    stretches = F.filter(F.split("prefix", r"[*?]+"), lambda s: s != "")
    size = F.aggregate(stretches, F.lit(0), lambda n, s: F.greatest(n, F.least(F.length(s), F.lit(GRAM))))
    wild = F.col("prefix").rlike(r"[*?]")
    asked = requests.select("prefix_id", "prefix", stretches.alias("stretches"), size.alias("size"))
    pieces = F.flatten(F.transform("stretches", _grams_of))
    spread = asked.filter("size > 0").select("prefix", "size", F.explode(pieces).alias("gram")).filter(F.length("gram") == F.col("size"))
    known = skew.join(spread.distinct(), names.read("pieces"), ["gram"], "left")
    rarest = known.groupBy("prefix").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least"))
    patterns = settle(rarest.filter("least.n > 0").select("prefix", "least.gram"))
    met = skew.join(names.read("grams"), patterns, ["gram"])
    pattern = F.concat(F.lit("^(?s:"), _pattern(F.col("prefix")), F.lit(")$"))
    matching = met.filter(F.when(wild, F.rlike(F.col("term"), pattern)).otherwise(F.contains(F.col("term"), F.col("prefix"))))
    wanted = skew.join(asked.select("prefix_id", "prefix"), settle(matching.select("prefix", "term")), ["prefix"]).select("prefix_id", "term")
    found = skew.join(names.entries(WORD, LONGEST), wanted, ["term"])
    hits = found.groupBy("prefix_id", "id").agg(
        F.first("name").alias("name"), F.size(F.collect_set("field")).cast("double").alias("score")
    )
    return _best(hits.unionByName(_of_length(asked.filter("size = 0"), names)))


def _of_length(asked: DataFrame, names: Names) -> DataFrame:
    """Hits of prefixes of wildcards alone: a term with as many characters as there are question marks, and one at least."""
    marks = F.greatest(F.length(F.replace("prefix", F.lit("*"), F.lit(""))), F.lit(1))
    lengths = asked.select("prefix_id", marks.alias("length"))
    most = lengths.agg(F.max("length")).scalar()
    each = names.read("longest").withColumn("most", F.least(F.greatest("word", "edge"), F.coalesce(most, F.lit(0))))
    spread = each.filter("most > 0").select("id", "name", "word", "edge", F.explode(F.sequence(F.lit(1), F.col("most"))).alias("length"))
    score = sum(F.when(F.col(c) >= F.col("length"), 1.0).otherwise(0.0) for c in ("word", "edge"))
    return skew.join(spread, lengths, ["length"]).select("prefix_id", "id", "name", score.alias("score"))


def by_fuzzy(requests: DataFrame, names: Names) -> DataFrame:
    """Names with an n-gram near any token of the prefix; at most 20 n-grams per token."""
    asked = requests.select(
        "prefix_id", F.explode(F.array_distinct(tx.folded_tokens(F.col("prefix")))).alias("token")
    )
    tokens = asked.select("token", edit_budget(F.col("token")).alias("edits"))
    near = fuzzy_join(tokens, names.terms(analysis.EDGE)).withColumn(
        "similarity", similarity(F.col("distance"), F.col("token"), F.col("term"))
    )
    order = [F.desc("similarity"), F.col("term")]
    kept = skew.top_k(near, ["token"], order, EXPANSIONS, ["term"], rank="_n").select("token", "term", "similarity")
    # Written down, so that a token or term which many prefixes have is split when they are dealt out by it.
    weights = settle(kept.join(names.weighted(analysis.EDGE), "term"))
    expanded = skew.join(asked, weights, ["token"]).drop("token")
    matched = skew.join(names.entries(analysis.EDGE), settle(expanded), ["term"])
    weight = F.col("similarity") * F.col("_idf") * analysis.term_weight(F.col("tf"), F.col("dl"), F.col("avg_len"))
    hits = matched.groupBy("prefix_id", "id").agg(F.first("name").alias("name"), F.sum(weight).alias("score"))
    return _best(hits)


def cascade(requests: DataFrame, products: DataFrame, names: Names | None = None) -> DataFrame:
    """(prefix_id, position, name, stage): the first stage that answers, as distinct names. Without an index one is built."""
    names = names or Names.build(products)
    waiting = clean(requests)
    answers = None
    for stage, answer in enumerate((by_prefix, by_contains, by_fuzzy), start=1):
        found = settle(answer(waiting, names).withColumn("stage", F.lit(stage)))
        answers = found if answers is None else answers.unionByName(found)
        waiting = waiting.join(found.select("prefix_id").distinct(), "prefix_id", "left_anti")
    stages = answers.select("prefix_id", "stage").distinct()
    names = distinct_names(answers, "prefix_id", TOP)
    return names.join(stages, "prefix_id").select("prefix_id", "position", "name", "stage")
