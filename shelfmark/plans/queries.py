"""Every operator as a named query over the test tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas as S
from shelfmark.functions import messages as msg
from shelfmark.functions import text as tx
from shelfmark.operators import (
    analysis,
    changes,
    fuzzy,
    lifecycle,
    products,
    queues,
    search,
    spelling,
    suggest,
    uniqueness,
    validation,
)
from shelfmark.plans import requests
from shelfmark.session import fresh_path, settle
from shelfmark.sources import events, segments, versions, views
from shelfmark.streaming import apply as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.datetime(2024, 1, 31)
AS_OF_NTZ = "timestamp_ntz'2024-01-31 00:00:00'"
REINDEXED_VERSION = 12


def plain(df: DataFrame) -> DataFrame:
    """Columns in types both engines print alike: decimals as double, ints as bigint, arrays as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "|")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(function(spark, sf_dir))
        return function

    return register


# --- sources and sinks ------------------------------------------------------------------------------------


@query("list_products")
def _(spark, sf):
    return views.products(spark, sf).select("id", "name", "description", "price")


@query("lookup_products")
def _(spark, sf):
    return products.lookup(views.lookup_requests(spark, sf), views.products(spark, sf))


@query("seed_if_empty")
def _(spark, sf):
    """A seed file into an empty table and into one that has rows."""
    path = fresh_path(spark, "seed")
    rows = views.products(spark, sf).withColumn("key", F.col("id").cast("bigint"))
    rows.orderBy("key").select("name", "description", "price").write.json(path)
    seed = settle(events.read_seed(spark, path, lines=True))
    empty = products.seed_if_empty(seed, spark.createDataFrame([], S.PRODUCT))
    full = products.seed_if_empty(seed, views.products(spark, sf))
    found = []
    for target, (inserted, created, rejected) in (("empty", empty), ("full", full)):
        added = inserted.select("id", "price").join(created.select("id", "queue", "payload"), "id")
        refused = rejected.select(F.col("holder").alias("id"), "price")
        found.append(added.unionByName(refused, allowMissingColumns=True).withColumn("target", F.lit(target)))
    return found[0].unionByName(found[1])


@query("encode_events")
def _(spark, sf):
    return events.encode(views.changes(spark, sf)).select("seq_id", "queue", "routing_key", "payload")


@query("decode_events")
def _(spark, sf):
    decoded = events.decode(views.messages(spark, sf))
    return decoded.select("seq_id", "op", "error", "id", "name", "description", "price")


@query("write_catalog")
def _(spark, sf):
    store = versions.CatalogVersions(spark, fresh_path(spark, "catalog"))
    store.write(_documents(spark, sf))
    return store.read().select("id", "name", "price", "nameSpellClean", "uniqueKey", "updatedAt")


# --- validation, projections, filters ---------------------------------------------------------------------


def _validated(spark, sf):
    return validation.validate(views.requests(spark, sf))


@query("validate_products")
def _(spark, sf):
    messages = F.transform("errors", lambda e: F.concat_ws("=", e["field"], e["message"]))
    return _validated(spark, sf).select("row_id", F.size("errors").alias("n_errors"), messages.alias("errors"))


@query("valid_products")
def _(spark, sf):
    return validation.accepted(_validated(spark, sf))


@query("rejected_products")
def _(spark, sf):
    return validation.rejected(_validated(spark, sf))


@query("clean_name")
def _(spark, sf):
    lines = views.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.posexplode(F.split("text", "\n")).alias("line", "name")
    )
    return lines.select("id", "line", tx.clean_name(F.col("name")).alias("cleaned"))


@query("unique_key")
def _(spark, sf):
    items = views.products(spark, sf)
    return items.select("id", tx.unique_key(F.col("name"), F.col("description")).alias("unique_key"))


@query("normalized_key")
def _(spark, sf):
    rows = views.table(spark, sf, "documents")
    return rows.select("doc_id", tx.normalized_key(F.col("lang"), F.col("text")).alias("normalized_key"))


def _documents(spark, sf):
    return products.documents(views.products(spark, sf), F.expr(AS_OF_NTZ))


@query("product_document")
def _(spark, sf):
    return _documents(spark, sf)


@query("main_term")
def _(spark, sf):
    lines = views.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.posexplode(F.split("text", "\n")).alias("line", "name")
    )
    return lines.select("id", "line", tx.main_term(F.col("name")).alias("term"))


@query("price_filter")
def _(spark, sf):
    part = products.price_filter(views.table(spark, sf, "part"), 905.0, 950.0, "p_retailprice")
    return part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_retailprice").alias("price"))


@query("match_highlight")
def _(spark, sf):
    rows = views.table(spark, sf, "documents")
    return rows.select("doc_id", tx.mark_first(F.col("text"), F.lit("En")).alias("marked"))


@query("tidy_message")
def _(spark, sf):
    rows = views.queue_table(spark, sf)
    return rows.select("seq_id", msg.tidy_message(F.col("payload")).alias("message"))


@query("normalize_message")
def _(spark, sf):
    rows = views.queue_table(spark, sf)
    return rows.select("seq_id", msg.normalize_message(F.col("payload")).alias("message"))


# --- uniqueness -------------------------------------------------------------------------------------------


@query("duplicate_creates")
def _(spark, sf):
    batch = views.product_changes(spark, sf).select("seq_id", "id", "name", "description")
    existing = _folded(spark, sf).select("id", "name", "description")
    return products.duplicate_creates(batch, existing).select("seq_id", "id", "holder")


@query("duplicate_updates")
def _(spark, sf):
    judged = products.duplicate_updates(views.update_requests(spark, sf), views.products(spark, sf))
    return judged.select("seq_id", "id", "found", "duplicate")


@query("dedupe_by_id")
def _(spark, sf):
    feed = views.changes(spark, sf).filter(F.col("op") == S.CREATED)
    kept = products.dedupe_by_id(feed, _folded(spark, sf), ["seq_ts", "seq_id"])
    return kept.select("id", "seq_id", "description", "price")


def _keyed(batch):
    return batch.withColumn("normalizedKey", tx.normalized_key(F.col("name"), F.col("description")))


@query("dedupe_by_key")
def _(spark, sf):
    batch = _keyed(views.product_changes(spark, sf))
    kept = products.dedupe_by_key(batch, _keyed(_folded(spark, sf)), ["seq_id"])
    return kept.select("id", "seq_id", "normalizedKey", "price")


@query("distinct_names_topk")
def _(spark, sf):
    """Ranked rows are the products of each brand, cheapest first."""
    part = views.table(spark, sf, "part").select(
        F.col("p_brand").alias("brand"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), "p_retailprice"
    )
    ranked = products.skew.top_k(part, ["brand"], [F.col("p_retailprice"), F.col("key")], 10, ["key"])
    return products.distinct_names(ranked, "brand")


# --- change feed ------------------------------------------------------------------------------------------


def _folded(spark, sf):
    return changes.fold(views.changes(spark, sf))


@query("apply_created")
def _(spark, sf):
    done = uniqueness.apply_created(views.product_changes(spark, sf), settle(_folded(spark, sf)))
    return done.select("seq_id", "id", "outcome")


@query("apply_updated")
def _(spark, sf):
    return changes.apply_updated(views.product_changes(spark, sf, S.UPDATED), _folded(spark, sf))


@query("apply_deleted")
def _(spark, sf):
    return changes.apply_deleted(views.changes(spark, sf), views.products(spark, sf))


@query("fold_changes")
def _(spark, sf):
    return products.search_columns(_folded(spark, sf))


@query("fold_changes_unique")
def _(spark, sf):
    """A feed in which products share names, so creates compete for keys."""
    return uniqueness.fold_unique(views.shared_name_changes(spark, sf))


@query("apply_outcomes_unique")
def _(spark, sf):
    found = changes.outcomes(uniqueness.annotate_unique(views.shared_name_changes(spark, sf)))
    return found.groupBy("op", "outcome").agg(F.count("*").alias("n"))


@query("price_changed_at")
def _(spark, sf):
    return _folded(spark, sf).select("id", "priceChangedAt")


@query("versioned_update")
def _(spark, sf):
    judged = changes.versioned_update(views.versioned_updates(spark, sf))
    lost = queues.retry_or_dead(judged.filter(~F.col("won")), F.col("seq_ts"))
    won = judged.filter("won").withColumns(
        {
            "queue": F.lit(None).cast("string"),
            "available_at": F.lit(None).cast("timestamp_ntz"),
            "dead_at": F.lit(None).cast("timestamp_ntz"),
        }
    )
    return won.unionByName(lost).select(
        "seq_id", "id", "expected_version", "won", "queue", "retry_count", "available_at", "dead_at"
    )


@query("apply_outcomes")
def _(spark, sf):
    return changes.outcomes(changes.annotate(views.changes(spark, sf)))


@query("apply_outcome_counts")
def _(spark, sf):
    found = changes.outcomes(changes.annotate(views.changes(spark, sf)))
    return found.groupBy("outcome").agg(F.count("*").alias("n"))


# --- text analysis ----------------------------------------------------------------------------------------


@query("standard_tokens")
def _(spark, sf):
    tokens = tx.standard_tokens(F.col("text"))
    return views.docs(spark, sf).select("id", tokens.alias("tokens"))


@query("folded_tokens")
def _(spark, sf):
    return views.docs(spark, sf).select("id", tx.folded_tokens(F.col("text")).alias("tokens"))


@query("edge_ngrams")
def _(spark, sf):
    grams = F.posexplode(tx.edge_ngrams(F.col("name"))).alias("position", "gram")
    return views.products(spark, sf).select("id", grams)


@query("document_edge_ngrams")
def _(spark, sf):
    grams = F.explode(tx.edge_ngrams(F.col("text"))).alias("gram")
    return views.docs(spark, sf).select(grams).groupBy("gram").agg(F.count("*").alias("n"))


def _document_fields(spark, sf):
    return analysis.field_tokens(views.docs(spark, sf), {"text": tx.standard_tokens(F.col("text"))})


@query("postings")
def _(spark, sf):
    return analysis.postings(analysis.standard_fields(views.products(spark, sf)))


@query("document_postings")
def _(spark, sf):
    return analysis.postings(_document_fields(spark, sf))


def _stats(tokens):
    stats = analysis.term_stats(analysis.term_frequencies(tokens))
    return stats.join(F.broadcast(analysis.field_stats(tokens)), "field").withColumn(
        "avg_len", F.round("avg_len", 6)
    )


@query("term_stats")
def _(spark, sf):
    return _stats(analysis.standard_fields(views.products(spark, sf)))


@query("document_term_stats")
def _(spark, sf):
    return _stats(_document_fields(spark, sf))


@query("keyword_terms")
def _(spark, sf):
    return views.products(spark, sf).groupBy(F.col("name").alias("term")).agg(F.count("*").alias("df"))


@query("fuzzy_vocab_join")
def _(spark, sf):
    """Words of the benchmark passages against the vocabulary of all documents."""
    passages = views.table(spark, sf, "benchmark")
    token = F.explode(tx.folded_tokens(F.col("text"))).alias("token")
    tokens = passages.select(token).withColumn("edits", fuzzy.edit_budget(F.col("token")))
    terms = views.docs(spark, sf).select(F.explode(tx.folded_tokens(F.col("text"))).alias("term"))
    return fuzzy.fuzzy_join(tokens.distinct(), terms.distinct())


# --- search -----------------------------------------------------------------------------------------------


_indexes: dict = {}


def _stored_once(spark, sf, build):
    """An index of the products, written once in an application as long as no file changes."""
    items = _documents(spark, sf)
    location, fs = versions.hadoop_path(spark, f"{sf}/part.parquet")
    status = fs.getFileStatus(location)
    key = (build, spark.sparkContext.applicationId, sf, status.getModificationTime(), status.getLen(), *sorted(items.inputFiles()))
    if key not in _indexes:
        _indexes[key] = build(items)
    return _indexes[key]


def _indexed(spark, sf):
    """The products as search documents and their stored index."""
    return _documents(spark, sf), _stored_once(spark, sf, segments.build)


def _search_parts(spark, sf, fuzzy_terms):
    items, index = _indexed(spark, sf)
    prepared = search.prepare(requests.searches(spark))
    specs = settle(search.specs(prepared))
    expanded = settle(search.expand(specs, index.terms(), fuzzy_terms))
    return items, prepared, specs, index, expanded


def _per_request(prepared, specs, rows):
    """Rows of a spec for every request that belongs to it."""
    members = prepared.join(specs.select("spec_key", "spec_id"), "spec_key").select("query_id", "spec_id")
    return search.skew.join(rows, members, ["spec_id"]).drop("spec_id")


@query("search_all")
def _(spark, sf):
    """Requests without text or bounds: every product."""
    items = views.products(spark, sf)
    open_bounds = "min_price is null and max_price is null"
    prepared = search.prepare(requests.searches(spark).filter(open_bounds)).filter("match_all")
    specs = search.specs(prepared)
    found = _per_request(prepared, specs, search.listing_hits(specs, items))
    return found.select("query_id", "id", "sorts.name", "sorts.price")


def _text_hits(spark, sf, fuzzy_terms):
    _, prepared, specs, index, expanded = _search_parts(spark, sf, fuzzy_terms)
    return _per_request(prepared, specs, search.text_hits(expanded, index)).select("query_id", "id")


@query("search_exact")
def _(spark, sf):
    return _text_hits(spark, sf, False)


@query("search_fuzzy")
def _(spark, sf):
    return _text_hits(spark, sf, True)


@query("search_scored")
def _(spark, sf):
    _, prepared, specs, index, expanded = _search_parts(spark, sf, True)
    scored = search.scores(expanded, index)
    return _per_request(prepared, specs, scored).select("query_id", "id", F.round("score", 4).alias("score"))


@query("search_sorted_page")
def _(spark, sf):
    items, index = _indexed(spark, sf)
    asked = search.Search(requests.searches(spark), items, corrected=False, index=index)
    return asked.pages().select("query_id", "rank", "id", "total_hits", "total_pages")


@query("search_highlight")
def _(spark, sf):
    """Every text hit with its matched words marked."""
    items, prepared, specs, index, expanded = _search_parts(spark, sf, True)
    found = search.text_matches(expanded, index).groupBy("spec_id", "id").agg(F.collect_set("term").alias("terms"))
    rows = search.skew.join(found, items, ["id"]).select(
        "spec_id",
        "id",
        tx.highlight(F.col("name"), F.col("terms")).alias("name"),
        tx.highlight(F.col("description"), F.col("terms")).alias("description"),
    )
    return _per_request(prepared, specs, rows)


@query("spell_suggest")
def _(spark, sf):
    words = spelling.vocabulary(views.products(spark, sf))
    asked = requests.searches(spark).filter(~tx.is_blank(F.col("query")))
    return spelling.suggest(asked, words)


@query("correct_query")
def _(spark, sf):
    words = spelling.vocabulary(views.products(spark, sf))
    return spelling.correct(requests.searches(spark), words).select("query_id", "query", "corrected", "suggestions")


@query("vocabulary_suggest")
def _(spark, sf):
    return spelling.catalog_vocabulary(views.products(spark, sf))


@query("final_suggestions")
def _(spark, sf):
    items, index = _indexed(spark, sf)
    return search.Search(requests.searches(spark), items, index=index).summary()


@query("catalog_search")
def catalog_search(spark, sf):
    items, index = _indexed(spark, sf)
    return search.Search(requests.searches(spark), items, index=index).rows()


# --- autocomplete -----------------------------------------------------------------------------------------


def _stage(answer):
    def run(spark, sf):
        asked = suggest.clean(requests.prefixes(spark))
        return answer(asked, _stored_once(spark, sf, suggest.Names.build)).select("prefix_id", "rank", "id", "name", "score")

    return run


query("suggest_prefix")(_stage(suggest.by_prefix))
query("suggest_contains")(_stage(suggest.by_contains))
query("suggest_fuzzy")(_stage(suggest.by_fuzzy))


@query("suggest_cascade")
def _(spark, sf):
    names = _stored_once(spark, sf, suggest.Names.build)
    return suggest.cascade(requests.prefixes(spark), views.products(spark, sf), names)


# --- queues and streaming ---------------------------------------------------------------------------------


@query("route_events")
def _(spark, sf):
    return queues.route(views.messages(spark, sf)).select("seq_id", "op", "queue", "routing_key")


@query("retry_or_dead")
def _(spark, sf):
    failed = events.decode(views.messages(spark, sf)).filter(F.col("error").isNotNull())
    sent = queues.retry_or_dead(failed, F.col("seq_ts"))
    return sent.select("seq_id", "error", "queue", "retry_count", "available_at", "dead_at")


@query("due_retries")
def _(spark, sf):
    as_of = F.expr("timestamp_ntz'2024-01-15 00:00:00'")
    due = queues.due_retries(views.queue_table(spark, sf), as_of)
    return due.select("seq_id", "queue", "payload", "retry_count")


@query("expire_dead")
def _(spark, sf):
    kept = queues.expire_dead(views.queue_table(spark, sf), F.expr(AS_OF_NTZ))
    return kept.select("seq_id", "queue", "dead_at")


@query("reprocess_dead")
def _(spark, sf):
    again = queues.reprocess_dead(views.queue_table(spark, sf))
    return again.select("seq_id", "op", "queue", "routing_key", "payload")


@query("queue_status")
def _(spark, sf):
    return queues.status(views.queue_table(spark, sf))


@query("queue_peek")
def _(spark, sf):
    return queues.peek(views.queue_table(spark, sf))


@query("stream_apply")
def _(spark, sf):
    feed = events.encode(views.changes(spark, sf)).withColumn("retry_count", F.lit(0))
    base = fresh_path(spark, "stream")
    stream.write_feed(feed, f"{base}/feed")
    runner = stream.StreamApply(spark, f"{base}/catalog")
    runner.run(f"{base}/feed", f"{base}/progress")
    return runner.catalog().select("id", "name", "description", "price", "updatedAt", "priceChangedAt")


STREAMED_PARTS = 5
INDEXED_PARTS = 2


@query("stream_search")
def _(spark, sf):
    """The feed comes in as two micro-batches, each of which keeps the search index in step; then requests are answered from it."""
    feed = events.encode(views.changes(spark, sf)).withColumn("retry_count", F.lit(0))
    total = views.table(spark, sf, "events").count()
    runner = stream.StreamApply(spark, fresh_path(spark, "stream"), indexed=True)
    for i in range(INDEXED_PARTS):
        runner.apply(feed.filter(F.floor(F.col("seq_id") * INDEXED_PARTS / total) == i), i)
    documents, index = runner.searchable()
    return search.Search(requests.feed_searches(spark), documents, index=index).rows()


@query("stream_queue")
def _(spark, sf):
    """The queue after the messages have come in as five micro-batches: failures are retried, then dead."""
    messages = views.messages(spark, sf).withColumn("retry_count", F.lit(0))
    total = views.table(spark, sf, "events").count()
    base = fresh_path(spark, "stream")
    runner = stream.StreamApply(spark, f"{base}/catalog")
    for i in range(STREAMED_PARTS):
        runner.apply(messages.filter(F.floor(F.col("seq_id") * STREAMED_PARTS / total) == i), i)
    return runner.queue().select("seq_id", "op", "error", "queue", "retry_count", "available_at", "dead_at")


# --- versions and history ---------------------------------------------------------------------------------


def _stored(spark, sf, *numbers):
    """Versions of the history written as a catalog of versions."""
    history = views.history(spark, sf)
    store = versions.CatalogVersions(spark, fresh_path(spark, "versions"))
    for number in numbers:
        store.write(history.filter(F.col("version") == number).drop("version"), number)
    return store


@query("reindex_catalog")
def _(spark, sf):
    store = _stored(spark, sf, REINDEXED_VERSION - 1, REINDEXED_VERSION)
    number = store.reindex(lambda documents: products.search_columns(documents).drop("normalizedKey"))
    return store.read().withColumn("version", F.lit(number))


@query("snapshot_catalog")
def _(spark, sf):
    items = views.products(spark, sf)
    taken = lifecycle.snapshot(items, AS_OF)
    store = versions.CatalogVersions(spark, fresh_path(spark, "versions"), taken.schema)
    return store.read_snapshot(store.snapshot(taken, AS_OF))


@query("retain_versions")
def _(spark, sf):
    return lifecycle.retain_versions(views.history(spark, sf))


@query("retain_days")
def _(spark, sf):
    return lifecycle.retain_days(views.history(spark, sf), F.expr(AS_OF_NTZ))


@query("restore_version")
def _(spark, sf):
    """An older version made current again over a newer one; its data tables."""
    store = _stored(spark, sf, REINDEXED_VERSION, REINDEXED_VERSION + 1)
    store.restore(REINDEXED_VERSION)
    restored = store.read().withColumn("version", F.lit(REINDEXED_VERSION))
    return lifecycle.restore(restored, REINDEXED_VERSION)
