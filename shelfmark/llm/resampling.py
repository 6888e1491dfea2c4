"""Quality classifier by importance resampling: documents are drawn by how much more likely a target model finds them than a
model of the raw corpus, both bags of hashed n-grams.

The target model counts labelled clean documents, the raw model all documents. A document's weight is its mean log ratio
per n-gram, taken relative to a threshold learnt from labels; Gumbel noise is added, and the k documents with the greatest sums
are drawn, which samples without replacement in proportion to the weights. k is how many weights pass the threshold.

Labelled toxic and low-quality documents have target models of their own: the log ratios of the tokens that stand out in them
against labelled clean documents. Their sums per document and in its worst window are cut between held-out labels of
either kind; what lies above a cut takes no part in the draw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors, texts
from shelfmark.session import settle

BUCKETS = 1 << 14
#: Labelled documents that are used, at most: half for the target model, as many again for the threshold.
LABELLED = 100_000
#: Share of the labelled clean documents that may fall below the threshold, and the distance kept from them.
LOST = 0.001
MARGIN = 0.06
#: N-grams of weight 0 added to every document, as a few say little.
PRIOR = 10
#: Log ratios per n-gram that weigh like one unit of Gumbel noise.
TEMPERATURE = 0.004
SEED = 17
#: Labels that a bad kind and the clean one must have, and share of the clean held-out ones that each of its cuts may lose.
LEAST = 20
LOST_HELD = 0.002
#: A token stands out in labelled bad documents: in so many of them, so many standard deviations above clean ones.
OFTEN = 3
DEVIATIONS = 6.0
#: Tokens that are summed in a window.
WINDOW = 64
KINDS = ("toxic", "junk")
STEP = 1 << 19
BASE = 0x9E3779B97F4A7C15


@cache
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """Each byte lower-cased, and its class: white space, word, other."""
    lower, kind = np.arange(256, dtype=np.uint64) + np.uint64(1), np.full(256, 2, np.int8)
    lower[65:91] += np.uint64(32)
    kind[0x80:] = 1
    for b in range(0x80):
        if chr(b).isalnum() or b == 0x5F:
            kind[b] = 1
    kind[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    return lower, kind


@cache
def _powers(n: int) -> np.ndarray:
    out = np.ones((2, n), np.uint64)
    out[0, 1:] = BASE
    out[1, 1:] = pow(BASE, -1, 1 << 64)
    return np.multiply.accumulate(out, 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of runs of word or of other bytes."""
    lower, kind = _bytes()
    classes = kind[data]
    edge = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]][: len(data)])
    ends = np.r_[edge[1:], len(data)] if len(data) else edge
    some = classes[edge] > 0
    starts, ends = edge[some], ends[some]
    ahead, back = _powers(1 << max(10, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(lower[data] * ahead[: len(data)], out=sums[1:])
    return starts, _mix((sums[ends] - sums[starts]) * back[starts])


def ngrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the single tokens and of the pairs; pair i begins with token i of the first array."""
    return _ngrams(_tokens(data)[1])


def _ngrams(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BUCKETS - 1)
    pairs = _mix(hashes[:-1] * np.uint64(BASE) + hashes[1:])
    return (hashes & mask).astype(np.int64), (pairs & mask).astype(np.int64)


def _pieces(bodies: list[bytes | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Texts in turn; a very long one in pieces that end at white space where there is some."""
    for i, body in enumerate(bodies):
        body, at = body or b"", 0
        while at == 0 or at < len(body):
            end = min(len(body), at + STEP)
            if end < len(body):
                cut = max(body.rfind(c, at, end) for c in (b" ", b"\n"))
                end = cut + 1 if cut > at else end
            yield i, np.frombuffer(body, np.uint8)[at:end]
            at = max(end, 1)


def _counts(chosen: np.ndarray):
    """Per task: how often each bucket occurs in all texts (raw) and in the chosen ones (target)."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            known = np.isin(ids.fill_null(0).to_numpy(), chosen) & ~ids.is_null().to_numpy(zero_copy_only=False)
            for i, data in _pieces(texts(batch)):
                found = sum(np.bincount(x, minlength=BUCKETS) for x in ngrams(data))
                counts[0] += found
                if known[i]:
                    counts[1] += found
        kind, bucket = np.nonzero(counts)
        arrays = [pa.array(kind.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[kind, bucket])]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "bucket", "n"])

    return run


def _frequencies(batches: Batches) -> Batches:
    """Rows of (kind, text): in how many texts of a kind each token occurs, counted per batch."""
    for batch in batches:
        kinds, found = batch.column("kind").to_pylist(), {}
        for kind, body in zip(kinds, texts(batch)):
            tokens = [np.unique(_tokens(data)[1]) for _, data in _pieces([body])]
            found.setdefault(kind, []).append(np.unique(np.concatenate(tokens)))
        for kind, tokens in found.items():
            token, n = np.unique(np.concatenate(tokens), return_counts=True)
            arrays = [pa.array([kind] * len(token), pa.string()), pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "token", "n"])


@dataclass(frozen=True)
class Marks:
    """Tokens that stand out in labelled documents of a bad kind, sorted, and their log ratios against clean ones."""

    tokens: np.ndarray
    ratio: np.ndarray

    def score(self, hashes: np.ndarray) -> tuple[float, float]:
        """Sum of all tokens and of the worst window."""
        if not len(self.tokens):
            return 0.0, 0.0
        at = np.flatnonzero(self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.tokens, hashes[at]), len(self.tokens) - 1)
        known = self.tokens[place] == hashes[at]
        at, sums = at[known], np.r_[0.0, np.cumsum(self.ratio[place[known]])]
        if not len(at):
            return 0.0, 0.0
        return sums[-1], (sums[np.searchsorted(at, at + WINDOW)] - sums[:-1]).max()

    @cached_property
    def seen(self) -> np.ndarray:
        out = np.zeros(1 << 16, bool)
        out[(self.tokens & np.uint64(0xFFFF)).astype(np.int64)] = True
        return out


def _weighed(ratio: np.ndarray, marks: list[Marks]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            weight, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            sums, tokens = np.zeros((2 * len(marks), batch.num_rows)), np.zeros(batch.num_rows)
            for i, data in _pieces(texts(batch)):
                hashes = _tokens(data)[1]
                tokens[i] += len(hashes)
                for found in _ngrams(hashes):
                    weight[i] += ratio[found].sum()
                    n[i] += len(found)
                for k, mark in enumerate(marks):
                    whole, window = mark.score(hashes)
                    sums[2 * k, i] += whole
                    sums[2 * k + 1, i] = max(sums[2 * k + 1, i], window)
            sums[::2] /= tokens + PRIOR
            arrays = [*batch.columns, pa.array(n), pa.array(weight), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "n_ngrams", "log_weight", *BAD])

    return run


#: Per bad kind, the mean per token and the sum of the worst window.
BAD = [f"_{kind}_{part}" for kind in KINDS for part in ("mean", "window")]


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket, the least mean weight that passes, the least sum of margin and noise that is drawn,
    and of the bad kinds their tokens and the greatest of each of BAD that passes."""

    ratio: np.ndarray
    threshold: float
    cut: float
    marks: list[Marks]
    most: list[float]


def _log_ratio(counted: DataFrame) -> np.ndarray:
    counts = np.zeros((2, BUCKETS))
    for r in counted.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.kind, r.bucket] = r.n
    if not counts[1].any():
        return np.zeros(BUCKETS)
    raw, target = np.log((counts + 1) / (counts + 1).sum(1, keepdims=True))
    return target - raw


def _marks(rows: DataFrame, used: DataFrame) -> list[Marks]:
    """The models of the bad kinds from rows of `used` (doc_id, kind), in which clean ones are of kind "clean"."""
    labelled = rows.join(F.broadcast(used), "doc_id").select("kind", "text")
    size = {r.kind: r.n for r in labelled.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    counted = on_executors(labelled, _frequencies, "kind string, token long, n long")
    counted = settle(counted.groupBy("token").pivot("kind", ["clean", *KINDS]).agg(F.sum("n")).fillna(0))
    out = []
    for kind in KINDS:
        bad, clean = size.get(kind, 0), size.get("clean", 0)
        share = (F.col("clean") + 0.5) / F.lit(clean + 1.0)
        stands_out = (F.col(kind) - F.lit(bad) * share) / F.sqrt(F.lit(bad) * share)
        found = counted.filter(F.col(kind) >= OFTEN).withColumn("out", stands_out).filter(F.col("out") >= DEVIATIONS)
        ratio = F.log((F.col(kind) + 0.5) / F.lit(bad + 1.0) / share).alias("ratio")
        # At most the tokens that OFTEN of the labelled documents share, whose number is bounded.
        some = found.select("token", ratio).collect() if bad and clean else []
        tokens = np.array([r.token for r in some], np.int64).view(np.uint64)
        order = np.argsort(tokens)
        out.append(Marks(tokens[order], np.array([r.ratio for r in some])[order]))
    return out


def _between(clean: np.ndarray, bad: np.ndarray) -> float:
    """A cut above all but LOST_HELD of the clean values and half-way to the next bad one; infinite if there is none."""
    if not len(clean) or not len(bad):
        return float("inf")
    most = np.sort(clean)[len(clean) - 1 - int(LOST_HELD * len(clean))]
    above = bad[bad > most]
    return float((most + above.min()) / 2) if len(above) else float("inf")


def _scored(rows: DataFrame, ratio: np.ndarray, marks: list[Marks]) -> DataFrame:
    fields = [*rows.schema.fields, T.StructField("n_ngrams", T.LongType())]
    fields += [T.StructField(n, T.DoubleType()) for n in ("log_weight", *BAD)]
    return on_executors(rows, _weighed(ratio, marks), T.StructType(fields))


def _not_bad(most: list[float]) -> Column:
    out = F.lit(True)
    for name, limit in zip(BAD, most):
        out = out & (F.col(name) <= F.lit(limit))
    return out


def _mean() -> Column:
    return F.col("log_weight") / (F.col("n_ngrams") + F.lit(PRIOR))


def _drawn_at(threshold: float) -> Column:
    """Margin over the threshold plus Gumbel noise, which depends on doc_id alone."""
    place = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(SEED)), 12).cast("double")
    noise = -F.log(-F.log((place + 0.5) / F.lit(2.0**52)))
    return (F.col("mean_weight") - F.lit(threshold)) / F.lit(TEMPERATURE) + noise


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th greatest value, found by counting in bins that get finer around it: no sort, bounded counts to the driver."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / bins
        bin_of = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
        inside = values.filter(F.col(column).between(low, high))
        counts = inside.groupBy(bin_of.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for r in sorted(counts.collect(), key=lambda r: -r.bin):
            if above + r.n >= k:
                if (low, high) == (r.low, r.high):
                    return low
                low, high = r.low, r.high
                break
            above += r.n
    return low


def _chosen(labels: DataFrame, labelled: int) -> dict[str, np.ndarray]:
    """Sorted ids per kind, at most `labelled` of each by a hash. Toxic is what any label calls so; of the rest junk is
    what any calls low quality, and clean what all call good."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    toxic, quality = F.max(F.coalesce("toxic", F.lit(0))), F.min("quality")
    kind = F.when(toxic != 0, F.lit("toxic")).when(quality == 0, F.lit("junk")).when(quality == 1, F.lit("clean"))
    known = settle(known.agg(kind.alias("kind")).withColumn("place", F.xxhash64("doc_id")))
    counts = dict(known.groupBy("kind").agg(F.count("*")).collect())
    out = {}
    for name in ("clean", *KINDS):
        some = known.filter(F.col("kind") == name)
        if counts.get(name, 0) > 2 * labelled:
            # Below this place lie about twice as many as wanted, so only these meet in one task.
            few = some.filter(F.col("place") < ((1 << 64) * 2 * labelled // counts[name]) - (1 << 63))
            some = few if few.count() >= labelled else some
        some = some.orderBy("place", "doc_id").limit(labelled)
        out[name] = np.sort(np.array([r.doc_id for r in some.select("doc_id").collect()], np.int64))
    return out


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[Model, DataFrame]:
    """The model, and the weights of all rows: doc_id, n_ngrams, log_weight, the columns BAD, mean_weight.

    Labels of a kind beyond `labelled` rows are not used; which ones is decided by a hash of doc_id. All else covers
    every row. A bad kind with fewer than LEAST labels among the rows, or beside fewer clean ones, has no cut.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = _chosen(labels, labelled)
    chosen = kinds["clean"]
    # Every second one trains the models. All clean ones set the threshold; the others set the cuts.
    ratio = _log_ratio(on_executors(rows, _counts(chosen[::2]), "kind int, bucket int, n long"))
    enough = [k for k in KINDS if min(len(kinds[k]), len(chosen)) >= LEAST]
    used = [(int(i), k) for k in ("clean", *enough) for i in kinds[k][::2]] if enough else []
    marks = [Marks(np.zeros(0, np.uint64), np.zeros(0)) for _ in KINDS]
    if used:
        marks = _marks(rows, spark.createDataFrame(used, "doc_id long, kind string"))
    scores = settle(_scored(rows, ratio, marks).drop("text").withColumn("mean_weight", _mean()))
    ids = [(int(i), k, j % 2 == 1) for k in ("clean", *enough) for j, i in enumerate(kinds[k])]
    ids = spark.createDataFrame(ids, "doc_id long, kind string, held boolean")
    known = scores.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "kind", "held")
    known = known.agg(F.min("mean_weight").alias("mean_weight"), *[F.max(c).alias(c) for c in BAD]).collect()
    means = sorted(r.mean_weight for r in known if r.kind == "clean")
    threshold = min(means[int(LOST * len(means))], 0.0) - MARGIN if means else -MARGIN

    def held(kind: str, column: str) -> np.ndarray:
        return np.array([r[column] for r in known if r.held and r.kind == kind])

    most = [float("inf")] * len(BAD)
    for kind in enough:
        if min(len(held(k, "mean_weight")) for k in (kind, "clean")) < LEAST // 2:
            continue
        for part in (f"_{kind}_mean", f"_{kind}_window"):
            most[BAD.index(part)] = _between(held("clean", part), held(kind, part))
        if kind == "junk":
            threshold = max(threshold, -_between(-held("clean", "mean_weight"), -held(kind, "mean_weight")))
    able = scores.filter(_not_bad(most))
    passed = able.filter(F.col("mean_weight") >= threshold).count()
    keys = able.select(_drawn_at(threshold).alias("key"))
    cut = kth_largest(settle(keys), "key", passed) if passed else float("inf")
    return Model(ratio, threshold, cut, marks, most), scores


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_ngrams, log_weight, mean_weight, key, kept, and cuts: the bad kinds that had enough labels for
    a cut, joined by commas.

    A text without n-grams, or null, has weight 0. Rows of one doc_id share their noise, and rows tied at the cut are all
    drawn. Without labelled clean rows all weights are 0 and everything is kept. No rows: none.
    """
    model, scores = fit(docs, labels)
    kept = (F.col("key") >= F.lit(model.cut)) & _not_bad(model.most)
    cuts = ",".join(k for k in KINDS if any(m < float("inf") for n, m in zip(BAD, model.most) if n.startswith(f"_{k}_")))
    return scores.withColumn("key", _drawn_at(model.threshold)).withColumns({"kept": kept, "cuts": F.lit(cuts)}).drop(*BAD)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that `judge` keeps. Texts are weighed again, so none is shuffled."""
    model, _ = fit(docs, labels)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    scored = _scored(rows, model.ratio, model.marks).withColumn("mean_weight", _mean())
    drawn = (_drawn_at(model.threshold) >= F.lit(model.cut)) & _not_bad(model.most)
    return scored.filter(drawn).select("row.*")
