"""Mixture-controlled packing: deficit round-robin over source queues into windows of a fixed number of tokens.

The round-robin hands out slots of 64 tokens. A source earns its share of every slot handed out and is served when it has
earned a whole one, so its deficit is carried from window to window. Served that way, slot x of a source with
weight w comes when x + 1 slots' worth is earned, at time (x + 1) / w; the place of a slot in the whole order is the number of
slots of all sources with an earlier time, a closed form. Every task therefore places its own documents knowing
only the length of each queue and how much of it lies in the partitions before.

A source that holds a share of `SHARE` of all tokens, or is named in the targets, has a queue of its own. Of all others, which may be
any number, a common queue is made by the same rule with documents as slots: a document comes when its source has earned what
lies before it, so the small sources are mixed document by document, and the common queue weighs what they weigh together.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import cache
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors, running, texts
from shelfmark.session import settle

TOKENS = 4096
SLOT = 64
END = 2
#: The driver and the tasks know at most 1/SHARE queues, one for each named target and the common one.
SHARE = 1 / 1024
#: Rows that are encoded at a time; parts of texts whose ids a worker remembers, the longest of them, and ends of words.
ROWS = 512
MEMORY = 1 << 18
LONGEST = 64
TAILS = 1 << 12
SEPARATORS = b"\t\n "
# Fixed value: the vocabulary's letters for the bytes in the UTF-8 of ß to ÿ that are not printable themselves.
VISIBLE = {"\x9f": "\u0141", "\xa0": "\u0142", "\xad": "\u0143"}
PUNCTUATION = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


@cache
def _tokenizer(path: str) -> "Words":
    return Words(path)


def encode(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers."""
    words = _tokenizer(path)
    return [np.frombuffer(ids, words.kind).astype("<u4").tobytes() for ids in words.encode([t.encode() for t in texts])]


class Words:
    """A tokenizer that encodes a part of a text once and remembers it.

    No token reaches over a blank, line end or tab, nor from a letter to punctuation, so texts are cut there, and each distinct part of
    a batch is looked up once. Capital letters are the same as small ones, but before a mark that could join them. Of a part that is
    not remembered, trailing punctuation is encoded apart, and what is left is encoded together with others, if it is all letters; each
    of those ends with a token of its own kind. Words of a to z and ß to ÿ are normalized already, so they go to the merges as they are.
    Ids are kept in two bytes while the vocabulary allows it.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lettered = [t for t in self.special if t.isalpha()]
        self.kind = kind_of(max(vocabulary.values()))
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        # What may follow a letter inside a special token is no place to cut.
        inside = {b for t in self.special for a, b in zip(t, t[1:]) if a.isalpha()}
        self.classes = np.zeros(256, np.uint8)
        self.classes[list(SEPARATORS)] = 1
        self.classes[[c for c in range(128) if chr(c).isalpha()]] = 2
        self.classes[[ord(c) for c in PUNCTUATION if c not in inside]] = 3
        # A vocabulary of other letters, or with a word as a special token, needs the whole tokenizer for every word.
        small = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0x100)) if c != 0xF7]
        some = [f" {a}{b}".encode() for a, b in zip(small, small[1:] + small[:1])]
        self.as_they_are = not self.lettered and list(self.learn(some, True)) == list(self.learn(some))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text of a batch, numbers of `kind`."""
        if not texts:
            return []
        whole = b"".join([b" " + t for t in texts])
        letters = np.frombuffer(whole, np.uint8)
        classes = self.classes[letters]
        cut = classes == 1
        cut[1:] |= (classes[1:] == 3) & (classes[:-1] == 2)
        starts = np.r_[np.flatnonzero(cut), len(whole)].astype(np.int64)
        capital = (letters >= 65) & (letters <= 90)
        capital[:-1] &= letters[1:] < 128
        small = letters + capital.astype(np.uint8) * 32
        joined = small.tobytes()
        if any(joined.count(s.encode()) != whole.count(s.encode()) for s in self.special):
            small = letters.copy()
        small[classes == 1] = ord(" ")
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(small)])
        parts = parts.dictionary_encode()
        _, at, body = parts.dictionary.buffers()
        at = np.frombuffer(at, np.int64)[: len(parts.dictionary) + 1]
        words = _words(np.frombuffer(body, np.uint8)[: at[-1]], at) if self.as_they_are else [False] * len(parts.dictionary)
        body, at = body.to_pybytes(), at.tolist()
        ids = pa.array(self.look_up([body[a:b] for a, b in zip(at, at[1:])], words), pa.large_binary())
        encoded = ids.take(parts.indices)
        at = np.frombuffer(encoded.buffers()[1], np.int64)[: len(encoded) + 1]
        cuts = at[np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))]
        body = memoryview(encoded.buffers()[2] or b"")
        return [bytes(body[a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def look_up(self, parts: list[bytes], words: list[bool]) -> list[bytes]:
        """Ids of distinct parts, each with the blank before it, if any; `words` are those found by `_words`."""
        if len(self.known) > MEMORY:
            # What has come last and what these texts use stays: the frequent words, mostly.
            used = {p: self.known[p] for p in parts if p in self.known}
            self.known = dict(islice(self.known.items(), len(self.known) - MEMORY // 2, None)) | used
        out = list(map(self.known.get, parts))
        missing = [i for i, ids in enumerate(out) if ids is None]
        new = dict(self.learn([parts[i] for i in missing if words[i]], True))
        other = [parts[i] for i in missing if not words[i]]
        new.update(zip(other, self.work_out([p.removeprefix(b" ").decode() for p in other])))
        for i in missing:
            out[i] = new[parts[i]]
        self.known.update(new)
        for part in [p for p in new if len(p) > LONGEST]:
            del self.known[part]
        return out

    def work_out(self, words: list[str]) -> list[bytes]:
        letters = [w.rstrip(PUNCTUATION) for w in words]
        keys = [s.lower() if s.isascii() else s for s in letters]
        rest = [w[len(s) :] for w, s in zip(words, letters)]
        if len(self.tails) > TAILS:
            self.tails = {"": b""}
        tails = self.tails
        # Letters that normalizing or lower-casing would take apart could end in a mark, which goes with punctuation.
        plain = [s for s in set(keys) if self.plain(s) and not any(t in s for t in self.lettered)]
        stems = {"": b""} | {p[1:].decode(): ids for p, ids in self.learn([b" " + s.encode() for s in plain])}
        tails.update((t, self.alone(t)) for t in set(rest).difference(tails))
        found = list(map(stems.get, keys))
        out = [stem + tails[tail] if tail and stem is not None else stem for stem, tail in zip(found, rest)]
        together = "\n".join(words)
        special = any(s in together for s in self.special)
        for i in [i for i, ids in enumerate(out) if ids is None] if not special else range(len(words)):
            if out[i] is None or any(s in words[i] for s in self.special):
                out[i] = self.alone(words[i])
        return out

    @staticmethod
    def plain(stem: str) -> bool:
        return stem.isalpha() and (stem.isascii() or (is_normalized("NFC", stem) and stem.lower().isalpha()))

    def learn(self, parts: list[bytes], normalized: bool = False) -> Iterator[tuple[bytes, bytes]]:
        """Parts of a blank and letters with their ids, encoded many at a time."""
        tokenizer = self.merges if normalized else self.tokenizer
        for some in (parts[first : first + 128] for first in range(0, len(parts), 128)):
            text = b"".join(some)[1:].decode("latin-1" if normalized else "utf-8")
            for byte, letter in VISIBLE.items() if normalized else ():
                text = text.replace(byte, letter)
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                body, width = ids.tobytes(), ids.itemsize
                cuts = [0, *(width * ends).tolist()]
                yield from zip(some, [body[a:b] for a, b in zip(cuts, cuts[1:])])
            else:
                yield from ((p, self.alone(p[1:].decode())) for p in some)

    def alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()


def _words(letters: np.ndarray, at: np.ndarray) -> list[bool]:
    """Which parts are a blank and then only letters of a to z and ß to ÿ, in UTF-8."""
    small = (letters - np.uint8(ord("a")) < 26) | (letters == 0xC3)
    small[1:] |= (letters[:-1] == 0xC3) & (letters[1:] >= 0x9F) & (letters[1:] != 0xB7)
    before = np.r_[0, np.cumsum(small, dtype=np.int32)][at]
    return ((np.diff(at) > 1) & (np.diff(before) == np.diff(at) - 1) & (letters[at[:-1]] == ord(" "))).tolist()


def kind_of(greatest: int) -> str:
    return "<u2" if greatest < 1 << 16 else "<u4"


def _tokens(path: str):
    def run(batches: Batches) -> Batches:
        part, queued, words = TaskContext.get().partitionId(), defaultdict(int), _tokenizer(path)
        pack, width = zstandard.ZstdCompressor(level=1), np.dtype(words.kind).itemsize
        for rows in (batch.slice(first, ROWS) for batch in batches for first in range(0, batch.num_rows, ROWS)):
            sources = rows.column("source").to_pylist()
            counts, starts, bodies = [], [], []
            for source, ids in zip(sources, words.encode([t or b"" for t in texts(rows)])):
                n = len(ids) // width + 1
                counts.append(n)
                starts.append(queued[source])
                queued[source] += n
                bodies.append(pack.compress(_narrow(ids, width)))
            arrays = [rows.column("row"), rows.column("source"), pa.array([part] * len(counts), pa.int32())]
            arrays += [pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "source", "part", "at", "n", "z"])
        pa.default_memory_pool().release_unused()  # the worker lives on through later stages

    return run


def _narrow(ids: bytes, width: int) -> bytes:
    """The bytes of each number plane by plane, which packs better; in front, how many there are of each."""
    return bytes([width]) + np.frombuffer(ids, np.uint8).reshape(-1, width).T.tobytes()


def _wide(planes: bytes) -> bytes:
    """Little-endian unsigned 32-bit numbers again."""
    width = planes[0]
    return np.frombuffer(planes, np.uint8, offset=1).reshape(width, -1).T.copy().view(f"<u{width}").astype("<u4").tobytes()


def tokenize(docs: DataFrame, path: str, source: str = "source") -> DataFrame:
    """(row, source, part, at, n, z): packed ids per input row, and its place in its source's queue of this partition."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*rest).alias("row"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    kinds = [("row", rows.schema["row"].dataType), ("source", T.StringType()), ("part", T.IntegerType())]
    kinds += [("at", T.LongType()), ("n", T.LongType()), ("z", T.BinaryType())]
    return settle(on_executors(rows, _tokens(path), T.StructType([T.StructField(n, k) for n, k in kinds])))


def order_of(slot: np.ndarray, queue: np.ndarray, lengths: list[int], weights: list[int]) -> np.ndarray:
    """Place of each slot in the order in which the round-robin hands them out.

    Slot x of queue q follows every slot y of queue r with (y + 1) / w_r < (x + 1) / w_q; of equal ones the lower queue goes
    first, and a queue that has run dry leaves its share to the others. Exact whole numbers throughout.
    """
    wide = (max(lengths) + 1) * max(weights) >= 1 << 62
    kind = object if wide else np.int64
    slot, own = slot.astype(kind), np.array(weights, kind)[queue]
    place = np.zeros(len(slot), kind)
    for r, (length, weight) in enumerate(zip(lengths, weights)):
        earned = (slot + 1) * weight
        before = np.where(queue < r, -(-earned // own) - 1, earned // own)
        place += np.where(queue == r, slot, np.minimum(before, length))
    return place.astype(np.int64)


def _cut(lengths: list[int], weights: list[int], tokens: int, slot_tokens: int):
    """Cut documents where the window changes."""

    def run(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                rows = batch.slice(first, 1024)
                n, at, queue = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("n", "queued", "queue"))
                slots = (at + n - 1) // slot_tokens - at // slot_tokens + 1
                doc = np.repeat(np.arange(len(n)), slots)
                slot = np.arange(slots.sum()) - np.repeat(np.cumsum(slots) - slots, slots) + (at // slot_tokens)[doc]
                window = order_of(slot, queue[doc], lengths, weights) // (tokens // slot_tokens)
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (window[1:] != window[:-1])][: len(doc)])
                doc, window = doc[new], window[new]
                start = np.maximum(slot[new] * slot_tokens - at[doc], 0)
                end = np.r_[start[1:], 0]
                last = np.flatnonzero(np.r_[doc[1:] != doc[:-1], True][: len(doc)])
                end[last] = n[doc[last]]
                bodies = [
                    _wide(unpack.decompress(z)) + np.array([END], "<u4").tobytes() for z in rows.column("z").to_pylist()
                ]
                ids = [bodies[d][4 * a : 4 * b] for d, a, b in zip(doc.tolist(), start.tolist(), end.tolist())]
                taken = rows.column("row").take(pa.array(doc))
                numbers = [start, end - start, n[doc], window, queue[doc], at[doc] + start]
                arrays = [taken, *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(ids, pa.binary())]
                names = ["row", "start", "length", "doc_tokens", "sequence_id", "queue", "queued", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _mixed(placed: DataFrame, sources: DataFrame, common: int, equal: bool) -> DataFrame:
    """Documents of the common queue in the order in which their sources earn them: `queued` is then their place in it."""
    key = ["source", "part", "at"]
    small = placed.filter(F.col("queue") == common)
    light = small.select(*key, "queued", "n").join(sources.select(F.col("source").alias("of"), "whole"), F.col("source").eqNullSafe(F.col("of")))
    # What lies before a document's middle, as a share of its source, or in tokens where all sources weigh the same.
    middle = F.col("queued") + F.col("n") / 2
    due = light.select(*key, "n", (middle if equal else middle / F.col("whole")).alias("due"))
    order = F.struct("due", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "part", "at")
    summed = running(due.select(F.lit(common).alias("queue"), "n", F.col("n").alias("upto"), order.alias("order"), *key), "queue", F.col("order").asc(), ["upto"])
    ranked = settle(summed.select(*[F.col(c).alias(f"_{c}") for c in key], (F.col("upto") - F.col("n")).alias("before")))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")) & (F.col("at") == F.col("_at"))
    mixed = small.join(ranked, same).withColumn("queued", F.col("before")).select(*placed.columns)
    return placed.filter(F.col("queue") != common).unionByName(mixed)


def pieces(
    docs: DataFrame,
    path: str | None = None,
    source: str = "source",
    targets: Mapping[str | None, int] | None = None,
    tokens: int = TOKENS,
    slot: int = SLOT,
    share: float = SHARE,
) -> DataFrame:
    """Pieces of all documents with their window: row (a struct of the other columns), start, length, doc_tokens, sequence_id,
    ids (little-endian unsigned 32-bit), queue and queued, the place of the piece in its queue.

    `targets` gives sources whole-number weights, others weigh 1 each, those of the common queue as many as they are;
    without it each weighs as many tokens as it has, so all queues end together. Every id lies in exactly one piece, the id 2 closes each document. A null text is
    empty, a null source is a source, repeated rows are packed as often as they occur. At most one slot per queue
    is not full, which is all the padding there is but for the last window's. No rows: no pieces.
    """
    encoded = tokenize(docs, path or public_tokenizers.path("word_bpe_49k.json"), source)
    held = settle(encoded.groupBy("part", "source").agg(F.sum("n").alias("n")))
    sources = settle(held.groupBy("source").agg(F.sum("n").alias("whole")))
    total, kinds_of_source = sources.agg(F.sum("whole"), F.count("*")).first()
    targets = dict(targets or {})
    own = F.col("whole") >= (total or 0) * share
    for name in targets:
        own = own | F.col("source").eqNullSafe(F.lit(name))
    large = sorted((tuple(r) for r in sources.filter(own).collect()), key=lambda r: (r[0] is not None, r[0]))
    lengths = [-(-n // slot) for _, n in large]
    weights = [targets.get(s, 1) if targets else length for (s, _), length in zip(large, lengths)]
    if rest := (total or 0) - sum(n for _, n in large):
        lengths.append(-(-rest // slot))
        weights.append(kinds_of_source - len(large) if targets else lengths[-1])
    queue = F.lit(len(large))
    for q, (name, _) in enumerate(large):
        queue = F.when(F.col("source").eqNullSafe(F.lit(name)), q).otherwise(queue)
    # Where each partition's share of a source begins: after those of the partitions before it.
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = held.withColumns({"begin": F.coalesce(F.sum("n").over(ahead), F.lit(0)), "queue": queue.cast("long")}).drop("n")
    begins = begins.select(F.col("source").alias("of"), F.col("part").alias("in"), "queue", "begin")
    placed = encoded.join(settle(begins), F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).select(
        "row", "source", "part", "at", "queue", (F.col("begin") + F.col("at")).alias("queued"), "n", "z"
    )
    if rest:
        placed = _mixed(placed, sources, len(large), bool(targets))
    placed = placed.select("row", "queue", "queued", "n", "z")
    kinds = [(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "queue", "queued")]
    kinds = [("row", encoded.schema["row"].dataType), *kinds, ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(n, k) for n, k in kinds])
    return on_executors(placed, _cut(lengths, weights, tokens, slot), schema)


def arranged(cut: DataFrame) -> DataFrame:
    """Add `offset`, the place of each piece in its window: queue by queue, each in its own order."""
    before = Window.partitionBy("sequence_id").orderBy("queue", "queued").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per piece: where it lies and a checksum of its ids."""
    cut = pieces(docs.select("doc_id", "text", "source"), **options)
    columns = ["start", "length", "doc_tokens", "sequence_id", "queue", "queued"]
    light = cut.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), *columns, F.crc32("ids").alias("ids_crc32"))
    return arranged(light).drop("queue", "queued")
