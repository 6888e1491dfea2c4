"""Byte-level BPE: a backtracking encoder over Aho-Corasick matches, and a decoder over an offset table.

A sequence of tokens is what merging by rank gives if and only if every two neighbours are compatible, that is no merge of lower rank
reaches over their border. The encoder takes the longest token at a position, checks it against the one
before, tries shorter prefixes, and steps back where none fits; ends found to be dead are not tried again, so it is linear
in the length of a word.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors

# Fixed value: the pattern that cuts texts into words before merging.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Words and their compatible pairs that a worker remembers.
MEMORY = 1 << 19
LONGEST = 64
BLANKS = re.compile(r"\s ", re.ASCII)


def _letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: itself, or one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tables:
    """What the encoder and the decoder look up, built from a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _letters()
        vocabulary = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        names = {i: t for t, i in vocabulary.items()} | {i: t.encode() for t, i in self.special.items()}
        parts = [names.get(i, b"") for i in range(max(names) + 1)]
        self.sizes = [len(p) for p in parts]
        #: The offset table: token i is bytes[offsets[i]:offsets[i + 1]].
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        # A token's rank is its merge's place in the list; single bytes come before all merges.
        self.rank = [-1] * len(parts)
        self.halves: list[tuple[int, int] | None] = [None] * len(parts)
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            left, right = (bytes(letters[c] for c in x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            pair, whole = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.merged[pair] = rank
            if self.halves[whole] is None:
                self.halves[whole], self.rank[whole] = pair, rank
        self.automaton = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [next((vocabulary[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in vocabulary), None) for p in parts]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.decimal = [str(i) for i in range(len(parts))]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both by rank stops at exactly these two tokens.

        Undoes their merges, latest first (of equal ranks the right one, as merges run from the left), and looks
        whether the tokens then at the border would have merged earlier.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            known = self.pairs[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        limit = len(self.merged)
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            if self.halves[left] is None and self.halves[right] is None:
                return True
            if self.rank[left] > self.rank[right]:
                limit, left = self.rank[left], self.halves[left][1]
            else:
                limit, right = self.rank[right] + 1, self.halves[right][0]

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word."""
        longest: list[int] = [0] * len(word)
        sizes, shorter = self.sizes, self.shorter
        for end, token in self.automaton.iter(word.decode("latin-1")):
            longest[end + 1 - sizes[token]] = token
        dead = bytearray(len(word) + 1)
        tokens: list[int] = []
        at = 0
        token: int | None = longest[0]
        while at < len(word):
            before = tokens[-1] if tokens else None
            while token is not None and (
                dead[at + sizes[token]] or (before is not None and not self.compatible(before, token))
            ):
                token = shorter[token]
            if token is not None:
                tokens.append(token)
                at += sizes[token]
                token = longest[at] if at < len(word) else None
            else:
                dead[at] = 1
                token = tokens.pop()
                at -= sizes[token]
        return tokens

    def _chunk(self, chunk: str) -> bytes:
        found = []
        for word in WORDS.findall(chunk):
            ids = self.known.get(word)
            if ids is None:
                ids = np.array(self.merge(word.encode()), "<u4").tobytes()
                if len(word) <= LONGEST:
                    self.known[word] = ids
            found.append(ids)
        return b"".join(found)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        Blanks that touch no other white space begin a word, so what stands between them can be encoded apart and
        remembered; others stay with their neighbours.
        """
        if not text:
            return b""
        first, *rest = text.split(" ")
        chunks = [first, *(" " + w for w in rest)]
        if "  " in text or BLANKS.search(text) or not text.isascii() or any(not w or w[0].isspace() for w in rest):
            chunks = self._glued(chunks)
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        for chunk in set(chunks).difference(known):
            ids = self._chunk(chunk)
            if len(chunk) <= LONGEST:
                known[chunk] = ids
        return b"".join([known[c] if c in known else self._chunk(c) for c in chunks])

    @staticmethod
    def _glued(chunks: list[str]) -> list[str]:
        out = [chunks[0]]
        for chunk in chunks[1:]:
            if len(chunk) < 2 or chunk[1].isspace() or (out[-1] and out[-1][-1].isspace()):
                out[-1] += chunk
            else:
                out.append(chunk)
        return out

    def encode(self, text: str) -> np.ndarray:
        if self.split is None or not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), "<u4")
        parts = self.split.split(text)
        ids = [np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p) for p in parts]
        return np.frombuffer(b"".join(ids), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, gathered through the offset table."""
        out = []
        for first in range(0, len(ids), 1 << 16):
            part = ids[first : first + (1 << 16)]
            starts = self.offsets[part]
            sizes = self.offsets[part + 1] - starts
            ends = np.cumsum(sizes)
            out.append(self.bytes[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@cache
def tables(path: str) -> Tables:
    return Tables(path)


def _path(path: str | None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(row, ids): a struct of the columns but text, and the token ids. A null text has no tokens."""
    path = _path(path)

    def run(batches: Batches) -> Batches:
        own = tables(path)
        for batch in batches:
            ids = [own.encode(t or "").tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, pa.list_(pa.int32()))], ["row", "ids"])

    return _mapped(docs, "text", run, "ids", T.ArrayType(T.IntegerType()))


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """(row, text) from rows with ids; bytes that are no UTF-8 become the replacement character, null ids an empty text."""
    path = _path(path)

    def run(batches: Batches) -> Batches:
        own = tables(path)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            found = [own.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in lists]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], ["row", "text"])

    return _mapped(tokens, "ids", run, "text", T.StringType())


def _mapped(df: DataFrame, column: str, run, out: str, kind: T.DataType) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    rows = df.select(F.struct(*rest).alias("row"), F.col(column).cast("array<int>" if column == "ids" else "string"))
    fields = [T.StructField("row", rows.schema["row"].dataType), T.StructField(out, kind)]
    return on_executors(rows, run, T.StructType(fields))


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per input row: number of tokens, digests of the ids and of what they decode to. A null text is empty;
    repeated rows and null ids are kept."""
    path = _path(path)

    def run(batches: Batches) -> Batches:
        own = tables(path)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                ids = own.encode(text or "")
                counts.append(len(ids))
                encoded.append(hashlib.sha256(",".join(map(own.decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids).decode("utf-8", "replace").encode()).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return on_executors(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
