"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import bpe
from shelfmark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def same(text):
    ids = bpe.tables(PATH).encode(text)
    found = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == found
    assert bpe.tables(PATH).decode(ids).decode("utf-8", "replace") == LIBRARY.decode(found, skip_special_tokens=False)


def test_query_equals_the_library(spark, small_documents):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for i, text in zip(small_documents["doc_id"], small_documents["text"]):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), digest(",".join(map(str, ids))), digest(decoded)))
    assert sorted(map(tuple, QUERIES["op7_bpe"](spark, small_documents["dir"]).collect())) == expected


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abthe's 1½²\n\t \r\x0b\x0c\x1c\x1f\x85\xa0 ​　é́ß中🙂<|>!?.-_"))))
def test_mixed_letters(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", " \n ", "word", " the", "'ll", "1999", "ünï", " ", "the"])))
def test_mixed_words(parts):
    same("".join(parts))


def test_random_bytes_of_vocabulary():
    random.seed(1)
    tokens = list(LIBRARY.get_vocab())
    for _ in range(300):
        word = "".join(random.choices(tokens, k=6))
        same("".join(c for c in word if c.isalpha() and c.isascii()))


@pytest.mark.parametrize("letters", ["a", "ab", "the", " ", "é", "\n"])
def test_long_words_take_linear_time(letters):
    start = time.process_time()
    same(letters * (200_000 // len(letters)))
    assert time.process_time() - start < 20


def test_round_trip_of_a_table_with_odd_rows(spark):
    rows = [(1, "héllo  wörld\n", 0), (1, "héllo  wörld\n", 0), (2, None, None), (None, "<|endoftext|>", 1), (3, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumnRenamed("ids", "n_tokens")
    back = bpe.decode(bpe.encode(docs).select("row.*", "ids")).select("row.doc_id", "row.n_tokens", "text").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((i, n, t or "")) for i, t, n in rows)
    assert bpe.report(docs).count() == 5 and bpe.report(docs.filter(F.lit(False))).count() == 0
    assert bpe.tables(PATH).decode(np.array([], np.int64)) == b""
