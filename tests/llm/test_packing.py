"""Packing: exact token round trip, gapless windows, target proportions."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import packing
from shelfmark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_query_holds_every_id_once(spark, small_documents, tokenizer):
    rows = QUERIES["op4_packing"](spark, small_documents["dir"]).collect()
    ids = {i: whole(tokenizer, t) for i, t in zip(small_documents["doc_id"], small_documents["text"])}
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for i, all_ids in ids.items():
        spans = sorted((r.start, r.start + r.length) for r in by_doc[i])
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(all_ids)
    total = sum(map(len, ids.values()))
    assert sorted(by_window) == list(range(len(by_window))) and len(by_window) * 4096 < total + 4096 + 64 * 21
    share = Counter()
    for r in rows:
        share[r.source] += r.length / total
    for window, inside in by_window.items():
        ends = sorted((r.offset, r.offset + r.length) for r in inside)
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])] and ends[-1][1] <= 4096
        held = Counter()
        for r in inside:
            held[r.source] += r.length
        if window < len(by_window) - 2:
            assert all(abs(held[s] - 4096 * share[s]) < 2 * 64 for s in share)


def test_order_is_a_round_robin_without_gaps():
    """Exact against sorting; the same with numbers that need more than 64 bits; dry queues leave their share."""
    lengths, weights = [50, 7, 1, 23], [3, 1, 1, 5]
    slots = [(x, q) for q, n in enumerate(lengths) for x in range(n)]
    slot, queue = (np.array(c) for c in zip(*slots))
    place = packing.order_of(slot, queue, lengths, weights)
    from fractions import Fraction

    order = sorted(range(len(slots)), key=lambda i: (Fraction(slots[i][0] + 1, weights[slots[i][1]]), slots[i][1]))
    assert [int(p) for p in place[order]] == list(range(len(slots)))
    wide = packing.order_of(slot, queue, lengths, [w << 60 for w in weights])
    assert (wide == place).all()


def test_targets_small_sources_and_odd_rows(spark, tokenizer):
    texts = {"a": "one two three " * 400, "b": "four five " * 300, None: "x", "tiny1": "y z", "tiny2": None}
    rows = [(i, texts[s], s, i) for i, s in enumerate(["a", "b", "a", None, "tiny1", "tiny2", "tiny2", "b"])]
    rows += [(None, "<|endoftext|> Ünï\x1cco de\r\nIT'S", "b", 9), (1, texts["b"], "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, start int").repartition(3)
    cut = packing.arranged(packing.pieces(docs, targets={"a": 3, "b": 1}, tokens=256, slot=32, share=0.01)).collect()
    expected = Counter((r[0], whole(tokenizer, r[1]).tobytes()) for r in rows)
    joined = defaultdict(list)
    for r in cut:
        joined[r.row.doc_id, r.row.start, r.queued - r.start, r.queue].append(r)
    found = Counter((k[0], b"".join(r.ids for r in sorted(v, key=lambda r: r.start))) for k, v in joined.items())
    assert found == expected
    first = Counter()
    for r in cut:
        first[r.row.source] += r.length if r.sequence_id < 5 else 0
    assert 2.5 < first["a"] / first["b"] < 3.5
    assert packing.report(docs.filter(F.lit(False))).count() == 0


def test_all_words_of_the_documents(more_documents, tokenizer):
    texts = [t or "" for t in more_documents["text"]]
    assert packing.encode(texts, PATH) == [whole(tokenizer, t)[:-1].tobytes() for t in texts]


ODD = ["'s foo's, it's. don't!! IT'S 've,'re", "<|endoftext|>! a<|endoftext|>b, ab <|end", "a\x1cb. x1, 12. (foo) foo) ..."]
ODD += ["\u0958\u0959, e\u0301tude. \u0301, <\u0338 x<\u0338", "ΣΑΣ. İstanbul, ſ!", "w" * 100_000 + "!!", "!" * 1000, "x." * 50_000]
ODD += ["J\u030cx J\u030c, H\u0331 I\u0307! A\u030a. j\u030c", "<|ENDOFTEXT|> a<|ENDOFTEXT|>", "<|EndOfText|><|endoftext|>A|b|>", "A…, É…; Ł., «x», x…y", "a|b, it's,'s.'s", "\n\t x\n,y"]


@pytest.mark.parametrize("text", ODD)
def test_odd_words(tokenizer, text):
    for _ in range(2):
        assert packing.encode([text], PATH)[0] == whole(tokenizer, text)[:-1].tobytes()


@pytest.mark.parametrize("text", ["é ́a  b c\x85d\x0be f", "don't <|startoftext|>x<|end", "ΑΣ ΟΔΟΣ İ ſ K", "中文 テスト a1b2", "'s 't  ''re"])
def test_words_apart_encode_like_the_text(tokenizer, text):
    assert packing.encode([text], PATH)[0] == whole(tokenizer, text)[:-1].tobytes()


@pytest.mark.parametrize("text", ["GİBİ!", "gibİ, İ. (İ) İ", "İ!İ? İstanbulİ..."])
def test_letters_that_lower_into_a_mark(tokenizer, text):
    for _ in range(2):
        assert packing.encode([text], PATH)[0] == whole(tokenizer, text)[:-1].tobytes()


SMALL = "straße naïve façade año ça où ÿ þórður " + " ".join(f"{chr(c)}a{chr(c)}" for c in range(0xDF, 0x100) if c != 0xF7)


def test_small_western_letters_are_not_normalized(tokenizer, monkeypatch):
    """Most words are of a to z and ß to ÿ: they go to the merges alone, which takes half the time."""
    words = packing.Words(PATH)
    texts = [SMALL, "The heon to", "Of"]
    expected = [whole(tokenizer, t)[:-1].astype(words.kind).tobytes() for t in texts]
    monkeypatch.setattr(words, "tokenizer", None)
    assert words.encode([t.encode() for t in texts]) == expected


def test_words_that_are_special_tokens(tmp_path):
    """Such a vocabulary needs the whole tokenizer for all words."""
    other = Tokenizer.from_file(PATH)
    other.add_special_tokens(["endofword"])
    other.save(f"{tmp_path}/other.json")
    text = "an endofword, xendofwordx ßendofword endof word"
    assert packing.encode([text], f"{tmp_path}/other.json")[0] == whole(other, text)[:-1].tobytes()
    assert packing.Words(PATH).as_they_are


def test_remembered_parts_are_not_encoded_again(tokenizer, monkeypatch):
    """Also those with digits, brackets and other letters in front, which had been worked out in every batch."""
    words = packing.Words(PATH)
    texts = [t.encode() for t in (SMALL, "in 1999, (foo) x1 été, ÉTÉ. Ωmega 中文! a.b", "the\tend\n<|endoftext|>")]
    expected = [whole(tokenizer, t.decode())[:-1].astype(words.kind).tobytes() for t in texts]
    assert words.encode(texts) == expected
    for name in ("tokenizer", "merges"):
        monkeypatch.setattr(words, name, None)
    assert words.encode(texts) == expected


def test_forgotten_parts_are_encoded_again(tokenizer, monkeypatch):
    """With room for few parts, and none for long ones, all ids stay right."""
    monkeypatch.setattr(packing, "MEMORY", 8)
    words = packing.Words(PATH)
    texts = [" ".join(f"{w}{'abcdefghij'[n % 10]} {n}" for w in ("one", "zwölf", "Été,", "x" * 80)) for n in range(12)]
    for text in texts + texts:
        assert words.encode([text.encode()]) == [whole(tokenizer, text)[:-1].astype(words.kind).tobytes()]
        assert len(words.known) <= 8 + 8 and max(map(len, words.known)) <= packing.LONGEST


def test_letters_beside_the_small_western_ones(tokenizer):
    """Capitals, × and ÷, marks that follow, letters from other blocks: each is still normalized and cut."""
    texts = [f"{x}{chr(c)}{y}{z}" for c in range(0x80, 0x180) for x in ("", "a", "é") for y in ("", "b", "ß", "\u0301") for z in ("", "!)")]
    text = " ".join(texts)
    assert packing.encode([text], PATH)[0] == whole(tokenizer, text)[:-1].tobytes()


def shares(rows, tokens):
    """For every few windows: the share of each source, and how much of it has come so far."""
    total, so_far = Counter(), Counter()
    for r in rows:
        total[r.row.source] += r.length
    for window in sorted({r.sequence_id for r in rows}):
        for r in rows:
            if r.sequence_id == window:
                so_far[r.row.source] += r.length
        yield window, dict(so_far), total, sum(so_far.values()) / sum(total.values())


def test_thousands_of_sources_are_mixed(spark):
    """2,000 small sources share a queue but not their places: each comes evenly, document by document."""
    rows = [(s * 10 + k, "one two three four five six seven " * (1 + s % 3), f"s{s}") for s in range(2000) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5, "source")
    cut = packing.pieces(docs).collect()
    longest = max(r.doc_tokens for r in cut)
    for window, so_far, total, share in shares(cut, 4096):
        assert all(abs(so_far.get(s, 0) - total[s] * share) <= 1.6 * longest for s in total), window
    assert sum(r.length for r in cut) == sum(n for s, n in {(r.row.doc_id, r.doc_tokens) for r in cut})


def test_a_small_target_is_honoured(spark):
    """A rare source that is to weigh as much as all others comes first, however small its share."""
    rows = [(s * 10 + k, "one two three four five six seven " * 3, f"s{s}") for s in range(2000) for k in range(3)] + [(-1, "rare words " * 200, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    cut = packing.pieces(docs, targets={"rare": 2000, "gone": 5}).collect()
    first = Counter()
    for r in cut:
        first[r.row.source == "rare"] += r.length
    early = Counter()
    for r in cut:
        if r.sequence_id == 0:
            early[r.row.source == "rare"] += r.length
    assert first[True] == 401 and early[True] == 401
