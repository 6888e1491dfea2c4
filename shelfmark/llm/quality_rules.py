"""Quality rules: counts of words, symbols and repeats, and the divergence of a document from its language.

Two histograms are compared with those of the language as a whole, by Jensen-Shannon distance: classes of characters, and
the most common words with all others as one more bin.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Batches, on_executors, texts
from shelfmark.session import settle

MIN_WORDS = 50
#: Below this many words a histogram says too little: characters are judged from 50 words on, words from 200 on.
MIN_CHARS_WORDS = 50
MIN_WORDS_WORDS = 200
MAX_CHARS = 0.32
MAX_WORDS = 0.33
COMMON = 50
#: A language with fewer words than this in all documents has no reference, and its documents no distance.
LANGUAGE_WORDS = 5000
#: References that a task keeps in the form it compares with.
REMEMBERED = 256
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Words that a task counts before it passes the counts on.
MEMORY = 1 << 18


def _classes() -> np.ndarray:
    """Class of each byte as rows of a matrix: small, capital, digit, blank, stop, symbol, other ASCII, beyond ASCII.
    Continuation bytes are no characters."""
    out = np.zeros((256, 8), np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            out[b, 7] = 1
        elif b < 0x80:
            tests = [c.islower(), c.isupper(), c.isdigit(), b in BLANK, c in ".,;:!?'\"()-", b in SYMBOLS, True]
            out[b, tests.index(True)] = 1
    return out


CLASSES = _classes()
Reference = tuple[list[float], dict[bytes, int], list[float]]


def _vocabulary(batches: Batches) -> Batches:
    """Counts of words and character classes by language, passed on whenever they fill the memory."""
    counts: dict[str | None, Counter] = {}
    held = 0

    def told() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, words in counts.items() for w, n in words.items()]
        kinds = (pa.string(), pa.binary(), pa.int64())
        columns = zip(*rows) if rows else ([], [], [])
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
            own = counts.setdefault(lang, Counter())
            before = len(own)
            own.update(_plain(text or b""))
            for i, n in enumerate((np.bincount(np.frombuffer(text or b"", np.uint8), minlength=256) @ CLASSES).tolist()):
                own[b" %d" % i] += n
            held += len(own) - before
            if held > MEMORY:
                yield told()
                counts, held = {}, 0
    yield told()


def _plain(text: bytes) -> list[bytes]:
    """Words without ASCII punctuation, ASCII letters lower-cased."""
    return text.lower().translate(None, PUNCTUATION).split()


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """(lang, words, classes, common): words in all, (word, n) of every character class and of the most common words, most common first.

    Counted over all rows; one row for each language, null included, with LANGUAGE_WORDS or more. No language's reference depends on others.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    partial = on_executors(rows, _vocabulary, "lang string, word binary, n long")
    counted = settle(partial.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    is_class = F.col("word").startswith(F.lit(b" "))
    totals = settle(counted.filter(~is_class).groupBy("lang").agg(F.sum("n").alias("words")).filter(F.col("words") >= LANGUAGE_WORDS))
    known = totals.select(F.col("lang").alias("of"))
    kept = counted.join(known, F.col("lang").eqNullSafe(F.col("of")), "left_semi")

    # The most common words: first within parts of a language, so that none is sorted in one task.
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.desc("n"), "word"))
    first = kept.filter(~is_class).withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))
    first = first.withColumn("rank", ranked).filter(F.col("rank") <= common)
    last = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = first.withColumn("rank", last).filter(F.col("rank") <= common).select("lang", "rank", "word", "n")
    shapes = kept.filter(is_class).select("lang", F.lit(0).alias("rank"), "word", "n")
    found = top.unionByName(shapes).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("all"))
    named = lambda test: F.transform(F.filter("all", test), lambda x: F.struct(x["word"].alias("word"), x["n"].alias("n")))
    found = found.select(
        F.col("lang").alias("of"), named(lambda x: x["rank"] == 0).alias("classes"), named(lambda x: x["rank"] > 0).alias("common")
    )
    return settle(totals.join(found, F.col("lang").eqNullSafe(F.col("of"))).select("lang", "words", "classes", "common"))


def _reference(words: int, classes: list[dict], common: list[dict]) -> Reference:
    """Character classes, the number of each common word, and their shares with that of all others."""
    chars = [0.0] * CLASSES.shape[1]
    for c in classes:
        chars[int(c["word"])] = float(c["n"])
    shares = [c["n"] / words for c in common]
    return chars, {c["word"]: i for i, c in enumerate(common)}, [*shares, max(0.0, 1 - sum(shares))]


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, from 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / middle), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of `width` words which occurs twice or more."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    code = ids[: len(ids) - width + 1]
    for i in range(1, width):
        if len(number) ** (i + 1) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(number) + ids[i : len(ids) - width + 1 + i]
    order = np.sort(code)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(code, twice))
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[at + i] = True
    return int(covered.sum())


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "js_chars", "js_words", "base_failed", "kept"]
KINDS = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2


def measure(text: bytes, reference: Reference | None) -> tuple:
    """The values of NAMES. A distance is null where the text is too short for it, or the language has no reference."""
    words = text.split()
    n = len(words)
    letters = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > 50 * n
    chars, common, shares = reference or ([], {}, [])
    shape, js_chars, js_words = letters @ CLASSES, None, None
    if n >= MIN_CHARS_WORDS and sum(chars):
        js_chars = distance(shape.astype(float), np.array(chars))
    if n >= MIN_WORDS_WORDS and common:
        plain = _plain(text)
        bins = np.zeros(len(shares))
        for word, count in Counter(filter(common.__contains__, plain)).items():
            bins[common[word]] = count
        bins[-1] = len(plain) - bins.sum()
        js_words = distance(bins, np.array(shares)) if len(plain) else 1.0
    far = (js_chars or 0) > MAX_CHARS or (js_words or 0) > MAX_WORDS
    characters = int(letters.sum() - letters[0x80:0xC0].sum() - sum(letters[b] for b in BLANK))
    symbols = int(sum(letters[b] for b in SYMBOLS))
    return n, characters, symbols, len(lines) - len(set(lines)), repeat, js_chars, js_words, failed, not failed and not far


def judge(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id and the values of NAMES.

    kept is false if the base rule fails or a distance is too great. A null text has no words; null counts as a language; a
    language with fewer than LANGUAGE_WORDS words is judged by the base rule alone; repeated rows are judged each. Other
    columns are ignored. The references are joined by language, so their number is not bounded by the driver or a worker.
    """

    def run(batches: Batches) -> Batches:
        known: dict[str | None, Reference] = {}
        for batch in batches:
            words, classes, common = (batch.column(c) for c in ("words", "classes", "common"))
            rows = []
            for i, (lang, text) in enumerate(zip(batch.column("lang").to_pylist(), texts(batch))):
                reference = known.get(lang)
                if reference is None and words[i].is_valid:
                    if len(known) == REMEMBERED:
                        known.clear()
                    reference = known[lang] = _reference(words[i].as_py(), classes[i].as_py(), common[i].as_py())
                rows.append(measure(text or b"", reference))
            columns = zip(*rows) if rows else [[]] * len(NAMES)
            arrays = [batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, KINDS))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *NAMES])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    found = references(docs).withColumnRenamed("lang", "of")
    joined = rows.join(found, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")
    kinds = ["long"] * 5 + ["double"] * 2 + ["boolean"] * 2
    return on_executors(joined, run, "doc_id long, " + ", ".join(f"{n} {k}" for n, k in zip(NAMES, kinds)))
