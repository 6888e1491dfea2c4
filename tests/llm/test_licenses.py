"""License scan: planted notices, edited templates, alignment against a plain one."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import licenses
from shelfmark.llm.queries import QUERIES

INDEX = licenses.Index(licenses.TEMPLATES)


def scan(text):
    return licenses._found(INDEX, text.encode())


def plain_words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", "".join(c.lower() if c.isascii() else c for c in text))


def test_query_finds_whole_notices(spark, more_documents):
    """Brute force: every place where all words of a notice stand in a row."""
    rows = QUERIES["op2_licenses"](spark, more_documents["dir"]).collect()
    found = {(r.doc_id, r.license, r.start) for r in rows}
    assert all(r.coverage >= 0.8 for r in rows) and found
    expected = set()
    for i, text in zip(more_documents["doc_id"], more_documents["text"]):
        for name in (n for n in licenses.TEMPLATES if n.endswith("notice")):
            pattern = r"[^0-9A-Za-z\x80-\U0010ffff]+".join(plain_words(licenses.TEMPLATES[name]))
            expected |= {(i, name, m.start()) for m in re.finditer(rf"(?i)\b{pattern}\b", text)}
    assert expected and expected <= found
    texts = dict(zip(more_documents["doc_id"], more_documents["text"]))
    for r in rows:
        own, template = plain_words(texts[r.doc_id][r.start : r.end]), plain_words(licenses.TEMPLATES[r.license])
        assert own[0] in template and own[-1] in template and lcs(template, own) >= r.matched_words == round(r.coverage * len(template))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_edited_templates(name):
    random.seed(name)
    words = licenses.TEMPLATES[name].split()
    whole = scan("é start " + " ".join(words).upper() + " end of it")
    assert [(m[0], m[1], m[3]) for m in whole] == [(name, 1.0, 8)] and whole[0][4] <= 8 + len(licenses.TEMPLATES[name])
    if len(words) > 20:
        edited = words[:]
        for i in random.sample(range(len(words)), len(words) // 20):
            edited[i] = random.choice(["", "other", edited[i] + " more"])
        found = scan("\n * ".join(["x", *edited, "y"]))
        assert [m[0] for m in found] == [name] and 0.85 < found[0][1] < 1
        assert not any(m[0] == name for m in scan(" ".join(words[: len(words) // 2])))


@pytest.mark.parametrize("seed", range(30))
def test_alignment(seed):
    random.seed(seed)
    a, b = ([random.randrange(4) for _ in range(random.randint(1, 9))] for _ in range(2))
    found = licenses.align(np.array(a), np.array(b), -len(a), len(b))
    assert len(found) == lcs(a, b) and found == sorted(set(found))
    rest = iter(a)
    assert all(any(b[at] == x for x in rest) for at in found)


def test_repeated_and_long():
    line = "Released under the MIT License. "
    assert len(scan(line * 300)) == 300
    text = "word " * 104_850 + line + "word " * 200_000 + licenses.TEMPLATES["MIT"]
    assert [m[0] for m in scan(text)] == ["MIT-notice", "MIT"]


def test_odd_rows(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0.", "x")] * 2 + [(None, "released under the mit license", "x"), (2, None, None), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = sorted((str(r.doc_id), r.license, r.start, r.end) for r in licenses.report(docs).collect())
    assert found == [("1", "CC-BY-NC-4.0-notice", 0, 27)] * 2 + [("None", "MIT-notice", 0, 30)]
    assert licenses.scan(docs).count() == 5 and licenses.report(docs.filter(F.lit(False))).count() == 0
    assert licenses.scan(docs, {}).filter("size(matches) > 0").count() == 0
