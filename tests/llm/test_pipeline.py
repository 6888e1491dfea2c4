"""The pipeline, stage by stage, against brute force on each stage's own input."""

from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from test_repeats import slow as slow_repeats
from test_secrets import slow_base
from test_simhash import slow_components, slow_print
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import resampling, secrets
from shelfmark.llm.common import table
from shelfmark.session import settle, shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The table before the first and after every stage."""
    out = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], SF)))
    return out


def by_id(df):
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "secret_scans", "packing"]
    assert all(df.dtypes == stages[0].dtypes for df in stages[1:-1])


def test_quality(spark, stages):
    judged = by_id(resampling.judge(stages[0], table(spark, SF, "labels")))
    before, after = by_id(stages[0]), by_id(stages[1])
    assert {i: r for i, r in before.items() if judged[i].kept} == after
    clean = table(spark, SF, "labels").filter("quality = 1 AND toxic = 0").collect()
    assert all(r.doc_id in after for r in clean)


def test_near_copies(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    ids = sorted(before)
    groups = slow_components([slow_print(before[i].text) for i in ids])
    assert {min(i for i, h in zip(ids, groups) if h == g) for g in groups} == set(after)
    assert len(after) < len(before) and all(after[i] == before[i] for i in after)


def test_repeats(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    assert set(before) == set(after)
    ids = sorted(before)
    lost = {i: r[1] for i, r in zip(ids, slow_repeats([before[i].text.encode() for i in ids], 200))}
    assert any(lost.values())
    for i in ids:
        assert after[i].n_chars == len(after[i].text)
        assert 0 <= len(before[i].text.encode()) - lost[i] - len(after[i].text.encode()) <= 6 * (lost[i] // 200)
        assert lost[i] or after[i].text == before[i].text


def test_secrets(spark, stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    found = {r.row.doc_id: r for r in secrets.scan(stages[3]).collect()}
    for i, r in before.items():
        owned = [(s.start, s.end) for s in found[i].owned]
        text = r.text
        for start, end in sorted({(s, e) for _, s, e in slow_base(r.text)} | set(owned), reverse=True):
            text = text[:start] + "\0" * (end - start) + text[end:]
        parts = [p for p in text.replace("\0", " \0 ").split("\0") if p.strip()]
        assert [len(p) > 0 for p in parts] and (text == r.text) == (after[i].text == r.text)
        assert not slow_base(after[i].text)


def test_packing(stages):
    docs, rows = by_id(stages[4]), stages[5].collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    joined = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        joined[r.doc_id] = joined.get(r.doc_id, b"") + r.ids
    for i, r in docs.items():
        assert np.frombuffer(joined[i], "<u4").tolist() == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
    fill = stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in fill) <= 4096 and len(fill) == max(r.sequence_id for r in fill) + 1


def test_run(spark, stages):
    """The same rows, and only the results of the stages and the steps of the last one are left."""
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    assert corpus_pipeline.run(spark, SF).count() == stages[5].count()
    assert len(set(folder.iterdir()) - before) <= 4 + 4


def test_empty_corpus(spark, tmp_path):
    """Every stage takes an empty table; columns of other names pass through."""
    for name in ("documents", "labels"):
        empty = table(spark, SF, name).limit(0)
        empty = empty.withColumns({c: F.lit(None).cast("long") for c in ("_gone", "row", "kept")}) if name == "documents" else empty
        empty.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, settle(stage(spark, docs, str(tmp_path)))
        assert docs.columns == columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
