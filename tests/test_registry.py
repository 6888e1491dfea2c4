import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as spark_entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def pairs_all_rows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "NestedLoop" in plan or "CartesianProduct" in plan


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name, monkeypatch):
    """Rows agree with the SQL, and neither the query nor a step it settles pairs all rows."""
    settled, write = [], DataFrameWriter.parquet

    def watched(writer, *args, **kwargs):
        settled.append(pairs_all_rows(writer._df))
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    result = spark_entry.queries()[name](spark, SF)
    assert not any(settled) and not pairs_all_rows(result)
    assert compare(connection, name, result) == ""


def test_entry(spark):
    assert not spark_entry.entry(spark).isEmpty()


def test_price_filter_reaches_the_scan(spark):
    plan = spark_entry.queries()["price_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(p_retailprice,905.0), LessThanOrEqual(p_retailprice" in pushed


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_part(tmp_path, pipeline):
    """A copy without the training-data folders has all other queries, whether or not corpus_pipeline.py is there."""
    root = Path(spark_entry.__file__).parent
    shutil.copytree(root / "shelfmark", tmp_path / "shelfmark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * pipeline:
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert set(out.stdout.split()) == {q for q in spark_entry.queries() if not q.startswith("op") and q != "pipeline"}
