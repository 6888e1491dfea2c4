import duckdb
import pytest

DATA = "/root/testdata"


def columns(folder):
    """A documents table as columns, and its folder."""
    relation = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{folder}/documents.parquet' ORDER BY doc_id")
    rows = relation.fetchall()
    return dict(zip(relation.columns, map(list, zip(*rows)))) | {"dir": folder}


@pytest.fixture(scope="session")
def small_documents():
    return columns(f"{DATA}/sf0.001")


@pytest.fixture(scope="session")
def more_documents():
    return columns(f"{DATA}/sf0.01")
