import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from shelfmark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
