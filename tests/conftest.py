import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="ledgerline-tests", conf={"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test (never cleaned up by the tests)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
