import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeledger.schemas import Lake  # noqa: E402
from lakeledger.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", shuffle_partitions=8, app_name="lakeledger-tests")
    yield s
    s.stop()


@pytest.fixture()
def lake():
    """A fresh lake folder for one test (a new folder per test, never reused)."""
    return Lake(tempfile.mkdtemp(prefix="lakeledger-test-"))
