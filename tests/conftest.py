import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rawhouse.session import build_session

    s = build_session("local[4]", app_name="rawhouse-tests", shuffle_partitions=4, driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    """A new local folder per test (local-mode tests only)."""
    return tempfile.mkdtemp(prefix="rawhouse-test-")
