import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from martlet.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="martlet-tests", driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="martlet-test-")
