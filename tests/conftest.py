import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from runway.session import build_session
    s = build_session("local[4]", app="runway-tests", shuffle_partitions=4,
                      conf={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="runway-test-")
