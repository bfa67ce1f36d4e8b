import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quantlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # build_session keeps a configured spark.checkpoint.dir and sets a temporary one only if unset
    s = build_session(
        master="local[*]",
        app="quantlake-tests",
        shuffle_partitions=8,
        conf={"spark.ui.showConsoleProgress": "false"},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)
