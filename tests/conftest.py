import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from metroframe.session import build_session, shared_dir

    s = build_session("metroframe-tests", master="local[4]", shuffle_partitions=4)
    # the session's spark.checkpoint.dir is used when set; only when it is
    # unset does shared_dir() make a temporary one (as tests may)
    shared_dir(s)
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
