import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gridcast.session import build_session

    s = build_session(app_name="gridcast-tests", master="local[4]", shuffle_partitions=8, log_level="ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridcast-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from gridcast.session import fresh_dir

    return fresh_dir(spark, "test")
