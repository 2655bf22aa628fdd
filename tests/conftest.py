import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from blockbeam.session import build_session
    ckpt = tempfile.mkdtemp(prefix="blockbeam-test-ckpt-")
    s = build_session("local[4]", app="blockbeam-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "6g", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmp_out(spark):
    from blockbeam.sinks.scratch import scratch_path
    return lambda name: scratch_path(spark, name)
