import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session

    extra = {}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        # Tests only: a private checkpoint folder when the session names none.
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session(master="local[4]", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tidewater.session import scratch_path

    return lambda label: scratch_path(spark, label)
