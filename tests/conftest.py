import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session

    s = build_session("local[4]", shuffle_partitions=4)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="quayside-test-ckpt-")  # unset only in bare test setups
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from quayside.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture
def db(spark, scratch):
    from quayside.session import fresh_name
    from quayside.sinks.table import ensure_database

    name = fresh_name("t")
    ensure_database(spark, name, f"{scratch}/warehouse")
    return name
