import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from lossline.session import build_session

    # tests have no cluster checkpoint folder: give the session its own
    ckpt = tempfile.mkdtemp(prefix="lossline-test-ckpt-")
    s = build_session("local[4]", app="lossline-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def store(spark):
    from lossline.sinks.tables import TableStore

    return TableStore.scratch(spark, "test")
