import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from paysignal.session import get_spark

    scratch = tempfile.mkdtemp(prefix="paysignal-test-")
    s = get_spark(
        "paysignal-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from paysignal.plans.io_queries import scratch

    return scratch(spark, "test")
