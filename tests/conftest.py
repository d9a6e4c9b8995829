import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trendlake.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="trendlake-test-ckpt-")
    s = get_spark(
        app_name="trendlake-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake(tmp_path):
    return str(tmp_path / "lake")
