import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tablesync.session import get_session

    extra = {}
    # Tests set their own checkpoint folder only when the environment has none.
    if not os.environ.get("SPARK_CONF_DIR") and not os.path.exists("/tmp/checkpoints"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tablesync-test-")
    s = get_session("local[4]", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture()
def workdir(spark):
    from tablesync.session import scratch_dir

    return scratch_dir(spark, "test")
