import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from voltaic.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=8)
    # tests set their own shared folder; a cluster names it in spark.checkpoint.dir
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voltaic-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    from voltaic.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
