import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from daymatrix.session import build_session

    ckpt = tempfile.mkdtemp(prefix="daymatrix-test-ckpt-")
    s = build_session("local[4]", app_name="daymatrix-tests", shuffle_partitions=4,
                      conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
