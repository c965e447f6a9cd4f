import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import get_session
    scratch = tempfile.mkdtemp(prefix="tillroll-test-")
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                           "spark.local.dir": os.path.join(scratch, "local")})
    yield s


SF_SMALL = "/root/testdata/sf0.001"
