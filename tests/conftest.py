import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from polyeval.session import build_session
    s = build_session("local[4]", app="polyeval-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="polyeval-test-ckpt-")})
    yield s
    s.stop()
