import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from latticeguard.session import build_session, checkpoint_dir

    s = build_session("local[*]", 8, app_name="latticeguard-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lg-test-ckpt-"))
    checkpoint_dir(s)
    yield s
    s.stop()
