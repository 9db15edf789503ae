import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tickforge.session import local_session
    s = local_session("*", 8, extra={
        # tests set their own shared folder only because none is configured
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tickforge-test-ckpt-")})
    yield s
    s.stop()
