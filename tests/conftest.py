import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tunetrail.session import build_session

    s = build_session("local[4]", 8, app_name="tunetrail-tests",
                      extra={"spark.driver.memory": "4g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tt-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tt-test-")
