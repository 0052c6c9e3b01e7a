import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeshore.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="lakeshore-test-ckpt-")
    s = get_session("local[4]", 8, app_name="lakeshore-tests",
                    extra={"spark.checkpoint.dir": ckpt, "spark.sql.autoBroadcastJoinThreshold": "10MB"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakeshore-test-")
