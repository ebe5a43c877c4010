import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketpulse.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # tests may set their own shared folder; a real cluster names one in spark.checkpoint.dir
    ckpt = tempfile.mkdtemp(prefix="marketpulse-test-")
    s = get_session(master="local[*]", app_name="marketpulse-tests", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ckpt,
                          "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="marketpulse-wh-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_path_str(tmp_path):
    return str(tmp_path)
