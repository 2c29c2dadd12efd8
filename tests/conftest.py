import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    wh = tmp_path_factory.mktemp("warehouse")
    ck = tmp_path_factory.mktemp("checkpoints")
    s = build_session("local[4]", 4, app_name="barlake-tests",
                      extra={"spark.sql.warehouse.dir": str(wh),
                             "spark.checkpoint.dir": str(ck)})
    yield s
    s.stop()
