import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ridelake.session import build_session
    s = build_session("local[4]", app="ridelake-tests", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
