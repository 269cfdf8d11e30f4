import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from keelson.session import build_session
    s = build_session(master="local[4]", app="keelson-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def spark_session_for_props(spark):
    return spark
