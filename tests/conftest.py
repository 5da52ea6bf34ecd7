import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from packwatch.operators.keyed import HOT_ROWS_SETTING  # noqa: E402
from packwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=[None, "3"], ids=["ordinary", "hot"])
def hot(request, spark):
    """Run a test with ordinary keys and with every key of a few rows taken as hot."""
    if request.param:
        spark.conf.set(HOT_ROWS_SETTING, request.param)
    yield request.param
    spark.conf.unset(HOT_ROWS_SETTING)
