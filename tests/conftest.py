import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orefold.session import build_session  # noqa: E402

DATA = os.environ.get("OREFOLD_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "orefold-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Lower the limits so that small tables take the paths for large ones."""
    lowered = {
        "spark.orefold.hotGroupRows": "5",
        "spark.orefold.broadcastBytes": "0",
        "spark.orefold.hotListBytes": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in lowered.items():
        spark.conf.set(key, value)
    yield
    for key in lowered:
        spark.conf.unset(key)


@pytest.fixture(scope="session")
def small():
    folder = f"{DATA}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder


@pytest.fixture(scope="session")
def medium():
    folder = f"{DATA}/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder
