import os
import sys
from pathlib import Path

import pytest

os.environ.setdefault("TZ", "UTC")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = os.environ.get("SILVERLODE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from silverlode.session import create_session

    settings = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false", "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
    }
    session = create_session("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA
