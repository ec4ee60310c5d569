import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault(
        "PYSPARK_SUBMIT_ARGS",
        "--driver-memory 6g --conf spark.ui.enabled=false --conf spark.ui.showConsoleProgress=false pyspark-shell",
    )
    from quirelens.settings import build_session

    session = build_session("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
