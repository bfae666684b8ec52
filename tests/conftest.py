import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from scorestream import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        4,
        {"spark.driver.memory": "6g", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "5"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
