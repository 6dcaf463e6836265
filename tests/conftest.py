from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weftline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("weftline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
