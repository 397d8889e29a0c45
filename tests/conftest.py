import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from papyrine.session import build_session

    session = build_session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
