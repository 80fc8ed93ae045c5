from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ.setdefault(
    "PYSPARK_SUBMIT_ARGS",
    "--conf spark.ui.enabled=false --conf spark.ui.showConsoleProgress=false pyspark-shell",
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from berth.session import build_session

    session = build_session("tests", "local[*]", 8, driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def con(sf_dir):
    from compare import duck

    return duck(sf_dir)
