"""One small session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from assayweave.session import build_session

    session = build_session("tests", "local[2]", spark__sql__shuffle__partitions="3", spark__driver__memory="3g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
