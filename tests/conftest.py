from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from skywarden.session import build_session

    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="skywarden-tests-"))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
