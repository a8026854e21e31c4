from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from loanweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", 8, spark__checkpoint__dir=shared, spark__sql__shuffle__partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
