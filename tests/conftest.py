"""Session and paths of all tests."""

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
for _p in (HERE, os.path.dirname(HERE)):
    if _p not in sys.path:
        sys.path.insert(0, _p)

from strataq.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
