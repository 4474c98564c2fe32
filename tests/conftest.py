import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patio.operators import ordered  # noqa: E402
from patio.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny(monkeypatch):
    """Cells so small that they are cut again and again."""
    monkeypatch.setattr(ordered, "PARTS", 4)
    monkeypatch.setattr(ordered, "CELL_ROWS", 7)
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 7)


@pytest.fixture(scope="session")
def sf():
    return SF
