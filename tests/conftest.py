"""One small session for all tests."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from quillspark.session import importable, local_session

    session = importable(local_session(cpus=8, shuffle_partitions=4, driver_memory="6g"))
    yield session
    session.stop()
