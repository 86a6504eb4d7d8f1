from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lagscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    options = {"spark.checkpoint.dir": shared, "spark.driver.memory": "4g"}
    session = build_session("local[4]", 4, **options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """A frame's rows as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
