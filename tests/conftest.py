from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="tests", cores="8", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from tidewright.sources.store import Store

    yield Store(spark, str(tmp_path / "lake"))
    for layer in ("raw", "conformed", "star"):
        spark.sql(f"DROP DATABASE IF EXISTS `{layer}` CASCADE")
