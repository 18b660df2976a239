import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weirflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def small_chunks(spark):
    """Many chunks, so small data takes the way of large data."""
    spark.conf.set("spark.weirflow.chunks", "23")
    yield
    spark.conf.unset("spark.weirflow.chunks")
