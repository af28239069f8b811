import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from aerocell.session import local_session, scratch_database  # noqa: E402
from aerocell.sources.tables import create_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    """An empty database with the three tables."""
    name = scratch_database(spark)
    create_tables(spark, name)
    return name


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
