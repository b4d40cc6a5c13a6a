import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

import __spark_entry__  # noqa: E402, F401  (lets functions of the package travel to the workers)
from tests.compare import open_tables  # noqa: E402
from tidegrid.session import local_session, scratch_path  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tidegrid-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def tables(sf_dir):
    return open_tables(sf_dir)


@pytest.fixture
def path(spark):
    """A new path per call."""
    return lambda name="t": scratch_path(spark, name)
