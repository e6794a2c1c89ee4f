import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402, F401 - sends the packages to Python workers

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from checks.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test data not present")
    return SF_DIR
