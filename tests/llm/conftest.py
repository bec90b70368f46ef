import pytest

from tests.compare import connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con():
    return connect(SF)
