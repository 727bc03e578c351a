import pytest

from tests.session import session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session(cores=4, shuffles=4)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
