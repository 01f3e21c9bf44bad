import pytest

from tallymark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", spark__sql__shuffle__partitions="4", spark__driver__memory="3g")
    yield session


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
