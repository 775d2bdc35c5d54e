import pytest

from millrace.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Small partitions stay apart, so ordered operators meet many slices.
    session = local_session(8, "millrace-tests", spark__sql__adaptive__coalescePartitions__enabled="false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
