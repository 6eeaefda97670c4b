import pytest

from pricetide.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus="8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
