import pytest

from tests.oracle import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    return sorted(tuple(r) for r in df.collect())
