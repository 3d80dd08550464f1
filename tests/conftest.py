import pytest

from sparkmart.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g")
    yield session
    session.stop()
