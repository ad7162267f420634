import pytest

from tessera.session import build


@pytest.fixture(scope="session")
def spark():
    session = build("tests")
    yield session
    session.stop()
