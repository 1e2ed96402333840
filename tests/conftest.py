import pytest

from tests.support import session


@pytest.fixture(scope="session")
def spark():
    return session()
