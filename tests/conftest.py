import pytest

from tests.support import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()
