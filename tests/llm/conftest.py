import pytest

from kinesia.session import checkpoint_root, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=4)
    checkpoint_root(session)
    yield session
    session.stop()
