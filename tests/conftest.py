import pytest

from evenkeel.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "evenkeel-tests", spark__sql__shuffle__partitions="2",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
