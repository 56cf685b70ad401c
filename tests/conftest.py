import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions="4")
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """Text of the physical plan of a frame, as the optimizer hands it to execution."""

    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
