import pytest

from sift.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="sift-llm-tests", shuffle_partitions=8)
    yield s
