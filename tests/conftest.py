import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    from newsflow.plans.session import local_session

    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
