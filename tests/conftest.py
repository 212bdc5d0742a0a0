import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import clear_settled, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tidemark-tests")
    yield session
    clear_settled(session)
    session.stop()
