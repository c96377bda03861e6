import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    active = session()
    yield active
    active.stop()
