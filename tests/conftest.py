import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import check  # noqa: E402
from claimweave.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = tune(check.session())
    yield s
    s.stop()
