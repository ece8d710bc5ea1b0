import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from cantolith.session import session

    return session("tests", 4)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
