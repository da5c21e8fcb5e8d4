import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.sessions import local_session  # noqa: E402
from tagweave.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(local_session("tests"))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
