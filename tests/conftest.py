import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from helpers import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from clipweave.session import build_session, ship

    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__sql__ansi__enabled="true")
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session


@pytest.fixture(scope="session")
def small():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no corpus tables")
    return str(folder)
