import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from inkprint.session import build_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[*]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    release(session)
    session.stop()
