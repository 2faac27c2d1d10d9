import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from rigweave.session import build_session

    session = build_session(
        "tests", "local[*]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="6g", spark__ui__showConsoleProgress="false", spark__default__parallelism="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
