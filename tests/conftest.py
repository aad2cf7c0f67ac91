"""One session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import session

    made = session(
        "millrace-tests",
        "local[4]",
        **{"spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false", "spark__driver__memory": "4g", "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared"))},
    )
    made.sparkContext.setLogLevel("ERROR")
    made.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("the test tables are not here")
    return str(path)
