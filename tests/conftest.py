from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from suite.compare import connect, local_session  # noqa: E402

TEST_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, memory="4g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_SF


@pytest.fixture(scope="session")
def duck():
    con = connect(TEST_SF)
    yield con
    con.close()
