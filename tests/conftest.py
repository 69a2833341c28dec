from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from erpweave.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", 4, **{"spark.checkpoint.dir": str(shared)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return SMALL
