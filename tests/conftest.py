import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session

    s = build_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from ledgerlens.session import scratch_path

    return scratch_path(spark, "test")
