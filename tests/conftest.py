import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from basketspark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", shuffle_partitions=8, driver_memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ws(spark):
    """A workspace over the smallest tables, shared by all tests."""
    from verification.queries import workspace

    return workspace(spark, SMALL)
