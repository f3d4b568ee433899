import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from missive.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, shuffle_partitions=4, **{"spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
