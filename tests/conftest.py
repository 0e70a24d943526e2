import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from staywarehouse import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = (session.builder("tests").master("local[8]").config("spark.ui.enabled", "false")
            .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
            .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def store(spark):
    from staywarehouse.sources.store import Store
    return Store(spark, session.scratch_path(spark, "test-store"))


class Clock:
    """A clock that tests set; every reading is one second later than the one before."""

    def __init__(self, start):
        self.now = start

    def __call__(self):
        from datetime import timedelta
        self.now += timedelta(seconds=1)
        return self.now


@pytest.fixture
def clock():
    from datetime import datetime
    return Clock(datetime(2024, 1, 1))
