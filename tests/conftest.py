import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from chirplens.env import local_session  # noqa: E402
from chirplens.schemas import TWEET  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    # Tests look for paths in plans, which are cut at 100 letters otherwise.
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_posts(spark):
    def make(rows):
        """Posts from ``(tid, text, created_at, urls)``."""
        return spark.createDataFrame([(t, "u", x, c, u) for t, x, c, u in rows], TWEET)

    return make
