import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartspark.session import build_session  # noqa: E402
from cartspark.sources import EVENT_SCHEMA  # noqa: E402

MINUTE = 60_000
HOUR = 3_600_000


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cartspark-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cartspark-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Builds an event table from (timestamp, visitor, event, item) rows."""

    def build(*rows):
        full = [row if len(row) == 5 else (*row, None) for row in rows]
        return spark.createDataFrame(full, EVENT_SCHEMA)

    return build


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
