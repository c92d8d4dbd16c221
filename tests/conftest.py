from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytracks.schemas import BRONZE  # noqa: E402
from skytracks.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "skytracks-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__ui__showConsoleProgress="false",
        # Small tables: let the many tiny directories of a write be shared by all threads.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="16k",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Build bronze rows from keyword overrides of one good report."""

    def build(*reports):
        good = {
            "ingest_ts": "2024-01-15T12:00:00",
            "icao24": "abc123",
            "callsign": "FL1",
            "origin_country": "France",
            "time_position": "2024-01-15T11:59:50",
            "last_contact": "2024-01-15T11:59:55",
            "lon": 2.0,
            "lat": 48.0,
            "baro_altitude": 1000.0,
            "on_ground": False,
            "velocity": 100.0,
            "heading": 90.0,
            "vertical_rate": 0.0,
        }
        rows = [tuple((good | report)[name] for name in BRONZE.names) for report in reports]
        return spark.createDataFrame(rows, BRONZE)

    return build
