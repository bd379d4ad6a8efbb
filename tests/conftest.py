from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from touchline.session import build_session, clear_scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "touchline-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(work / "shared"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SMALL).exists():
        pytest.skip("the given tables are not here")
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    from compare import connect

    return connect(sf_dir)


@pytest.fixture
def events(spark):
    """Build live events from (match, seconds, team[, player[, type]]) tuples."""
    from pyspark.sql import functions as F

    from touchline.functions.eventtime import event_time

    def build(rows):
        full = [
            (m, float(t), team, *(rest or ("p",))[:1], *(rest[1:2] or ("pass",)), 1.0, 2.0)
            for m, t, team, *rest in rows
        ]
        frame = spark.createDataFrame(
            full,
            "match_id string, timestamp double, team string, player_id string, "
            "event_type string, x_coord double, y_coord double",
        )
        return frame.withColumn("event_time", event_time(F.col("timestamp")))

    return build


@pytest.fixture
def rows():
    def collect(df, *columns):
        return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())

    return collect
