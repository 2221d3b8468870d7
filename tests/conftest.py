import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetgauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, **{"spark__sql__shuffle__partitions": "4"})
    yield session
    session.stop()


def make_readings(spark, lives, sensors=("sensor_1",), value=lambda u, c, s: float(c)):
    """Small fleet: `lives` maps unit to number of cycles."""
    rows = [
        ("FD001", u, c, *[value(u, c, s) for s in sensors])
        for u, n in lives.items()
        for c in range(1, n + 1)
    ]
    schema = "variant string, unit_id int, cycle int, " + ", ".join(f"{s} double" for s in sensors)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def readings(spark):
    return lambda *args, **kwargs: make_readings(spark, *args, **kwargs)
