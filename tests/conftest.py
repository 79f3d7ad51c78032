import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corridor_metrics.context import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def values(df, *columns):
    """Sorted tuples of some columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
