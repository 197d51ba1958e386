import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from salesloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="checkpoint-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate expressions on one row: ``one("value", expr)``."""

    def evaluate(value, expression, kind="string"):
        df = spark.createDataFrame([(value,)], f"x {kind}")
        return df.select(expression.alias("y")).first()["y"]

    return evaluate


def day(text):
    return dt.date.fromisoformat(text)


def moment(text):
    return dt.datetime.fromisoformat(text)
