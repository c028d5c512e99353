import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

IST = dt.timezone(dt.timedelta(hours=5, minutes=30))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from barkeep.session import build_session
    s = build_session("local[4]", app="barkeep-tests", shuffle_partitions=8)
    yield s
    s.stop()


def epoch(day: str, hhmm: str) -> int:
    """Epoch seconds of an IST wall-clock time."""
    d = dt.datetime.strptime(day + " " + hhmm, "%Y-%m-%d %H:%M").replace(tzinfo=IST)
    return int(d.timestamp())


def bar_rows(rows):
    """[(symbol, day, hhmm, o, h, l, c, v)] -> silver rows with date."""
    out = []
    for sym, day, hhmm, o, h, l, c, v in rows:
        out.append((sym, epoch(day, hhmm), float(o), float(h), float(l), float(c), int(v),
                    dt.date.fromisoformat(day)))
    return out


BAR_DDL = "symbol string, ts long, o double, h double, l double, c double, v long, date date"


@pytest.fixture
def make_bars(spark):
    def mk(rows, interval=None):
        df = spark.createDataFrame(bar_rows(rows), BAR_DDL)
        if interval:
            from pyspark.sql import functions as F
            df = df.withColumn("interval", F.lit(interval))
        return df
    return mk


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
