import datetime as dt
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoptrail.session import local_session  # noqa: E402

SCHEMA = "event_id long, user_id long, item_id long, item_category int, behavior_type int, time timestamp_ntz"

MICRO = [
    (1, 1, 10, 1, 1, "2024-01-01 09:00:00"), (2, 1, 10, 1, 2, "2024-01-01 09:10:00"),
    (3, 1, 10, 1, 4, "2024-01-02 20:00:00"), (4, 1, 11, 1, 1, "2024-01-04 02:00:00"),
    (5, 1, 10, 1, 4, "2024-01-12 13:00:00"), (6, 2, 10, 1, 1, "2024-01-03 10:00:00"),
    (7, 2, 12, 2, 3, "2024-01-03 10:00:30"), (8, 2, 12, 2, 3, "2024-01-03 23:00:00"),
    (9, 3, 12, 2, 1, "2024-01-10 07:00:00"), (10, 3, 12, 2, 4, "2024-01-10 08:00:00"),
    (11, 4, 13, 2, 1, "2024-01-12 18:00:00"),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    rows = [(*r[:5], dt.datetime.fromisoformat(r[5])) for r in MICRO]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def skewed(spark):
    """One user holds more than a third of the rows, one item too; many ties in time."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        user = 1 if rng.random() < 0.4 else rng.randint(2, 40)
        item = 5 if rng.random() < 0.4 else rng.randint(6, 60)
        when = start + dt.timedelta(minutes=rng.randint(0, 9000), seconds=rng.choice([0, 0, 30]))
        rows.append((i, user, item, item % 7, rng.choice([1, 1, 1, 2, 3, 4]), when))
    return spark.createDataFrame(rows, SCHEMA).cache()


def rows_by(df, *keys):
    """{key: row} of a small result."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
