import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tidelog.session import build

    session = build(
        "tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# berths of harbours: two lands have several, one number is missing
HARBOURS = [
    (11, "Skagen", 410, "DK", "north"),
    (12, "Lillesund", 95, "NO", "west"),
    (13, "Grimsby", None, "UK", "east"),
    (14, "Risor", 240, "NO", "south"),
    (15, "Hundested", 60, "DK", "east"),
    (16, "Mandal", 240, "NO", "south"),
]


@pytest.fixture
def harbours(spark):
    """(id, data): each harbour as JSON text."""
    records = [
        (number, json.dumps({"name": name, "berths": berths, "place": {"land": land, "coast": coast}}))
        for number, name, berths, land, coast in HARBOURS
    ]
    return spark.createDataFrame(records, "id bigint, data string")


# (epoch ms, pump, litres) in order of arrival: out of order, with a tie, three pumps, one of them once
LITRES = [
    (500, "north", 4.5),
    (6200, "south", 12.25),
    (2600, "north", 7.0),
    (2600, "south", 1.5),
    (5100, "north", 0.75),
    (900, "south", 30.0),
    (13400, "yard", 2.0),
    (9900, "south", 6.5),
    (11000, "north", 3.25),
    (6100, "north", 9.0),
    (12600, "south", 0.25),
]


@pytest.fixture
def litres(spark):
    from pyspark.sql import functions as F

    numbered = [(n, *row) for n, row in enumerate(LITRES)]
    df = spark.createDataFrame(numbered, "seq bigint, ms bigint, pump string, litres double")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def windowed(size, step=None, fold=sum, data=LITRES):
    """{(pump, start in seconds): fold of the litres} for windows of whole seconds, by their definition."""
    step = step or size
    held = {}
    for ms, pump, value in data:
        for start in range(-size, ms // 1000 + 1):
            if start % step == 0 and start * 1000 <= ms < (start + size) * 1000:
                held.setdefault((pump, start), []).append(value)
    return {key: round(fold(values), 4) for key, values in held.items()}


def by_pump(data=LITRES, key=lambda n, row: n):
    """{pump: its rows in some order}; the order of arrival unless a key is given."""
    held = {}
    for _, row in sorted(enumerate(data), key=lambda x: (key(*x), x[0])):
        held.setdefault(row[1], []).append(row)
    return held


def rows(df):
    """The rows as a sorted list of tuples, floats to 4 digits."""

    def plain(value):
        return round(value, 4) if isinstance(value, float) else value

    return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=repr)
