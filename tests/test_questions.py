from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline.operators import healthy_share, silent_machines, stockout_risk, top_machines, unprofitable_machines
from tests.helpers import rows

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    made = [("m1", "a", 1, "healthy", 2, h) for h in range(0, 10)]
    made += [("m2", "b", c, "not_healthy", 3, 20 * c) for c in range(5)]
    return spark.createDataFrame(
        [(m, i, c, k, Decimal(p), START + timedelta(hours=h)) for m, i, c, k, p, h in made],
        "snack_automat_id STRING, item STRING, customer_id BIGINT, healthy_food STRING, "
        "price DECIMAL(18,2), time_stamp TIMESTAMP",
    )


def test_unprofitable(events):
    assert rows(unprofitable_machines(events, 20), "snack_automat_id", "sold") == [("m2", 5)]


def test_top(events):
    assert [tuple(r)[:3] for r in top_machines(events, 1).collect()] == [("m1", 10, 1)]
    assert [r["customers"] for r in top_machines(events, 5).collect()] == [1, 5]


def test_share(events):
    got = {r["healthy_food"]: (r["sold"], r["revenue"], r["share"]) for r in healthy_share(events).collect()}
    assert got == {"healthy": (10, Decimal(20), 10 / 15), "not_healthy": (5, Decimal(15), 5 / 15)}


def test_stockout(events):
    got = rows(stockout_risk(events, 8, "30 hours"), "item", "stock_left", "hours_left")
    assert got == [("a", 0, None), ("b", 3, 45.0)]


def test_silence(events):
    assert rows(silent_machines(events, 3.0), "snack_automat_id") == [("m1",)]
    later = F.lit(START + timedelta(hours=200))
    assert rows(silent_machines(events, 3.0, later), "snack_automat_id") == [("m1",), ("m2",)]
