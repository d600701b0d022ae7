"""Ordered scans against brute force, with hot groups, hot moments and nulls."""

import random
from datetime import datetime, timedelta
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tallyline.operators import (
    following, last_known, ordered_scan, position, previous, running_sum, running_total, spread_ties, tie_rank,
)
from tallyline.operators import ordered
from tallyline.session import release
from tests.helpers import rows

START = datetime(2024, 1, 1)
SCHEMA = "item STRING, t TIMESTAMP, id STRING, w BIGINT, mark STRING"


def make(hot_moment: bool, n: int = 600, seed: int = 5):
    """A third of the rows under one item and, if asked, a third at one moment."""
    rnd = random.Random(seed)
    made = []
    for i in range(n):
        item = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", None])
        t = START + timedelta(minutes=rnd.randrange(60 * 24 * 5))
        if hot_moment and rnd.random() < 0.34:
            t = START + timedelta(days=1)
        if rnd.random() < 0.03:
            t = None
        made.append((item, t, f"{i:05d}", rnd.randrange(10), f"m{i}" if rnd.random() < 0.05 else None))
    return made


def first_null(v):
    return (v is not None, v if v is not None else 0)


def brute(made, keys):
    out = {}
    item = (lambda r: first_null(r[0])) if keys else (lambda r: 0)
    ordered_rows = sorted(made, key=lambda r: (item(r) if keys else 0, first_null(r[1]), r[2]))
    for _, group in groupby(ordered_rows, key=item):
        group = list(group)
        total, known = 0, None
        for i, r in enumerate(group):
            total += r[3]
            known = r[4] if r[4] is not None else known
            same = [x[2] for x in group if x[1] == r[1]]
            out[r[2]] = (
                total, i, group[i - 1][1] if i else None, group[i - 1][4] if i else None,
                group[i + 1][4] if i + 1 < len(group) else None, known, same.index(r[2]),
            )
    return out


def scans_of(df, place):
    return df._jdf.queryExecution().sparkPlan().toString().count(f"[file:{place}]")


@pytest.mark.parametrize("keys", [["item"], []], ids=["by item", "overall"])
@pytest.mark.parametrize("hot_moment, limit, form", [
    (True, 10_000, "whole"), (False, 130, "periods"), (True, 60, "ranges"),
])
@pytest.mark.parametrize("fanout", [4096, 3])
def test_all_scans_in_all_forms(spark, monkeypatch, tmp_path, keys, hot_moment, limit, form, fanout):
    kept, scanned = [], []
    place = str(tmp_path / "input")

    def recorded(df, label, real=ordered.stored):
        kept.append(label)
        scanned.append(scans_of(df, place))
        return real(df, label)

    monkeypatch.setattr(ordered, "stored", recorded)
    made = make(hot_moment)
    spark.createDataFrame(made, SCHEMA).write.parquet(place)
    scans = {
        "total": running_sum(F.col("w")), "place": position(), "t_before": previous("t"),
        "mark_before": previous("mark"), "mark_after": following("mark"), "known": last_known("mark"),
        "tie": position(group=[*keys, "t"]),
    }
    got = ordered_scan(spark.read.schema(SCHEMA).parquet(place), keys, ["t", "id"], limit, fanout, **scans)
    assert ("ranges" in kept) == (form == "ranges")
    assert (ordered.PART in got._jdf.queryExecution().analyzed().toString()) == (form != "whole")
    assert {r["id"]: tuple(r)[5:] for r in got.collect()} == brute(made, keys)
    # The input is read for the counts, and once more.
    assert sum(scanned) + scans_of(got, place) == 2


def test_hot_moment_alone_is_cut_by_id(spark):
    made = make(True)
    frame = spark.createDataFrame(made, SCHEMA)
    whole = tie_rank(frame, ["item"], "t", "id")
    cut = tie_rank(frame, ["item"], "t", "id", max_group_rows=20)
    assert rows(cut) == rows(whole)
    assert max(r["tie_rank"] for r in cut.collect()) > 40


def test_copies_are_spread_over_ranges(spark, monkeypatch):
    kept = []
    real = ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df, label: kept.append(real(df, label)) or kept[-1])
    made = make(False, 300) + [("hot", START, "copy", 1, None)] * 150
    got = running_total(spark.createDataFrame(made, SCHEMA), ["item"], "t", "id", max_group_rows=40)
    totals = sorted(r["cumulated"] for r in got.filter("item = 'hot'").collect())
    assert totals == list(range(1, len(totals) + 1))
    copies = sorted(r["cumulated"] for r in got.filter("id = 'copy'").collect())
    assert copies == list(range(copies[0], copies[0] + 150))
    sizes = kept[-1].groupBy(ordered.PART).count()
    assert sizes.agg(F.max("count")).first()[0] < 100


def test_no_part_holds_more_than_the_limit(spark):
    frame = spark.createDataFrame(make(False), SCHEMA)
    seconds, _ = ordered._period(ordered._counted(frame, ["item"], "t", ["t", "id"], {}), ["item"], 60)
    parts = frame.groupBy("item", ordered.period_of("t", seconds)).count()
    assert parts.agg(F.max("count")).first()[0] <= 60


def test_hot_moment_has_no_period(spark):
    counts = ordered._counted(spark.createDataFrame(make(True), SCHEMA), ["item"], "t", ["t", "id"], {})
    assert ordered._period(counts, ["item"], 30) is None


def test_sums_of_fractions_do_not_depend_on_the_cut(spark):
    rnd = random.Random(3)
    frame = spark.createDataFrame(make(False), SCHEMA).withColumn("x", (F.col("w") - 4) * F.lit(rnd.random()) + 0.1)
    forms = []
    for limit in (10_000, 60, 5):
        got = running_total(frame, ["item"], "t", "id", F.col("x"), max_group_rows=limit)
        assert got.schema["cumulated"].dataType.simpleString() == "double"
        forms.append(rows(got, "id", "cumulated"))
    assert forms[0] == forms[1] == forms[2]
    kinds = {
        running_total(frame, ["item"], "t", "id", F.col("w").cast("decimal(10,2)"), max_group_rows=limit).schema["cumulated"].dataType
        for limit in (10_000, 60, 5)
    }
    assert len(kinds) == 1


def test_group_must_be_first_of_the_order(spark):
    frame = spark.createDataFrame(make(False, 5), SCHEMA)
    with pytest.raises(ValueError, match="must be"):
        ordered_scan(frame, ["item"], ["t", "id"], x=position(group=["id"]))


def test_periods_shuffle_the_rows_once(spark):
    frame = spark.createDataFrame(make(False), SCHEMA)
    plan = running_total(frame, ["item"], "t", "id", max_group_rows=60)._jdf.queryExecution().executedPlan().toString()
    with_id = [line for line in plan.splitlines() if "Exchange" in line]
    # Rows with the extra ones; and the edges per part, twice.
    assert len(with_id) == 3


def test_spread_leaves_single_rows_alone(spark):
    made = [("a", START, "1", 0, None), ("a", START, "2", 0, None), ("a", START + timedelta(seconds=1), "3", 0, None)]
    got = rows(spread_ties(spark.createDataFrame(made, SCHEMA), ["item"], "t", "id"), "id", "t")
    assert got == [("1", START), ("2", START + timedelta(milliseconds=1)), ("3", START + timedelta(seconds=1))]


def test_released_tables_go_and_others_stay(spark, tmp_path):
    one, two = (ordered.stored(spark.range(n), f"t{n}") for n in (3, 4))
    spark.range(2).write.parquet(str(tmp_path / "own"))
    own = spark.read.parquet(str(tmp_path / "own"))
    for table in (one, own):
        release(table)
    assert two.count() == 4 and own.count() == 2
    with pytest.raises(Exception, match="(?i)not.*exist|not found"):
        one.collect()
