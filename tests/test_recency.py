"""Masks of active days against the items themselves."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paylane.operators import cohorts, recency
from paylane.params import RunParams
from paylane.plans import customer
from paylane.session import remove_dir, work_dir

START = datetime(2020, 5, 1)
DAY = timedelta(days=1)


@pytest.fixture(scope="module")
def world(make):
    """Some users over 200 days, with gaps about as long as the dormant time, null ids and phones."""
    rng = random.Random(12)
    rows = []
    for u in [None, *range(150)]:
        at = rng.randrange(30, 60)
        while at < 200:
            when = START - 140 * DAY + at * DAY + timedelta(hours=rng.randrange(24), minutes=59)
            rows.append(dict(party_id=u and f"U{u}", account_id=None if u == 7 else f"P{u}", transfer_date=when.isoformat(), transaction_type=rng.choice(["MR", "MP", "MP", "SCR"]),
                             transfer_status=rng.choice(["TS", "TS", "TF"]), service_type=rng.choice(["P2P", "BILL"]), category_code="SUBS"))
            at += rng.choice([0, 1, 89, 90, 91, 92, 93, 95, 97])
    items = make("txn_item", rows)
    return lambda tables: {**tables(), "txn_item": items}


def rows(df):
    return sorted(map(str, df.select("user_id", "msisdn").collect()))


def test_ten_days_equal_the_items(spark, tables, world):
    t = world(tables)
    masks = recency.ActivityMasks(spark, work_dir(spark, "masks"))
    some = 0
    for n in range(10):
        day = START + n * DAY
        known = masks.up_to(t, day)
        again = cohorts.reactivated(t, day, day + DAY, 91)
        assert rows(recency.reactivated_users(known, 1, 91)) == rows(again)
        assert rows(recency.recently_active(known, 90)) == rows(cohorts.active_users(t, day + DAY - 90 * DAY, day + DAY))
        some += again.count()
    assert some > 5 and len(masks.days()) == 3


def test_a_day_reads_that_day_alone(spark, tables, world, make):
    t = world(tables)
    masks = recency.ActivityMasks(spark, work_dir(spark, "masks"))
    masks.up_to(t, START)
    only = {**t, "txn_item": t["txn_item"].where(F.col("transfer_date") >= F.lit((START + DAY).isoformat(" ")).cast("timestamp_ntz"))}
    assert rows(recency.reactivated_users(masks.up_to(only, START + DAY), 1, 91)) == rows(cohorts.reactivated(t, START + DAY, START + 2 * DAY, 91))


def test_gaps_late_changes_and_repeats(spark, tables, world):
    t = world(tables)
    path = work_dir(spark, "masks")
    masks = recency.ActivityMasks(spark, path, keep=10)
    fewer = {**t, "txn_item": t["txn_item"].where("transfer_status = 'TS' and party_id <> 'U3'")}
    masks.up_to(fewer, START - 5 * DAY)
    day = START + 3 * DAY  # eight days later at once, and the ten days before it read again
    known = masks.up_to(t, day, read_again=10)
    back = lambda df: df.where(recency.active_on(0, 18))
    whole = recency.day_masks(t, day - (recency.DAYS - 1) * DAY, day)
    assert sorted(map(str, back(known).select("user_id", "msisdn", F.col("recent").bitwiseAND(F.lit((1 << 18) - 1))).collect())) == sorted(
        map(str, back(whole).select("user_id", "msisdn", F.col("recent").bitwiseAND(F.lit((1 << 18) - 1))).collect()))
    assert rows(masks.up_to(t, day)) == rows(known)
    remove_dir(spark, f"{path}/day={day:%Y%m%d}/_SUCCESS")  # as a run leaves it that died
    assert day not in masks.days()
    assert rows(masks.up_to(t, day + 300 * DAY)) == []  # too long ago: read anew


@pytest.mark.parametrize("days", [0, 1, 2, 61, 62, 63, 90, 123, 124, 500])
def test_shifts(spark, days):
    for bits in ([0], [61], [62], [0, 1, 60, 61, 62, 100, 123], list(range(124))):
        word = sum(1 << b for b in bits)
        df = spark.createDataFrame([(word & recency.FULL, word >> recency.WORD)], "recent long, older long")
        recent, older = df.select(*recency.shifted(days)).first()
        assert recent | older << recency.WORD == (word << days) & ((1 << recency.DAYS) - 1)


@pytest.mark.parametrize("mode", ["DELTA", "FULLACTIVE"])
def test_reported_users_by_masks(spark, tables, world, mode):
    t = world(tables)
    p = RunParams("CI", mode, START, START + 10 * DAY)
    users = spark.createDataFrame([(f"U{u}", f"P{u}", datetime(2019, 1, 1)) for u in range(150)], "user_id string, msisdn string, creation_date timestamp_ntz")
    users = users.withColumns({"modification_date": F.col("creation_date"), "wallet_modified_on": F.col("creation_date")})
    known = recency.ActivityMasks(spark, work_dir(spark, "masks")).up_to(t, START + 9 * DAY)
    assert customer.masks_serve(p) and not customer.masks_serve(RunParams("CI", mode, START, START + timedelta(hours=5)))
    got = customer.reported_users(users, t, p, known)
    assert rows(got) == rows(customer.reported_users(users, t, p)) and got.count() > 0
