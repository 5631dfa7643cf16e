"""Kept totals against the whole ledger, for windows that end on any day."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylane.operators import activity, sliding
from paylane.session import file_names, work_dir

START, DAY = datetime(2020, 1, 1), timedelta(days=1)
LEDGER = "sender_user_id string, sender_type string, receiver_user_id string, receiver_type string, amount decimal(20,2), copies long, settled string, transfer_date timestamp_ntz"


@pytest.fixture(scope="module")
def ledger(spark):
    rng = random.Random(21)
    who = lambda: rng.choice([(None, "SUBSCRIBER"), ("A", None), *((f"U{i}", "SUBSCRIBER") for i in range(8))])
    rows = []
    for _ in range(900):
        day = rng.randrange(100)
        if day % 11 == 5:
            continue
        rows.append((*who(), *who(), rng.choice([None, Decimal(rng.randrange(1, 99999)) / 100]), rng.choice([1, 1, 3]), rng.choice("YYYN"), START + day * DAY + timedelta(minutes=rng.randrange(1440))))
    return spark.createDataFrame(rows, LEDGER)


@pytest.fixture(scope="module")
def network(spark):
    return spark.createDataFrame([("CI",)], "network_code string")


def rows(df):
    return sorted(map(str, df.withColumns({c: F.col(c).cast("decimal(38,6)") for c in ("total_debit", "total_credit")}).select(sorted(df.columns)).collect()))


def test_every_window_equals_the_ledger(spark, ledger, network):
    totals = sliding.SlidingTotals(spark, work_dir(spark, "totals"), days=5)
    for n in range(13):
        day = START + n * DAY
        sliding.add_days(totals, ledger, [day])
        if n >= 4:
            got = sliding.sliding_profile(totals, network, day + DAY)
            assert rows(got) == rows(activity.activity_profile(ledger.where(F.col("transfer_date") < F.lit(str(day + DAY)).cast("timestamp_ntz")), network, day + DAY, 5)), n
    borders = file_names(spark, f"{totals.path}/older")
    assert len(borders) == 2 and len(file_names(spark, f"{totals.path}/older/{borders[0]}")) == 5  # built once per window length


def test_a_window_reads_two_tables_and_the_ledger_not_at_all(spark, ledger, network):
    totals = sliding.SlidingTotals(spark, work_dir(spark, "totals"), days=9)
    sliding.add_days(totals, ledger, [START + n * DAY for n in range(14)])
    totals.window(START + 9 * DAY).count()
    found = totals.window(START + 13 * DAY)
    folders = {f.rsplit("/", 2)[1] for f in found.inputFiles()} if found.inputFiles() else set()
    assert len(folders) <= 2 and all("/daily/" not in f for f in found.inputFiles())
    assert rows(sliding.sliding_profile(totals, network, START + 14 * DAY)) == rows(
        activity.activity_profile(ledger.where(F.col("transfer_date") < F.lit(str(START + 14 * DAY)).cast("timestamp_ntz")), network, START + 14 * DAY, 9))


def test_a_day_given_again_replaces_its_partial(spark, ledger, network):
    totals = sliding.SlidingTotals(spark, work_dir(spark, "totals"), days=5)
    days = [START + n * DAY for n in range(9)]
    sliding.add_days(totals, ledger.where("amount > 300"), days)
    totals.window(days[-2]).count(), totals.window(days[-1]).count()
    sliding.add_days(totals, ledger, days)
    assert rows(sliding.sliding_profile(totals, network, days[-1] + DAY)) == rows(
        activity.activity_profile(ledger.where(F.col("transfer_date") < F.lit(str(days[-1] + DAY)).cast("timestamp_ntz")), network, days[-1] + DAY, 5))
    totals.forget(days[4])
    assert totals.known_days() == days[4:]
