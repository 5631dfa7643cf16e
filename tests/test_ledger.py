import itertools
import random
from collections import Counter
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from paylane.operators import activity, geography, ledger, parties
from paylane.params import RunParams
from paylane.plans import transaction

DAY = "2020-05-01T10:00:00"
RUN = RunParams("CI", "DELTA", datetime(2020, 5, 1), datetime(2020, 5, 2))


def leg(transfer, kind, party, other, value=100, **more):
    base = dict(transfer_id=transfer, transfer_date=DAY, transaction_type=kind, party_id=party, second_party=other,
                transfer_value=value, requested_value=value, wallet_number=f"W{party}", account_id=f"P{party}", service_type="P2P")
    return {**base, **more}


def test_equal_legs_fan_out_and_missing_keys_do_not_pair(make):
    items = make("txn_item", [
        leg("T1", "MR", "B", "A"), leg("T1", "MR", "B", "A"), leg("T1", "MP", "A", "B"), leg("T1", "MP", "A", "B"),
        leg("T2", "MR", "B", "A", 100), leg("T2", "MP", "A", "B", 101),
        leg("T3", "MR", None, "A"), leg("T3", "MP", "A", None),
        leg("T4", "CR", "B", "A"), leg("T4", "MP", "A", "B"),
        leg("T5", "SCR", "B", "A"), leg("T5", "SCP", "A", "B"),
    ])
    pairs = Counter((r.transfer_id, r.kind) for r in ledger.pair_legs(items).collect())
    assert pairs == {("T1", "MR"): 4, ("T5", "SCR"): 1}


def test_charges_match_listing_every_pair(make, spark):
    rng = random.Random(7)
    rows = []
    for _ in range(300):
        kind = rng.choice(["MR", "MP", "SCR", "SCP", "CR", "CP"])
        # One transfer holds a third of all legs.
        transfer = "HOT" if rng.random() < 0.34 else f"T{rng.randrange(6)}"
        ends = ["A", "IND03"] if kind.endswith("P") else ["IND03", "A"]
        if rng.random() < 0.5:
            ends = ends[::-1]
        rows.append(leg(transfer, kind, *ends, rng.choice([100, 250]), service_type=rng.choice(["ROLLBACK", "P2P"])))
    wanted = Counter()
    for r, q in itertools.product(rows, rows):
        if ledger.LEG_PAIRS.get(r["transaction_type"]) != q["transaction_type"] or r["transfer_id"] != q["transfer_id"]:
            continue
        if (r["party_id"], r["second_party"], r["transfer_value"]) != (q["second_party"], q["party_id"], q["transfer_value"]):
            continue
        charged = r["transaction_type"] == "SCR" or (
            r["transaction_type"] == "MR" and r["service_type"] == "ROLLBACK" and r["second_party"] == "IND03"
        )
        wanted[r["transfer_id"]] += r["transfer_value"] if charged else 0
    got = ledger.charge_totals(make("txn_item", rows), F.lit(Decimal(1)))
    assert {r.transfer_id: int(r.total_charge) for r in got.collect()} == {k: v for k, v in wanted.items() if v}


def world(tables, **more):
    """Two subscribers and a channel user; A pays B, B pays the shop."""
    base = dict(
        wallet=[dict(wallet_number=f"W{u}", user_id=u, user_type=k, msisdn=f"P{u}", status="Y", is_primary="Y")
                for u, k in (("A", "SUBSCRIBER"), ("B", "SUBSCRIBER"), ("S", "CHANNEL"), ("O", "OPERATOR"))],
        party=[dict(user_id=u, user_type="SUBSCRIBER", msisdn=f"P{u}", status="Y", category_code="SUBS", network_code="GN") for u in "AB"],
        channel_user=[dict(user_id="S", user_type="CHANNEL", msisdn="PS", status="Y", designation=" irtoutFR ")],
        country=[dict(id=1, country_iso="FR", currency_iso="EUR", status="Y"), dict(id=2, country_iso="CI", currency_iso="XOF", status="Y")],
        txn_header=[dict(transfer_id=x, transfer_date=DAY, created_on=DAY, transfer_status="TS", service_type="P2P", transfer_subtype="SUB")
                    for x in ("T1.1", "T2.2", "T3.3")],
        txn_item=[
            leg("T1.1", "MR", "B", "A"), leg("T1.1", "MP", "A", "B"),
            leg("T2.2", "MR", "S", "B", 200), leg("T2.2", "MP", "B", "S", 200),
            leg("T3.3", "MR", "O", "A", 300), leg("T3.3", "MP", "A", "O", 300),
        ],
    )
    return tables(**{**base, **more})


def whole_ledger(t):
    return transaction.ledger(t, RUN)


def test_two_sides_cancel_and_only_reported_types_show(tables):
    sides = transaction.reported_sides(whole_ledger(world(tables)), RUN).collect()
    seen = Counter((r.transfer_id, r.side, r.own_wallet) for r in sides)
    # The operator's side of T3 is not reported.
    assert seen == {("T1.1", "D", "WA"): 1, ("T1.1", "C", "WB"): 1, ("T2.2", "D", "WB"): 1, ("T2.2", "C", "WS"): 1, ("T3.3", "D", "WA"): 1}
    totals = Counter()
    for r in sides:
        totals[r.transfer_id] += r.signed_amount
    assert totals["T1.1"] == totals["T2.2"] == 0 and totals["T3.3"] == -3


def test_phone_filter_keeps_one_side(tables):
    one = RunParams("CI", "DELTA", RUN.start, RUN.end, msisdn="PB")
    sides = transaction.reported_sides(whole_ledger(world(tables)), one).collect()
    assert {(r.transfer_id, r.side) for r in sides} == {("T1.1", "C"), ("T2.2", "D")}


def test_unsettled_and_out_of_window_transfers_are_left_out(tables):
    t = world(tables, txn_header=[
        dict(transfer_id="T1.1", transfer_date=DAY, transfer_status="TA"),
        dict(transfer_id="T2.2", transfer_date="2020-05-02T00:00:00", transfer_status="TS"),
        dict(transfer_id="T3.3", transfer_date="2020-05-01T00:00:00", transfer_status="TS"),
    ])
    assert {r.transfer_id for r in whole_ledger(t).collect()} == {"T3.3"}


def test_non_financial_service_needs_a_charge(tables):
    items = [leg("T1.1", "MR", "B", "A", service_type="BILL"), leg("T1.1", "MP", "A", "B", service_type="BILL"),
             leg("T2.2", "MR", "S", "B", service_type="BILL"), leg("T2.2", "MP", "B", "S", service_type="BILL"),
             leg("T2.2", "SCR", "X", "B", 5), leg("T2.2", "SCP", "B", "X", 5)]
    assert {r.transfer_id for r in whole_ledger(world(tables, txn_item=items)).collect()} == {"T2.2"}


def test_charge_is_taken_before_the_reclassified_leg_is_dropped(tables):
    # The fee leg of a rollback is no main leg itself, but its charge keeps the other main leg of the transfer.
    items = [leg("T1.1", "MR", "B", "IND03", 7, service_type="ROLLBACK"), leg("T1.1", "MP", "IND03", "B", 7, service_type="ROLLBACK"),
             leg("T1.1", "MR", "B", "A", service_type="ROLLBACK"), leg("T1.1", "MP", "A", "B", service_type="ROLLBACK")]
    rows = whole_ledger(world(tables, txn_item=items)).collect()
    assert [(r.transfer_id, r.sender_user_id, r.total_charge) for r in rows] == [("T1.1", "A", Decimal("0.07"))]


def test_pseudo_party_is_never_reported(tables):
    items = [leg("T1.1", "MR", "B", "A"), leg("T1.1", "MP", "A", "B", pseudo_user_id="PX")]
    sides = transaction.reported_sides(whole_ledger(world(tables, txn_item=items)), RUN).collect()
    assert [(r.side, r.contra_type) for r in sides] == [("C", "PSEUDO")]


def geo_of(tables, mode=None, **more):
    items = [leg("T1.1", "MR", "B", "A", txn_mode=mode), leg("T1.1", "MP", "A", "B")]
    return whole_ledger(world(tables, txn_item=items, **more)).first()


def test_geography_from_transfer_fields(tables):
    r = geo_of(tables, "1#a#b#c#fr#eur#")
    assert (r.sender_country, r.sender_currency, r.receiver_country, r.receiver_currency) == ("FR", "EUR", "FR", "EUR")
    r = geo_of(tables, "1#a#b#c##")
    assert (r.sender_country, r.sender_currency) == ("CI", "XOF")
    r = geo_of(tables, "1#a#b#1IRTV3#GB#GBP#g#h#i#j#k#WorldRemit#")
    assert (r.sender_country, r.sender_currency, r.receiver_country, r.receiver_currency) == (None, None, "GB", "GBP")


def test_geography_from_designation(tables):
    by_transfer = {r.transfer_id: r for r in whole_ledger(world(tables)).collect()}
    assert (by_transfer["T2.2"].receiver_country, by_transfer["T2.2"].receiver_currency) == ("FR", "EUR")
    assert by_transfer["T2.2"].sender_country == "CI"
    no_home = [dict(param_key="CURRENCY_CODE", param_val_text="XOF")]
    assert geo_of(tables, env_param=no_home).sender_country == "GN"


def test_designation_of_a_duplicated_country_fails_only_where_used(tables):
    import pytest

    twice = [dict(country_iso="FR", currency_iso="EUR"), dict(country_iso="FR", currency_iso="CFP")]
    assert geo_of(tables, country=twice).receiver_currency == "XOF"
    with pytest.raises(Exception, match="more than one"):
        whole_ledger(world(tables, country=twice)).collect()


def test_display_and_contra_currency(spark):
    df = spark.createDataFrame([("EUR", "USD"), (None, "USD"), (None, "NA"), (None, None)], "mapped string, own string")
    shown = geography.display_currency(F.col("mapped"), F.col("own"), F.lit("XOF"))
    contra = geography.contra_currency(F.col("own"), F.col("mapped"))
    assert [tuple(r) for r in df.select(shown, contra).collect()] == [("EUR", "USD"), ("USD", "USD"), ("XOF", "XX"), ("XOF", "XX")]


def test_late_headers_and_as_of_date(make):
    headers = make("txn_header", [
        dict(transfer_id="late", transfer_date="2020-04-30T10:00:00", modified_on="2020-05-01T08:00:00"),
        dict(transfer_id="old", transfer_date="2020-04-30T10:00:00", modified_on="2020-04-30T11:00:00"),
        dict(transfer_id="in", transfer_date=DAY, modified_on="2020-05-03T08:00:00"),
        dict(transfer_id="same", transfer_date=DAY, modified_on="2020-05-01T12:00:00"),
        dict(transfer_id="back", transfer_date=DAY, modified_on="2020-04-01T12:00:00"),
    ])
    assert [r.transfer_id for r in ledger.late_headers(headers, RUN.start, RUN.end).collect()] == ["late"]
    days = {r.transfer_id: r.as_of_date for r in ledger.header_slice(headers, RUN.start, RUN.end).collect()}
    assert set(days) == {"in", "same", "back"} and set(days.values()) == {datetime(2020, 5, 1)}


def test_active_wallets_ignore_copies_and_need_a_settled_header(tables):
    copies = [leg("T1.1", "MR", "B", "A")] * 3 + [leg("T1.1", "MP", "A", "B")] * 3
    t = world(tables, txn_item=copies + [leg("T9", "MR", "S", "B"), leg("T9", "MP", "B", "S")])
    items = ledger.in_run(t["txn_item"], RUN.ledger_start, RUN.end)
    got = ledger.active_wallets(t["wallet"], items, t["txn_header"]).collect()
    assert sorted(r.wallet_number for r in got) == ["WA", "WB"]


def test_activity_joins_debit_and_credit_and_keeps_unknown_types_apart(tables):
    t = world(tables, network=[dict(network_code="CI")],
              txn_item=[leg("T1.1", "MR", "B", "A", 20_000_000), leg("T1.1", "MP", "A", "B", 20_000_000),
                        leg("T2.2", "MR", "A", "B", 300), leg("T2.2", "MP", "B", "A", 300),
                        leg("T3.3", "MR", "Z", "A", 400), leg("T3.3", "MP", "A", "Z", 400),
                        leg("T3.3", "MR", "A", "Z", 500), leg("T3.3", "MP", "Z", "A", 500)])
    profile = activity.activity_profile(activity.activity_ledger(t, RUN), t["network"], RUN.end, 30).collect()
    got = Counter((r.user_id, r.user_type, r.total_debit and int(r.total_debit), r.total_credit and int(r.total_credit), r.volume_class) for r in profile)
    assert got == {("A", "SUBSCRIBER", 200004, 8, "F"): 1, ("B", "SUBSCRIBER", 3, 200000, "F"): 1, ("Z", None, 5, None, "L"): 1, ("Z", None, None, 4, "L"): 1}


def test_shared_wallet_number_multiplies_rows(tables):
    t = world(tables, wallet=[dict(wallet_number="WA", user_id="A", user_type="SUBSCRIBER")] * 2)
    assert Counter(r.transfer_id for r in whole_ledger(t).collect()) == {"T1.1": 2, "T2.2": 1, "T3.3": 2}


def test_network_precedence(tables):
    t = tables(wallet=[dict(wallet_number="W", user_id="X", user_type="CHANNEL")],
               party=[dict(user_id="X", user_type="CHANNEL", network_code="P")], channel_user=[dict(user_id="X", network_code="U")])
    assert parties.resolve_parties(t, "user").first().network_code == "U"
    assert parties.resolve_parties(t, "party").first().network_code == "P"


def test_hot_transfer_is_split_at_run_time(spark, tables, make):
    """A third of all legs in one transfer: the join with the headers must not leave them to one task."""
    from paylane.sources import conform

    legs = spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then 'HOT' else concat('T', id % 500) end as transfer_id", "timestamp_ntz'2020-05-01 09:00:00' as transfer_date",
        "concat('A', id) as a", "concat('B', id) as b", "cast(id as decimal(20,2)) as transfer_value", "'P2P' as service_type")
    received = legs.selectExpr("*", "'MR' as transaction_type", "b as party_id", "a as second_party", "concat('W', b) as wallet_number")
    paid = legs.selectExpr("*", "'MP' as transaction_type", "a as party_id", "b as second_party", "concat('W', a) as wallet_number")
    t = tables()
    items = conform(received.unionByName(paid), "txn_item")
    headers = conform(legs.select("transfer_id", "transfer_date").distinct(), "txn_header")
    tuned = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k) for k in tuned}
    try:
        for k, v in tuned.items():
            spark.conf.set(k, v)
        x = ledger.open_transfers(ledger.header_slice(headers, RUN.start, RUN.end), items, t)
        df = x.groupBy("service_type").agg(F.count("sender_wallet").alias("n"))
        assert df.first().n == 60_000
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows[0].n == 60_000
    assert "SortMergeJoin(skew=true) [transfer_id" in plan
