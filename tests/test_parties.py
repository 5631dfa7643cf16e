import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paylane.operators import cohorts, lookups, parties, tags
from paylane.params import RunParams
from paylane.plans import customer

DELTA = RunParams("CI", "DELTA", datetime(2020, 5, 1), datetime(2020, 5, 2))


def test_presence_and_owner_precedence(tables):
    t = tables(
        wallet=[
            dict(wallet_number="1", user_id="a", user_type="SUBSCRIBER", msisdn="w1"),
            dict(wallet_number="2", user_id="b", user_type="CHANNEL", msisdn="w2"),
            dict(wallet_number="3", user_id="c", user_type="OPERATOR", msisdn="w3", status="Y"),
            dict(wallet_number="4", user_id="d", user_type="CHANNEL", msisdn="w4"),
            dict(wallet_number="5", user_id="b", user_type="SUBSCRIBER", msisdn="w5"),
        ],
        party=[dict(user_id="a", user_type="SUBSCRIBER", status="Y")],
        channel_user=[dict(user_id="b", user_type="CHANNEL", msisdn="u2", status="N", designation=" shop ")],
    )
    got = {r.wallet_number: r for r in parties.resolve_parties(t).collect()}
    # Wallet 4 has nobody; wallet 5 is a subscriber's, so no channel user stands in for a missing party.
    assert set(got) == {"1", "2", "3"}
    # A found party without a phone hides the wallet's phone.
    assert (got["1"].msisdn, got["2"].msisdn, got["3"].msisdn) == (None, "u2", "w3")
    assert (got["2"].user_type, got["2"].status, got["2"].designation, got["2"].user_mark) == ("CHANNEL", "N", "SHOP", "SHOP")
    assert (got["3"].user_type, got["3"].status) == ("OPERATOR", "Y")


def test_identity_number_and_type(tables):
    def person(number, party=None, user=None):
        t = tables(
            wallet=[dict(wallet_number=number, user_id="x", user_type="CHANNEL")],
            party=[dict(user_id="x", user_type="CHANNEL", **party)] if party is not None else [],
            channel_user=[dict(user_id="x", user_type="CHANNEL", **user)] if user is not None else [],
            id_type=[dict(type_id="P", idtype_label="PASSPORT")],
        )
        r = parties.with_identity(parties.resolve_parties(t), t["id_type"]).first()
        return r.identity_type, r.id_number, r.home_country_code, r.nationality_code

    assert person("1", dict(external_code="1PFRBF77", id_no="n")) == ("PASSPORT", "77", "BF", "FR")
    assert person("2", dict(external_code="1QFRXX77", residence_country="gn")) == (None, "77", "GN", "FR")
    assert person("3", dict(external_code="é\n1", id_type="CARD")) == ("CARD", "e 1", None, None)
    assert person("4", dict(external_code="zz", id_no="n")) == ("OTHER", "n", None, None)
    # Only the user has a code, and it is structured: the test passes but the party has no number to give.
    assert person("5", dict(id_no="n"), dict(external_code="1PFRBF77")) == ("OTHER", None, None, None)


def test_identity_routing(spark):
    df = spark.createDataFrame([("PASSPORT", "7"), ("CARD", "7"), (None, "7")], "k string, n string")
    passport, other = parties.route_identity(F.col("k"), F.col("n"))
    assert [tuple(r) for r in df.select(passport, other).collect()] == [("7", None), (" ", "7"), (" ", "7")]


def test_eligible_drops_missing_status(make, tables):
    t = tables(
        wallet=[dict(wallet_number=n, user_id=n, user_type="SUBSCRIBER", status=s, is_primary=p)
                for n, s, p in (("1", "Y", "Y"), ("2", None, "Y"), ("3", "N", "Y"), ("4", "Y", "N"), ("5", "Y", "Y"))],
        party=[dict(user_id=n, user_type="SUBSCRIBER", status=None if n == "5" else "Y") for n in "12345"],
    )
    users = parties.resolve_parties(t)
    assert sorted(r.wallet_number for r in parties.eligible(users).collect()) == ["1", "4"]
    assert [r.wallet_number for r in parties.eligible(users, primary_only=True).collect()] == ["1"]


def test_lookup_multiplies_unless_unique(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "code string, v int")
    assert sorted((r.k or "", r.got) for r in lookups.lookup(df, dim, {"k": "code"}, {"v": "got"}).where("got is not null").collect()) == [("a", 1), ("a", 2)]
    strict = lookups.lookup(df, dim, {"k": "code"}, {"v": "got"}, unique=True)
    assert strict.where("k = 'b'").first().got is None
    with pytest.raises(Exception, match="more than one"):
        strict.collect()


def test_valid_country(spark):
    df = spark.createDataFrame([("FR",), ("GB",), (None,)], "c string")
    dim = spark.createDataFrame([("FR", "Y"), ("FR", "Y"), ("GB", "N"), (None, "Y")], "country_iso string, status string")
    assert [(r.c, r.ok) for r in lookups.valid_country(df, dim, "c", "ok").orderBy("c").collect()] == [(None, False), ("FR", True), ("GB", False)]


def test_params_defaults(tables):
    t = tables(env_param=[])
    r = lookups.with_params(t["env_param"].sparkSession.range(1), t).first()
    assert (int(r.factor), r.local_currency, r.home_country) == (100, None, None)
    t = tables(system_preference=[dict(preference_code="CURRENCY_FACTOR", default_value="1")])
    assert int(lookups.with_params(t["env_param"].sparkSession.range(1), t).first().factor) == 1


def test_rules_against_brute_force(spark, make):
    rng = random.Random(3)
    names = ["service_type", "sender_designation", "receiver_state", "not_receiver_state"]
    pick = lambda: rng.choice([None, "x", "y"])
    rules = [dict(tag_id=rng.choice([None, 1, 2, 3]), tag_name=rng.choice([None, "T1", "T2", "T3"]), transfer_subtype=rng.choice("ab"),
                  **{n: pick() for n in names}) for _ in range(12)]
    rows = [("abc"[i % 3], *v) for i, v in enumerate(itertools.product([None, "x", "y"], repeat=3))]
    df = spark.createDataFrame(rows, "sub string, service string, design string, rstate string")
    got = tags.match_rules(
        df, make("tag_rule", rules), subtype="sub",
        equal={"service_type": F.col("service"), "sender_designation": F.col("design"), "receiver_state": F.col("rstate")},
        differ={"not_receiver_state": F.col("rstate")},
    ).collect()

    def expected(sub, service, design, rstate):
        hits = [
            r for r in rules
            if r["transfer_subtype"] == sub
            and r["service_type"] in (None, service) and r["sender_designation"] in (None, design) and r["receiver_state"] in (None, rstate)
            and (r["not_receiver_state"] is None or (rstate is not None and rstate != r["not_receiver_state"]))
        ]
        if not hits:
            return sub
        least = min((r["tag_id"] is None, r["tag_id"] or 0) for r in hits)
        first = [r["tag_name"] for r in hits if (r["tag_id"] is None, r["tag_id"] or 0) == least]
        return max((n for n in first if n), default=sub)

    assert len(got) == len(rows)
    assert all(r.tag_name == expected(r["sub"], r.service, r.design, r.rstate) for r in got)


def test_keep_first_aggregate(spark):
    df = spark.createDataFrame([(1, "b"), (1, "c"), (0, None), (None, "z"), (2, "y")], "k int, v string")
    assert df.agg(tags.max_keep_first(F.col("v"), F.col("k")).alias("v")).first().v is None
    assert df.where("k > 0 or k is null").agg(tags.max_keep_first(F.col("v"), F.col("k")).alias("v")).first().v == "c"


def item(user, day, kind="MR", **more):
    return {**dict(party_id=user, account_id=user and f"P{user}", transfer_date=f"{day}T09:00:00", transaction_type=kind, transfer_status="TS",
                   service_type="P2P", category_code="SUBS"), **more}


def test_reactivated_is_active_now_and_not_before(tables):
    t = tables(txn_item=[
        item("new", "2020-05-01"),
        item("both", "2020-05-01"), item("both", "2020-02-01"),
        item("old", "2020-02-01"),
        item("edge", "2020-05-01"), item("edge", "2020-01-30"),
        item("bill", "2020-05-01", service_type="BILL"),
        item("open", "2020-05-01", transfer_status="TA"),
        item("fee", "2020-05-01", kind="SCR"),
        item("nophone", "2020-05-01", account_id=None), item("nophone", "2020-04-01", account_id=None),
    ])
    got = {r.user_id for r in cohorts.reactivated(t, DELTA.start, DELTA.end, 91).collect()}
    # 30 January is 92 days before the window. Without a phone nothing matches, so earlier activity does not count.
    assert got == {"new", "edge", "nophone"}
    before = {r.user_id for r in cohorts.active_users(t, datetime(2020, 1, 31), DELTA.start).collect()}
    assert before == {"both", "old", "nophone"}


def people(tables, **more):
    def one(u, created, modified="2019-01-01T00:00:00", wallet="2019-01-01T00:00:00"):
        return (dict(wallet_number=u, user_id=u, user_type="SUBSCRIBER", status="Y", is_primary="Y", modified_on=wallet),
                dict(user_id=u, user_type="SUBSCRIBER", msisdn=f"P{u}", status="Y", created_on=created, modified_on=modified))

    rows = [one("created", "2020-05-01T23:00:00"), one("modified", "2019-01-01T00:00:00", "2020-05-01T01:00:00"),
            one("wallet", "2019-01-01T00:00:00", wallet="2020-05-01T01:00:00"), one("back", "2019-01-01T00:00:00"),
            one("young", "2020-04-01T00:00:00"), one("quiet", "2019-01-01T00:00:00")]
    items = [item("back", "2020-05-01"), item("young", "2020-05-01"), item("quiet", "2020-04-20"), item("quiet", "2020-05-01")]
    return tables(wallet=[w for w, _ in rows], party=[p for _, p in rows], txn_item=items, **more)


@pytest.mark.parametrize(
    "mode, msisdn, expected",
    [
        ("DELTA", "ALL", {"created", "modified", "wallet", "back"}),
        ("FULLACTIVE", "ALL", {"created", "modified", "wallet", "back", "young", "quiet"}),
        ("FULL", "ALL", {"created", "modified", "wallet"}),
        ("REGEN", "ALL", {"created", "modified", "wallet"}),
        # The phone filter leaves the cohort branch alone.
        ("DELTA", "Pwallet", {"wallet", "back"}),
    ],
)
def test_reported_users_by_mode(tables, mode, msisdn, expected):
    p = RunParams("CI", mode, DELTA.start, DELTA.end, msisdn=msisdn)
    t = people(tables)
    users = parties.eligible(parties.resolve_parties(t), primary_only=True)
    assert {r.user_id for r in customer.reported_users(users, t, p).collect()} == expected


def test_unregistered_receivers_of_window_and_of_late_headers(tables):
    t = tables(
        txn_header=[dict(transfer_id="late", transfer_date="2020-04-01T00:00:00", modified_on="2020-05-01T03:00:00")],
        txn_item=[dict(transfer_id=x, transfer_date=d, transaction_type=k, unreg_user_id="n")
                  for x, d, k in (("in", "2020-05-01T00:00:00", "MR"), ("late", "2020-04-01T00:00:00", "MR"),
                                  ("old", "2020-04-01T00:00:00", "MR"), ("paid", "2020-05-01T00:00:00", "MP"), ("in", "2020-05-01T00:00:00", "MR"))],
        receiver_kyc=[dict(p2p_transfer_id=x, rec_fname=x) for x in ("in", "late", "old", "paid")],
        unreg_user=[dict(unreg_user_id="n", msisdn="99")],
    )
    assert sorted(r.rec_fname for r in cohorts.unregistered_receivers(t, DELTA.start, DELTA.end).collect()) == ["in", "late"]
    lines = [r.line for r in customer.extract_customer(t, DELTA).collect()]
    assert sorted(line[:52].split() for line in lines) == [["CI", "U99", "in"], ["CI", "U99", "late"]]
