"""Legs stored once: equal ones as a number, joined and counted where they lie."""

import random
import re
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from paylane.demo.registry import WHOLE, whole_items, whole_ledger
from paylane.demo.tables import demo_tables
from paylane.operators import ledger, legs, lookups
from paylane.plans import control, transaction
from paylane.session import scratch, settings, work_dir
from paylane.sources import read_lines
from tests.test_ledger import RUN, world
from tests.test_session import plan_of

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(str, df.collect()))


def final(df):
    return plan_of(df).split("== Initial Plan ==")[0]


def test_stored_legs_give_the_pairs_of_items(spark):
    items = whole_items(demo_tables(spark, SF))
    doubled = items.unionByName(items.where("transaction_type in ('MR', 'SCP')"))
    stored = legs.store_legs(doubled)
    assert stored.table.agg(F.max("copies")).first()[0] >= 2
    for kinds in (("MR",), ("SCR", "CR"), legs.ALL_KINDS):
        plain, counted = ledger.pair_legs(doubled, kinds), ledger.pair_legs(stored, kinds)
        assert rows(legs.expanded(counted).select(sorted(set(plain.columns) - {"copies"}))) == rows(plain.select(sorted(set(plain.columns) - {"copies"})))


def test_pairs_charges_and_wallets_need_no_exchange_of_legs(spark):
    t = demo_tables(spark, SF)
    stored = transaction.run_legs(t, WHOLE)
    shuffled = lambda plan: [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "kind" in x]
    assert not shuffled(final(ledger.pair_legs(stored)))
    assert not shuffled(final(ledger.charge_totals(stored, lookups.currency_factor(t))))
    assert not shuffled(final(ledger.moved_money(stored, t["txn_header"])))
    assert shuffled(final(ledger.pair_legs(whole_items(t))))


def test_uneven_buckets_are_read_as_plain_files(spark, monkeypatch):
    monkeypatch.setattr(legs, "UNEVEN_ROWS", 100)
    items = whole_items(demo_tables(spark, SF))
    hot = items.where("transaction_type = 'MR'").limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(8000))).alias("n"))
    hot = hot.withColumn("post_balance", F.col("n").cast("decimal(38,6)")).select(items.columns)
    even, skewed = legs.store_legs(items), legs.store_legs(items.unionByName(hot))
    by_name = lambda found: "[legs_" in found.table._jdf.queryExecution().logical().toString()
    assert by_name(even) and not by_name(skewed)
    assert ledger.pair_legs(skewed, ("MR",)).count() > 8000


def test_a_million_pairs_are_a_handful_of_rows_until_written(spark, make, tables):
    """1,000 equal legs on either side of a transfer."""
    t = world(tables)
    items = t["txn_item"]
    copies = F.explode(F.array_repeat(F.lit(0), 1000)).alias("_n")
    main = (F.col("transfer_id") == "T1.1") & F.col("transaction_type").isin("MR", "MP")
    t = {**t, "txn_item": items.where(~main).unionByName(items.where(main).select("*", copies).drop("_n"))}
    found = transaction.run_legs(t, RUN)
    assert found.table.count() < 30
    tagged = transaction.ledger(t, RUN, legs=found)
    assert tagged.count() < 30
    lines = transaction.extract_transaction(t, RUN, tagged)
    assert lines.count() < 60 and lines.agg(F.max("copies")).first()[0] == 1_000_000
    path = work_dir(spark, "out")
    control.write_lines(lines.where("transfer_no like 'T11%' or transfer_no like 'T1%'"), path, transaction.ORDER)
    assert read_lines(spark, path).groupBy("line").count().agg(F.max("count")).first()[0] == 1_000_000


def test_random_copies_and_nulls(spark, make):
    rng = random.Random(4)
    pick = lambda *v: rng.choice([None, *v])
    items = make("txn_item", [
        dict(transfer_id=pick("T1", "T2"), transaction_type=rng.choice(["MR", "MP", "CR", "CP", "SCR", "SCP", "XX"]), party_id=pick("A", "B"),
             second_party=pick("A", "B"), transfer_value=pick("1.00", "2.00"), requested_value=pick("1.00"), wallet_number=pick("W1"), txn_mode=pick("m"),
             service_type=pick("P2P"), transfer_subtype=pick("s"), transfer_date="2020-05-01T09:00:00")
        for _ in range(400)])
    plain = ledger.pair_legs(items).drop("copies")
    assert rows(legs.expanded(ledger.pair_legs(legs.store_legs(items))).select(plain.columns)) == rows(plain) and plain.count() > 10


def test_a_run_stores_the_legs_of_a_source_once(spark, monkeypatch, tmp_path):
    stored = []
    store = legs.store_legs
    monkeypatch.setattr(transaction, "store_legs", lambda items: stored.append(1) or store(items))
    t = demo_tables(spark, SF)
    with scratch(spark, "run"):
        for x in control.extracts(t, t, WHOLE):
            if x.name in control.OUTPUTS[3:]:
                x.build().count()
    assert len(stored) == 1 and not [r for r in spark.sql("show tables").collect() if r["tableName"].startswith("legs_") and r["isTemporary"] is None]
    with scratch(spark, "run"):
        legs.store_legs(whole_items(t))
        during = spark.sql("show tables").count()
    assert spark.sql("show tables").count() == during - 1


def test_legs_are_exchanged_once(spark, monkeypatch):
    items, plans = whole_items(demo_tables(spark, SF)), []
    write = type(items).write
    monkeypatch.setattr(type(items), "write", property(lambda df: plans.append(final(df)) or write.fget(df)))
    legs.store_legs(items)
    assert len([x for x in plans[-1].splitlines() if "Exchange hashpartitioning" in x and "kind" in x]) == 1


def test_buckets_grow_with_the_legs(spark, monkeypatch):
    items = whole_items(demo_tables(spark, SF))
    monkeypatch.setattr(legs, "BUCKET_ROWS", 500, raising=False)
    doubled = items.unionByName(items.where("transaction_type in ('MR', 'SCP')"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    stored = legs.store_legs(doubled)
    assert spark.conf.get(key, None) == before
    sizes = [r["count"] for r in stored.table.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 1000
    assert stored.table.agg(F.max("copies")).first()[0] >= 2
    pairs, plain = ledger.pair_legs(stored), ledger.pair_legs(doubled)
    assert not [x for x in final(pairs).splitlines() if "Exchange hashpartitioning" in x and "kind" in x]
    columns = sorted(set(plain.columns) - {"copies"})
    assert rows(legs.expanded(pairs).select(columns)) == rows(plain.select(columns))


def test_joins_of_legs_get_as_many_partitions_as_these_have_buckets(spark, monkeypatch):
    t, key = demo_tables(spark, SF), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(legs, "BUCKET_ROWS", 500)
    with settings(spark, {key: "8"}):
        stored = transaction.run_legs(t, WHOLE)
        buckets = legs.bucket_count(whole_items(t))
        totals = ledger.total_charge(ledger.pair_legs(stored), stored, lookups.currency_factor(t))
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            totals.collect()
            plan = totals._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(key, str(10 * buckets))
        legs.store_legs(whole_items(t))
        assert spark.conf.get(key) == str(10 * buckets)
    assert buckets > 8
    assert {int(n) for n in re.findall(r"hashpartitioning\(transfer_id#\d+, (\d+)\)", plan)} == {buckets}


def test_stored_legs_are_packed_closely(spark):
    stored = legs.store_legs(whole_items(demo_tables(spark, SF)))
    assert all(".zstd." in name for name in stored.table.inputFiles())


def test_a_ledger_stores_main_legs_and_the_keys_of_charges(spark):
    t = demo_tables(spark, SF)
    items, factor = whole_items(t), lookups.currency_factor(t)
    doubled = items.unionByName(items.where("transaction_type in ('MR', 'SCP')"))
    stored = legs.store_legs(legs.ledger_items(doubled))
    assert {r.kind for r in stored.table.select("kind").distinct().collect()} == {"MR", "SCR"}
    assert stored.table.where("kind = 'SCR' and coalesce(wallet_number, account_id, txn_mode, service_type) is not null").isEmpty()
    assert rows(ledger.charge_totals(stored, factor)) == rows(ledger.charge_totals(doubled, factor))
    plain = ledger.main_pairs(doubled)
    assert rows(legs.expanded(ledger.main_pairs(stored)).select(sorted(set(plain.columns) - {"copies"}))) == rows(plain.select(sorted(set(plain.columns) - {"copies"})))


def test_pairs_of_legs_that_carry_less(spark):
    t = demo_tables(spark, SF)
    few = transaction.run_legs(t, WHOLE, carried=("wallet_number", "service_type"))
    assert not {"txn_mode", "account_id", "requested_value"} & {*few.table.columns}
    asked = ["kind", "transfer_id", "sender_wallet", "receiver_wallet", "total_charge"]
    factor, items = lookups.currency_factor(t), whole_items(t)
    plain = ledger.total_charge(ledger.pair_legs(items), items, factor).select(asked)
    assert rows(legs.expanded(ledger.total_charge(ledger.pair_legs(few), few, factor).select(*asked, "copies"))) == rows(plain)


def test_a_phone_run_assembles_its_own_transfers(spark):
    t = demo_tables(spark, SF)
    whole = transaction.extract_transaction(t, WHOLE, whole_ledger(t, all_states=False))
    phone = replace(WHOLE, msisdn="22S3")
    wanted = transaction.extract_transaction(t, phone, whole_ledger(t, all_states=False))
    found = transaction.extract_transaction(t, phone)
    assert rows(legs.expanded(found.select("line", "copies"))) == rows(legs.expanded(wanted.select("line", "copies")))
    assert 0 < transaction.ledger(t, phone).count() < whole.count() / 4
