"""Work folders, settings that must be unique, and plans that do not shuffle histories."""

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from paylane import session
from paylane.demo.registry import YEAR
from paylane.demo.tables import demo_tables
from paylane.operators import activity, ledger, lookups, tags
from paylane.params import RunParams
from paylane.plans import transaction
from paylane.session import work_dir

SF = "/root/testdata/sf0.001"


def no_folder(master):
    conf = {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__), sparkContext=SimpleNamespace(master=master)
    )


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(no_folder(master), "x")


def test_a_local_master_gets_a_folder_for_the_session():
    spark = no_folder("local[8]")
    assert Path(session.work_dir(spark, "x")).parent == Path(session.work_dir(spark, "y")).parent


def test_scratch_is_removed_after_failures_too(spark):
    for fail in (False, True):
        try:
            with session.scratch(spark, "s") as path:
                stored = session.staged(spark.range(3), "t")
                assert stored.count() == 3 and Path(path.removeprefix("file:")).exists()
                if fail:
                    raise KeyError
        except KeyError:
            assert fail
        assert not Path(path.removeprefix("file:")).exists()


def test_settings_given_twice_are_errors_where_one_is_asked_for(spark, make):
    two = make("env_param", [{"param_key": "CURRENCY_CODE", "param_val_text": v} for v in ("XOF", "EUR")])
    factors = make("system_preference", [{"preference_code": "CURRENCY_FACTOR", "default_value": v} for v in ("1000", "200")])
    networks = make("network", [{"network_code": v} for v in ("CI", "GC")])
    one = spark.range(1)
    assert one.select(lookups.env_value({"env_param": two}, "CURRENCY_CODE").alias("v")).first().v == "XOF"
    moves = spark.createDataFrame(
        [("u", "S", "v", "C", 1)], "sender_user_id string, sender_type string, receiver_user_id string, receiver_type string, amount int"
    ).withColumns({"settled": F.lit("Y"), "transfer_date": F.lit("2000-06-30").cast("timestamp_ntz")})
    for failing in (
        lambda: one.select(lookups.env_setting({"env_param": two}, "CURRENCY_CODE").alias("v")),
        lambda: one.select(lookups.currency_factor({"system_preference": factors}).alias("v")),
        lambda: activity.activity_profile(moves, networks, YEAR.end, 30),
    ):
        with pytest.raises(Exception, match="more than one"):
            failing().collect()
    few = {"system_preference": factors.where("default_value = '200'")}
    assert one.select(lookups.currency_factor(few).cast("int").alias("v")).first().v == 200


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_header_history_is_not_shuffled_for_wallets(spark):
    t = demo_tables(spark, SF)
    moving = ledger.moved_money(ledger.in_run(t["txn_item"], YEAR.ledger_start, YEAR.end), t["txn_header"])
    plan = plan_of(moving)
    final = plan.split("== Initial Plan ==")[0]
    # Between the scan of all headers and the ids there is no exchange.
    for part in final.split("BroadcastHashJoin [transfer_id")[1:]:
        upper = part.split("BroadcastExchange")[0].split("BroadcastQueryStage")[0]
        assert "orders.parquet" not in upper or "Exchange hashpartitioning" not in upper.split("orders.parquet")[0]
    assert "leg-ids" in plan


def test_late_items_are_read_once(spark):
    t = demo_tables(spark, SF)
    plan = plan_of(activity.activity_ledger(t, YEAR))
    assert "late-items" in plan and "header-ids" not in plan


def test_tags_are_found_without_moving_rows(spark):
    """A third of all rows ask for one tag; no row leaves the task that has it, and none is read twice."""
    path = work_dir(spark, "rows")
    spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then 'HOT' else concat('T', id % 500) end as transfer_subtype", "cast(null as string) as a", "repeat('x', 200) as pad"
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    rules = spark.createDataFrame([(1, "HOT", "hot", None), (2, "HOT", "later", None), (1, "T1", "one", "b")], "tag_id int, transfer_subtype string, tag_name string, a string")
    found = tags.match_rules(rows, rules, equal={"a": F.col("a")}, differ={})
    assert found.where("tag_name = 'hot'").count() == 20_000 and found.select("tag_name").distinct().count() == 501
    final = plan_of(found).split("== Initial Plan ==")[0]
    assert final.count(path.rsplit("/", 1)[1][:20]) == 1
    outer = [line for line in final.splitlines() if "BroadcastHashJoin" in line]
    assert len(outer) == 2 and "SortMergeJoin" not in final
    below = final[final.rindex("BroadcastHashJoin") :].split("BroadcastQueryStage")[0]  # from the first join down to the scan
    assert "FileScan" in below and "Exchange" not in below


def test_tagged_ledger_has_no_exchange_of_its_own(spark):
    """Of the wide rows of the ledger nothing is exchanged for their tags."""
    t = demo_tables(spark, SF)
    run = RunParams("CI", "DELTA", YEAR.start, YEAR.end, ledger_days=365)
    plain = plan_of(transaction.ledger(dict(t) | {"tag_rule": t["tag_rule"].where("false")}, run)).split("== Initial Plan ==")[0]
    tagged = plan_of(transaction.ledger(dict(t), run)).split("== Initial Plan ==")[0]
    shuffles = lambda plan: plan.split("BroadcastQueryStage")[0].count("Exchange hashpartitioning")
    assert shuffles(tagged) == shuffles(plain)
