"""Lookups by id: the same rows as a join, and row groups read that grow with the ids, not with the table."""

import pytest
from pyspark.sql import functions as F

from paylane.demo import registry
from paylane.demo.registry import YEAR, demo_tables, tables_by_id
from paylane.operators import ledger
from paylane.plans import account, customer
from paylane.session import work_dir
from paylane.sources import append_by_id, by_id, rows_of

SF = "/root/testdata/sf0.001"


def scanned(df):
    """Rows that the file scans of an executed plan gave out."""
    df.collect()
    found = []

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        if kind == "FileSourceScanExec":
            found.append(plan.metrics().apply("numOutputRows").value())
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


@pytest.fixture(scope="module")
def table(spark):
    """20,000 ids with two rows each in batches that came in turn, and one id with 5,000 rows."""
    def rows(first, last):
        return spark.range(first, last).selectExpr("concat(if(id % 2 = 0, 'CI', 'PP'), lpad(string(id div 4), 6, '0')) as transfer_id", "id as v", "repeat('x', int(id % 50)) as pad")

    path = work_dir(spark, "by-id")
    hot = spark.range(5000).selectExpr("'HOT' as transfer_id", "id as v", "'' as pad")
    none = spark.range(3).selectExpr("string(null) as transfer_id", "id as v", "'' as pad")
    append_by_id(rows(0, 20_000).unionByName(hot).unionByName(none), path, row_group_bytes=40_000, ids_per_group=5000)
    append_by_id(rows(20_000, 40_000), path, row_group_bytes=40_000, ids_per_group=5000)
    return spark.read.parquet(path)


def ids_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "transfer_id string")


def test_rows_are_those_of_a_join(spark, table, monkeypatch):
    wanted = ["CI000007", "CI000007", "PP004321", "HOT", "nothing", None, "CI009999"]
    want = sorted(r.v for r in table.join(ids_of(spark, wanted).distinct(), "transfer_id", "left_semi").collect())
    assert len(want) == 5000 + 3 * 2
    assert sorted(r.v for r in rows_of(table, ids_of(spark, wanted)).collect()) == want
    monkeypatch.setattr(by_id, "IDS_BY_VALUE", 2)
    assert sorted(r.v for r in rows_of(table, ids_of(spark, wanted)).collect()) == want  # three lots
    monkeypatch.setattr(by_id, "LOTS", 1)
    assert sorted(r.v for r in rows_of(table, ids_of(spark, wanted)).collect()) == want  # past spans, by join
    assert rows_of(table, ids_of(spark, [])).count() == 0 and rows_of(table, ids_of(spark, [None])).count() == 0


def test_what_is_read_grows_with_the_ids(spark, table):
    total = table.count()
    read = {n: scanned(rows_of(table, ids_of(spark, [f"CI{i * 9973 % 10_000:06d}" for i in range(n)]))) for n in (1, 4, 16)}
    assert read[1] <= total / 10 and read[4] <= 4.5 * read[1] and read[16] <= 16.5 * read[1] and read[16] < 0.7 * total
    near = scanned(rows_of(table, ids_of(spark, [f"CI{i:06d}" for i in range(3000, 3300)])))
    assert near <= total / 5
    assert scanned(rows_of(table, ids_of(spark, ["absent", "CI0", "PP9999999"]))) == 0


def test_many_neighbouring_ids_are_read_by_their_spans(spark, table, monkeypatch):
    monkeypatch.setattr(by_id, "LOTS", 0)
    near = [f"{kind}{i:06d}" for kind in ("CI", "PP") for i in range(3000, 3300)]
    found = rows_of(table, ids_of(spark, near))
    assert found.count() == 1200 and scanned(found) <= table.count() / 3


def test_a_hot_id_lies_in_several_files(table):
    files = table.where("transfer_id = 'HOT'").select(F.input_file_name().alias("f")).distinct()
    assert table.where("transfer_id = 'HOT'").count() == 5000 and files.count() >= 1


def test_late_items_and_wallets_without_the_history(spark):
    """A growing history leaves what is read for some late headers as it is."""
    t = tables_by_id(spark, SF)
    late = ledger.late_headers(t["txn_header"], YEAR.start, YEAR.end).limit(5)
    few = ledger.items_of(t["txn_item"], late, t["txn_item.by_id"])
    assert few.count() == ledger.items_of(t["txn_item"], late).count() > 0
    plain = demo_tables(spark, SF)
    assert sorted(account.moving_wallets(t, YEAR).collect()) == sorted(account.moving_wallets(plain, YEAR).collect())
    for name in ("j_activity", "j_unregistered", "c_account", "c_account_ext"):
        assert sorted(map(str, registry.BUILDERS[name](t).collect())) == sorted(map(str, registry.BUILDERS[name](plain).collect())), name
    assert customer.run_users(t, YEAR).count() == customer.run_users(plain, YEAR).count()


def test_copies_of_the_payments_tables_are_built_when_asked_for(spark, monkeypatch):
    written, append = [], registry.append_by_id
    monkeypatch.setattr(registry, "append_by_id", lambda rows, path: written.append(path.rsplit("/", 1)[1]) or append(rows, path))
    found = registry.j_active_wallets_by_id(spark, "/root/testdata/sf0.001")
    assert written == ["txn_header"] and found.count() > 0
    registry.t_late_by_id(spark, "/root/testdata/sf0.001")
    assert written == ["txn_header", "txn_item"]


def test_spans_are_not_tested_on_what_the_rows_are_joined_to(spark, monkeypatch):
    monkeypatch.setattr(by_id, "IDS_BY_VALUE", 10)
    path = work_dir(spark, "spans")
    ids = spark.range(1000).select(F.format_string("CI%06d", "id").alias("transfer_id"))
    append_by_id(ids, path)
    found = rows_of(spark.read.schema(ids.schema).parquet(path), ids.where("transfer_id < 'CI000500'"))
    other = spark.range(2000).select(F.format_string("CI%06d", "id").alias("transfer_id"), "id")
    joined = other.join(found, "transfer_id", "left_semi")
    tests = [x for x in joined._jdf.queryExecution().optimizedPlan().toString().splitlines() if ">=" in x]
    assert tests and not [x for x in tests if "format_string" in x]
    assert joined.count() == 500
