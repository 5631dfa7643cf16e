import hashlib
import os
import random
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paylane.demo.registry import FLAGSHIP, WHOLE, YEAR
from paylane.demo.tables import demo_tables
from paylane.operators import control
from paylane.operators.layout import Field, fixed_width, quoted_pipe, reserved
from paylane.params import RunParams
from paylane.plans import account, country, customer, transaction
from paylane.plans import control as report
from paylane.session import shared_dir
from paylane.sources import file_manifest, load_tables, read_lines, write_lines

SF = "/root/testdata/sf0.001"
JANUARY = replace(FLAGSHIP, mode="DELTA")


@pytest.fixture(scope="module")
def demo(spark):
    return demo_tables(spark, SF)


def parts(path):
    return [line for f in sorted(Path(path).glob("part-*")) for line in f.read_text("utf-8").splitlines()]


def test_run_params():
    p = RunParams.resolve("CI", "delta", end="31/01/2020")
    assert (p.start, p.end, p.ledger_start, p.label) == (datetime(2020, 1, 30), datetime(2020, 1, 31), datetime(2020, 1, 30), "CI_20200130")
    assert RunParams.resolve("CI", "full", "31/01/2020 00:00:00", "01/01/2020").label == "CI_20200131"
    with pytest.raises(ValueError):
        RunParams.resolve("CI", "regen", end="31/01/2020")
    with pytest.raises(ValueError):
        RunParams.resolve("CI", "weekly", end="31/01/2020")


def test_fixed_width_shortens_or_aligns(spark):
    df = spark.createDataFrame([("a", None), (None, "toolong")], "x string, y string")
    layout = [Field("x", F.col("x"), 2), Field("y", F.col("y"), 4), Field("z", F.lit("|"))]
    assert [r.line for r in fixed_width(df, layout).collect()] == ["a |", "tool|"]
    assert [r.line for r in fixed_width(df, layout, pad_nulls=True).collect()] == ["a     |", "  tool|"]


def test_quoted_pipe(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, n int").select("*", *reserved("gap", 1, 2, "int"))
    assert quoted_pipe(df, ["x", "y"], ["n", "gap_01", "gap_02"]).first().line == '"a"|""|1||'
    assert quoted_pipe(df, ["x", "y"], []).first().line == '"a"|""'


def test_line_widths_and_field_counts(demo):
    t = demo
    widths = {
        country.extract_country(t): 134,
        customer.extract_customer(t, YEAR): 434,
        account.extract_account(t, WHOLE): 391,
        transaction.extract_transaction(t, WHOLE): 474,
    }
    for df, width in widths.items():
        found = {r.n for r in df.select(F.length("line").alias("n")).distinct().collect()}
        assert max(found) <= width and width in found, (found, width)
    counts = {
        customer.extract_customer_ext(t, YEAR): 60,
        account.extract_account_ext(t, WHOLE): 64,
        transaction.extract_transaction_ext(t, WHOLE): 67,
    }
    for df, n in counts.items():
        assert [r.n for r in df.select((F.size(F.split("line", "[|]"))).alias("n")).distinct().collect()] == [n]


def test_extension_can_hold_wallets_without_balance(tables):
    from test_ledger import RUN, world

    t = world(tables, wallet_balance=[dict(wallet_number="WA", wallet_sequence_number=0, balance=5), dict(wallet_number="WB", wallet_sequence_number=1)])
    assert [r.account_no for r in account.extract_account(t, RUN).collect()] == [None]
    assert account.extract_account_ext(t, RUN).count() == 3


def test_empty_text_is_missing(spark, tmp_path):
    rows = [("1", "a", "SUBSCRIBER", "", "", "Y")]
    spark.createDataFrame(rows, "wallet_number string, user_id string, user_type string, msisdn string, status string, is_primary string").write.parquet(str(tmp_path / "wallet"))
    for name in ("party", "channel_user"):
        spark.createDataFrame([("a", "SUBSCRIBER", "Y")], "user_id string, user_type string, status string").write.parquet(str(tmp_path / name))

    class Only(dict):
        pass

    from paylane.sources.tables import conform

    t = Only({n: conform(spark.read.parquet(str(tmp_path / n)), n) for n in ("wallet", "party", "channel_user")})
    from paylane.operators.parties import eligible, resolve_parties

    assert resolve_parties(t).first().msisdn is None
    # An empty wallet status is a missing one, and that is not eligible.
    assert eligible(resolve_parties(t)).count() == 0


def test_load_tables_routes(spark, tmp_path, demo):
    for base in ("main", "second"):
        for name in demo:
            rows = demo[name] if base == "main" else demo[name].limit(0)
            if name in ("country", "wallet") or base == "main":
                rows.limit(3).write.parquet(str(tmp_path / base / name))
            else:
                demo[name].limit(0).write.parquet(str(tmp_path / base / name))
    config = {"main": {"base": str(tmp_path / "main")}, "accounts": {"base": str(tmp_path / "second"), "empty_text": False}}
    assert load_tables(spark, config)["wallet"].count() == 3
    assert load_tables(spark, config, "accounts")["wallet"].count() == 0
    assert load_tables(spark, {"main": config["main"]}, "accounts")["wallet"].count() == 3


def test_filters_reach_the_scan(spark, tmp_path, demo):
    demo["txn_item"].write.parquet(str(tmp_path / "txn_item"))
    from paylane.operators import ledger
    from paylane.sources.tables import conform

    items = conform(spark.read.parquet(str(tmp_path / "txn_item")), "txn_item")
    pairs = ledger.pair_legs(ledger.in_run(items, YEAR.start, YEAR.end))
    plan = spark._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "formatted")
    assert "In(transaction_type, [CR,MR,SCR])" in plan and "GreaterThanOrEqual(transfer_date" in plan
    assert "unreg_user_id" not in plan


def test_lines_are_written_in_total_order(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "c"]), f"line {rng.randrange(200)}") for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, line string").repartition(6)
    wanted = [line for _, line in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))]
    for fold in (False, True):
        path = str(tmp_path / f"out{fold}")
        write_lines(df, path, ["k"], fold_copies=fold)
        assert parts(path) == wanted


def test_hot_copies_come_back_in_full(spark, tmp_path):
    df = spark.range(25_000).selectExpr("'k' as k", "case when id % 5 < 4 then 'hot' else concat('cold ', id) end as line")
    path = str(tmp_path / "hot")
    write_lines(df, path, ["k"], fold_copies=True)
    assert sorted(parts(path)) == sorted(r.line for r in df.collect())


def test_manifest_digests(spark, tmp_path):
    path = str(tmp_path / "m")
    write_lines(spark.range(500).selectExpr("concat('é', id) as line"), path, [])
    rows = file_manifest(spark, path).collect()
    assert rows
    for r in rows:
        raw = Path(path, r.file_name).read_bytes()
        assert (r.size_bytes, r.md5) == (len(raw), hashlib.md5(raw).hexdigest())
    assert sorted(r.line for r in read_lines(spark, path).collect()) == sorted(f"é{i}" for i in range(500))


def runs(keys):
    last, n = "", 0
    for k in keys:
        if (k or "").strip() != last.strip():
            n, last = n + 1, k or ""
    return n


@pytest.mark.parametrize("seed", range(4))
def test_run_count_against_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(60), rng.choice(["", " ", "x", "y ", "y", None] if seed else ["", None])) for _ in range(700)]
    rows += [(30, "x")] * 350
    in_order = sorted(rows, key=lambda r: (r[0], (r[1] or "").strip()))
    df = spark.createDataFrame(rows, "o int, k string").repartition(5)
    assert control.run_count(df, F.col("k"), ["o"]).first().n_runs == runs(k for _, k in in_order)


def test_run_count_of_nothing(spark):
    assert control.run_count(spark.range(0).selectExpr("id as o", "'x' as k"), F.col("k"), ["o"]).first().n_runs == 0


def test_freshness(make):
    rows = [("+00 00:30:01", "01/31/2000 11:59:00"), (None, "01/30/2000 11:00:00"), ("+00 00:30:00", "01/31/2000 11:29:59"),
            ("+00 00:30:00", "01/31/2000 11:30:00")]
    stats = make("replica_stat", [dict(name="apply lag", value=v, datum_time=d) for v, d in rows] + [dict(name="transport lag", value="+09 00:00:00")])
    now = F.lit("2000-01-31 12:00:00").cast("timestamp_ntz")
    got = {(r.lag, r.status) for r in control.freshness_status(stats, now).collect()}
    assert got == {("+00 00:30:01", "DELAY"), (None, " Critical Data Broken status"), ("+00 00:30:00", "DELAY"), ("+00 00:30:00", "OK")}
    row = report.lag_row(stats, now).first()
    assert row.control == "Synchronization DBREF"


def test_full_run(spark, tmp_path, demo):
    base = tmp_path / "lake"
    for name in demo:
        demo[name].write.parquet(str(base / name))
    config = {"main": {"base": str(base), "empty_text": False}}
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("*"))
    done = report.run(spark, config, JANUARY, str(tmp_path / "out"), "Here", "1.0", datetime(2020, 1, 1), check_replica=False)
    assert set(shared.glob("*")) == before  # what was stored on the way is gone
    written, rows = done.written, done.rows
    printed = parts(done.report_path)
    assert printed[0] == "Generation Date;01/01/2020 00:00:00" and printed[3] == "Country;Here"
    assert [x.split(";")[0] for x in printed[-8:]] == [*report.OUTPUTS, report.DIGESTS]
    assert [w.name for w in written] == list(report.OUTPUTS)
    for w, r in zip(written, rows.orderBy("position").collect()):
        lines = parts(w.path)
        assert (r.output, r.n_lines) == (w.name, len(lines))
        assert r.size_bytes == sum(os.path.getsize(f) for f in Path(w.path).glob("part-*"))
        key = {"in_country": lambda x: None, "in_customer": lambda x: x.split(" ")[0][4:13], "in_account": lambda x: x.split(" ")[0][4:13],
               "in_customer_extension_hist": lambda x: x.split("|")[1][1:10], "in_account_extension_hist": lambda x: x.split("|")[1][1:10],
               "in_transaction": lambda x: x.split("XOF")[1][:29],
               "in_transaction_extension": lambda x: x.split("|")[7][1:9] + x.split("|")[8][1:14]}[w.name]
        assert r.n_distinct == (len(lines) if w.name == "in_country" else runs(key(x) for x in lines)), w.name
    assert len(parts(written[5].path)) > 0
    header = {r.name: r.value for r in report.run_header(spark, JANUARY, "Here", "1.0", 61.0, datetime(2020, 1, 1)).collect()}
    assert header["Duration of treatment"] == "0:01:01" and header["Data of"] == "01/01/2000"
    lag = report.lag_row(demo["replica_stat"].limit(0), F.lit("2000-01-31 12:00:00").cast("timestamp_ntz"))
    text = [r.line for r in report.report_lines(report.run_header(spark, JANUARY, "Here", "1.0", 61.0, datetime(2020, 1, 1)), lag, rows).collect()]
    assert text[0] == "Generation Date;01/01/2020 00:00:00" and text[4] == "Duration of treatment;0:01:01;"
    assert text[6:8] == ["", "Control;Date;Lag"]
    assert [x.split(";")[0] for x in text[-8:]] == [*report.OUTPUTS, report.DIGESTS] and all(x.endswith(";") for x in text[-8:-1])
    # The digests: a line per file, and a report row that ends with their size.
    digests = dict(reversed(x.split("  ")) for x in parts(done.digests.path))
    files = {f"{w.name}/{f.name}": hashlib.md5(f.read_bytes()).hexdigest() for w in written for f in Path(w.path).glob("part-*")}
    size = sum(f.stat().st_size for f in Path(done.digests.path).glob("part-*"))
    assert digests == files and text[-1].split(";")[3:] == [str(size)]
    # Counts come from the writing: without them they are read, and are the same.
    again = report.control_report(spark, [w._replace(counts=None) for w in written], report.account_currency_of(demo))
    counts = lambda table: [(r.output, r.n_lines, r.n_distinct) for r in table.where("n_lines is not null").orderBy("position").collect()]
    assert counts(again) == counts(rows) and all(w.counts is not None for w in written)
    plain = report.control_report(spark, written)._jdf.queryExecution().toString()
    assert "FileScan text" not in plain and "Relation [value" not in plain
