"""The freshness gate, counts while writing, splits of database tables."""

import hashlib
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paylane.plans import control as report
from paylane.sources import splits, write_lines
from paylane.sources.lines import named_digests
from tests.test_extracts import JANUARY, parts, runs

NOW = datetime(2000, 1, 31, 12)
FRESH = dict(name="apply lag", value="+00 00:00:05", datum_time="01/31/2000 11:59:00")


def test_a_stale_replica_stops_the_run_before_it_writes(spark, make, tables, tmp_path, monkeypatch):
    for stats, why in (
        ([dict(FRESH, value="+00 00:30:01")], "DELAY"), ([dict(FRESH, value=None)], "Critical Data Broken"), ([dict(FRESH, datum_time="01/31/2000 11:00:00")], "DELAY"),
        ([], "no sample"), ([FRESH, dict(FRESH, value="+01 00:00:00")], "DELAY, OK"), ([dict(FRESH, name="transport lag")], "no sample"),
    ):
        monkeypatch.setattr(report, "load_tables", lambda *_, stats=stats: tables(replica_stat=stats))
        with pytest.raises(report.StaleReplica, match=why):
            report.run(spark, {}, JANUARY, str(tmp_path / "out"), now=NOW)
        assert not (tmp_path / "out").exists()
    monkeypatch.setattr(report, "load_tables", lambda *_: tables(replica_stat=[dict(FRESH, value=None)]))
    off = report.run(spark, {}, JANUARY, str(tmp_path / "off"), now=NOW, check_replica=False)
    monkeypatch.setattr(report, "load_tables", lambda *_: tables(replica_stat=[FRESH]))
    done = report.run(spark, {}, JANUARY, str(tmp_path / "on"), now=NOW)
    assert len(off.written) == len(done.written) == 7 and Path(done.report_path).exists()


@pytest.mark.parametrize("fold", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_counts_are_taken_while_lines_are_written(spark, tmp_path, seed, fold):
    rng = random.Random(seed)
    rows = [(rng.randrange(80), f"{rng.choice(['', ' ', 'x', 'y ', 'y'])}|{rng.randrange(3)}") for _ in range(900)] + [(40, "x|hot")] * 500
    path = str(tmp_path / "out")
    key = F.split_part(F.col("line"), F.lit("|"), F.lit(1))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several partitions, so edges meet
    try:
        counts = write_lines(spark.createDataFrame(rows, "k int, line string").repartition(5), path, ["k"], fold_copies=fold, copies_per_slice=7, key=key)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    lines = parts(path)
    assert len(list(Path(path).glob("part-*"))) > 3
    assert counts[:2] == (len(rows), runs(x.split("|")[0] for x in lines)) and sorted(lines) == sorted(x for _, x in rows)


def test_counts_of_nothing_and_without_a_key(spark, tmp_path):
    empty = spark.createDataFrame([], "k int, line string")
    nothing = [write_lines(empty, str(tmp_path / "a"), ["k"], key=F.col("line")), write_lines(empty, str(tmp_path / "b"), ["k"], fold_copies=True)]
    assert [c[:2] for c in nothing] == [(0, 0)] * 2
    three = spark.createDataFrame([(1, "a", 2), (2, "b", 1)], "k int, line string, copies long")
    assert write_lines(three, str(tmp_path / "c"), ["k"])[:2] == (3, 3) and parts(str(tmp_path / "c")) == ["a", "a", "b"]


@pytest.mark.parametrize("fold", [False, True])
def test_files_are_digested_while_they_are_written(spark, tmp_path, fold):
    """Files of several splits and of seven lines, hot copies over file borders, letters of several bytes."""
    rows = [(i % 13, f"é {i % 31} 你") for i in range(400)] + [(5, "hot")] * 300
    df = spark.createDataFrame(rows, "k int, line string").repartition(4)
    for most in (7, 10_000):
        path = str(tmp_path / f"out{most}")
        counts = write_lines(df, path, ["k"], fold_copies=fold, lines_per_file=most, copies_per_slice=11)
        files = {f.name: f.read_bytes() for f in Path(path).glob("part-*")}
        want = sorted((name, hashlib.md5(raw).hexdigest(), len(raw)) for name, raw in files.items() if raw)
        assert [x for x in named_digests(spark, path, counts.digests) if x[2]] == want and len(want) >= len(rows) // most


def test_predicates_cover_every_key_once_in_even_shares():
    import duckdb

    rng = random.Random(6)
    con = duckdb.connect()
    for trial in range(30):
        keys = [rng.choice([None, "", "o'k", *(f"{rng.choice('ABCDE')}{int(rng.paretovariate(0.7)) % 500:03d}" for _ in range(6))]) for _ in range(rng.choice([0, 1, 400]))]
        con.execute("create or replace table t (k varchar)")
        con.executemany("insert into t values (?)", [(k,) for k in keys]) if keys else None
        histogram = con.execute(f"select * from {splits.histogram_query('t', 'k', 3)}").fetchall()
        parts = rng.choice([1, 3, 8])
        made = splits.balanced_predicates(histogram, "k", parts)
        sizes = [con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in made]
        assert len(made) <= parts and sum(sizes) == len(keys)
        hits = con.execute(f"select {' + '.join(f'(coalesce({p}, false))::int' for p in made)} as n from t").fetchall()
        assert all(n == 1 for (n,) in hits)
        largest = max((n for _, n in histogram), default=0)
        missing = sum(k is None for k in keys)
        assert max(sizes) <= len(keys) / parts + largest + missing + 1
