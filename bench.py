"""Time the headline queries and print one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Seconds count plan building (with what a query stores while it is built) and the run; ``build`` is the first part of them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from paylane.demo import registry
from paylane.demo.tables import demo_tables
from paylane.session import prepare, scratch, work_dir
from paylane.sources import BY_ID, append_by_id, load_tables

HEADLINE = (
    "j_pair_legs",
    "w_total_charge",
    "j_active_wallets",
    "j_parties",
    "j_ledger",
    "j_tags",
    "t_geography",
    "u_two_sided",
    "c_active_users",
    "j_reactivated",
    "j_activity",
    "c_country",
    "c_customer_delta",
    "c_customer_fullactive",
    "c_customer_ext",
    "c_account",
    "c_account_ext",
    "c_transaction",
    "c_transaction_ext",
    "w_run_count",
)


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The payments tables written once and read as a run reads them, so that no query derives them again.

    Items and headers are kept in order of transfer id as well, as a lake would keep them.
    """
    base = work_dir(spark, "lake")
    for name, table in demo_tables(spark, sf_dir).items():
        table.write.parquet(f"{base}/{name}")
    tables = load_tables(spark, {"main": {"base": base, "empty_text": False}})
    for name in BY_ID:
        append_by_id(tables[name], f"{base}/by_id/{name}")
    return load_tables(spark, {"main": {"base": base, "empty_text": False, "by_id": f"{base}/by_id"}})


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites of each column expression are for error messages only, and cost plan-building time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = stored_tables(prepare(spark), sf_dir)
    registry.BUILDERS["j_active_wallets"](tables).write.format("noop").mode("overwrite").save()
    build, seconds = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        with scratch(spark, "bench"):
            began = time.perf_counter()
            result = registry.BUILDERS[name](tables)
            built = time.perf_counter()
            result.write.format("noop").mode("overwrite").save()
            build[name], seconds[name] = round(built - began, 3), round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "build": build, "sf": os.path.basename(sf_dir.rstrip("/"))}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
