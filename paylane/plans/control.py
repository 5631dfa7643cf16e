"""Control report of a run, and the run itself."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import duration_text
from ..functions.dates import moment
from ..operators.control import FRESH, control_counts, freshness_status
from ..operators.geography import account_currency
from ..operators.ledger import late_items
from ..operators.legs import Legs
from ..operators.lookups import env_value
from ..operators.recency import ActivityMasks
from ..params import RunParams
from ..session import prepare, scratch, staged
from ..sources import file_manifest, load_tables, read_lines, write_lines
from ..sources.lines import Counts, file_totals, named_digests
from . import account, country, customer, transaction

# Output names in report order, and the slices of a line that count as its key (from, length):
# of the text before the first blank, of one pipe field, of two pipe fields, or after the account currency.
OUTPUTS = (
    "in_country",
    "in_customer",
    "in_customer_extension_hist",
    "in_account",
    "in_account_extension_hist",
    "in_transaction",
    "in_transaction_extension",
)
ACCOUNT_PART = 46
DIGESTS = "control_digests"


def _first_word_slice(line: Column) -> Column:
    return F.substring(F.substring_index(line, " ", 1), 5, 9)


def _pipe_slice(line: Column, field: int, length: int) -> Column:
    return F.substring(F.split_part(line, F.lit("|"), F.lit(field)), 2, length)


def run_keys(currency: Column | None = None) -> dict[str, Column | None]:
    """Key of each output's lines. ``currency`` is the account currency, printed at its own length before the dates."""
    line = F.col("line")
    width = F.lit(3) if currency is None else F.coalesce(F.length(currency), F.lit(0))
    return {
        "in_country": None,
        "in_customer": _first_word_slice(line),
        "in_customer_extension_hist": _pipe_slice(line, 2, 9),
        "in_account": _first_word_slice(line),
        "in_account_extension_hist": _pipe_slice(line, 2, 9),
        "in_transaction": F.substr(line, F.lit(ACCOUNT_PART + 1) + width, F.lit(29)),
        "in_transaction_extension": F.concat(_pipe_slice(line, 8, 8), _pipe_slice(line, 9, 13)),
    }


class Written(NamedTuple):
    """One written output: where it is, how long its extraction took, and what was counted while it was written."""

    name: str
    path: str
    seconds: float
    counts: Counts | None = None


def control_report(spark: SparkSession, outputs: list[Written], currency: Column | None = None) -> DataFrame:
    """One row per output: extraction time, end (UTC), size in bytes, lines, and lines counted once per key run.

    Outputs that were not counted as they were written (``counts`` is None) are read for it.
    """
    keys = run_keys(currency)
    rows = None
    for position, out in enumerate(outputs):
        if out.counts is None:
            counts = control_counts(read_lines(spark, out.path), keys[out.name])
        else:
            known = [F.lit(n).cast("long").alias(c) for n, c in zip(out.counts, ("n_lines", "n_distinct"))]
            counts = spark.range(1).select(*known)
        totals = file_totals(spark, out.path)
        row = counts.select(
            F.lit(position).alias("position"),
            F.lit(out.name).alias("output"),
            duration_text(F.lit(out.seconds)).alias("extraction_time"),
            totals.select("finished_at").scalar().alias("finished_at"),
            totals.select("size_bytes").scalar().alias("size_bytes"),
            "n_lines",
            "n_distinct",
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def run_header(spark: SparkSession, p: RunParams, affiliate: str, version: str, seconds: float, generated: datetime) -> DataFrame:
    """Name and value rows that open the report. Times are UTC."""
    pairs = [
        ("Generation Date", f"{generated:%d/%m/%Y %H:%M:%S}"),
        ("Data of", f"{p.start:%d/%m/%Y}"),
        ("Timezone", "UTC"),
        ("Country", affiliate),
        ("Compliance Package Version", version),
    ]
    took = duration_text(F.lit(seconds))
    values = [(name, F.lit(value)) for name, value in pairs]
    values.insert(4, ("Duration of treatment", took))
    entries = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), v.alias("value")) for i, (n, v) in enumerate(values)]
    return spark.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def lag_row(stats: DataFrame, now: Column) -> DataFrame:
    """The synchronisation row of the report: when it was checked, the verdict and the lag."""
    return freshness_status(stats, now).select(
        F.lit("Synchronization DBREF").alias("control"), now.alias("checked_at"), "status", "lag"
    )


# Separator and the two column headings of the printed report.
SEPARATOR = ";"
CONTROL_HEADING = ("Control", "Date", "Lag")
OUTPUT_HEADING = ("Extraction", "Extraction time", "End of the extraction", "File size", "Nb of lines", "Nb of distinct lines")
# Header rows that the report closes with a separator.
CLOSED_ROWS = ("Duration of treatment", "Compliance Package Version")


def report_lines(header: DataFrame, lag: DataFrame, rows: DataFrame) -> DataFrame:
    """The report as text lines in order: header, synchronisation, outputs. A few dozen rows."""
    spark = header.sparkSession

    def fixed(section: int, place: int, text: str) -> DataFrame:
        return spark.range(1).select(F.lit(section).alias("section"), F.lit(place).alias("place"), F.lit(text).alias("line"))

    def stamp(c: str) -> Column:
        return F.date_format(F.col(c), "dd/MM/yyyy HH:mm:ss")

    end = F.when(F.col("name").isin(*CLOSED_ROWS), SEPARATOR).otherwise("")
    top = header.select(F.lit(0).alias("section"), F.col("position").alias("place"), F.concat("name", F.lit(SEPARATOR), "value", end).alias("line"))
    control = lag.select(
        F.lit(1).alias("section"), F.lit(2).alias("place"), F.concat_ws(SEPARATOR, "control", stamp("checked_at"), F.coalesce("lag", F.lit(""))).alias("line")
    )
    fields = ["output", "extraction_time", stamp("finished_at"), F.col("size_bytes").cast("string")]
    counts = [F.col(c).cast("string") for c in ("n_lines", "n_distinct")]
    # Without counts, as of the digests, a row ends with its size.
    text_of = F.when(F.col("n_lines").isNull(), F.concat_ws(SEPARATOR, *fields)).otherwise(F.concat_ws(SEPARATOR, *fields, *counts, F.lit("")))
    body = rows.select(F.lit(2).alias("section"), (F.col("position") + 3).alias("place"), text_of.alias("line"))
    text = top
    for part in (
        fixed(1, 0, ""),
        fixed(1, 1, SEPARATOR.join(CONTROL_HEADING)),
        control,
        fixed(2, 0, ""),
        fixed(2, 1, ""),
        fixed(2, 2, SEPARATOR.join(OUTPUT_HEADING)),
        body,
    ):
        text = text.unionByName(part)
    return text.orderBy("section", "place").select("line")


class Extract(NamedTuple):
    """How an output is made: its lines with their sort columns, those columns, and whether very many lines may be equal."""

    name: str
    build: Callable[[], DataFrame]
    order: list[str]
    fold_copies: bool = False


def extracts(main: dict[str, DataFrame], accounts: dict[str, DataFrame], p: RunParams, masks: DataFrame | None = None) -> list[Extract]:
    """The seven extracts in report order. What two of them start from is stored once, when the first is built.

    ``masks``: the days that users were active on, where the lake keeps them.
    """
    shared: dict[str, DataFrame] = {}

    def once(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in shared:
            shared[name] = staged(build(), name)
        return shared[name]

    def late() -> DataFrame:
        if "late" not in shared:
            shared["late"] = late_items(main, p.start, p.end)
        return shared["late"]

    window: dict[str, Legs] = {}

    def legs(name: str, tables: dict[str, DataFrame]) -> Legs:
        """The window's legs of one source, stored when first asked for; one source's serve all extracts."""
        name = "main" if tables is main else name
        if name not in window:
            window[name] = transaction.ledger_legs(tables, p)
        return window[name]

    users = lambda: once("users", lambda: customer.run_users(main, p, masks))
    wallets = lambda: once("wallets", lambda: account.moving_wallets(accounts, p, legs("accounts", accounts)))
    base = lambda: once("tagged", lambda: transaction.ledger(main, p, legs=legs("main", main)))
    makers = (
        Extract(OUTPUTS[0], lambda: country.extract_country(main), country.ORDER),
        Extract(OUTPUTS[1], lambda: customer.extract_customer(main, p, users(), late()), customer.ORDER),
        Extract(OUTPUTS[2], lambda: customer.extract_customer_ext(main, p, users(), late()), customer.ORDER),
        Extract(OUTPUTS[3], lambda: account.extract_account(accounts, p, wallets()), account.ORDER),
        Extract(OUTPUTS[4], lambda: account.extract_account_ext(accounts, p, wallets()), account.ORDER),
        Extract(OUTPUTS[5], lambda: transaction.extract_transaction(main, p, base()), transaction.ORDER, fold_copies=True),
        Extract(OUTPUTS[6], lambda: transaction.extract_transaction_ext(main, p, base()), transaction.ORDER, fold_copies=True),
    )
    return list(makers)


def write_extracts(
    spark: SparkSession,
    main: dict[str, DataFrame],
    accounts: dict[str, DataFrame],
    p: RunParams,
    out_dir: str,
    only: tuple[str, ...] = OUTPUTS,
    masks: DataFrame | None = None,
) -> list[Written]:
    """Write the outputs named in ``only``, each to its own folder. What was stored on the way is removed at the end."""
    written, keys = [], run_keys(account_currency_of(main))
    with scratch(spark, "extracts"):
        for x in extracts(main, accounts, p, masks):
            if x.name not in only:
                continue
            began = datetime.now(timezone.utc)
            path = f"{out_dir.rstrip('/')}/{p.label}/{x.name}"
            counts = write_lines(x.build(), path, x.order, fold_copies=x.fold_copies, key=keys[x.name])
            written.append(Written(x.name, path, (datetime.now(timezone.utc) - began).total_seconds(), counts))
    return written


class StaleReplica(RuntimeError):
    """The replica is behind, or cannot tell; nothing was extracted."""


def require_fresh(stats: DataFrame, now: Column) -> None:
    """Raise unless the replica's samples all say that it is fresh, and there is one."""
    verdicts = [r["status"] for r in freshness_status(stats, now).select("status").distinct().collect()]  # three at most
    if verdicts != [FRESH]:
        raise StaleReplica(f"replica not fresh: {', '.join(v.strip() for v in sorted(verdicts)) or 'no sample'}")


def write_digests(spark: SparkSession, written: list[Written], path: str) -> Written:
    """One line per part file of the outputs: its MD5 and its name, in order of outputs and files."""
    began = datetime.now(timezone.utc)
    rows = []
    for out in written:
        if out.counts is None:  # not digested as it was written
            files = sorted((r["file_name"], r["md5"]) for r in file_manifest(spark, out.path).select("file_name", "md5").collect())
        else:
            files = [(name, md5) for name, md5, _ in named_digests(spark, out.path, out.counts.digests)]
        rows += [(len(rows) + n, f"{md5}  {out.name}/{name}") for n, (name, md5) in enumerate(files)]  # one a file
    lines = spark.createDataFrame(rows, "place int, line string")
    lines.coalesce(1).sortWithinPartitions("place").select("line").write.mode("overwrite").text(path)
    return Written(DIGESTS, path, (datetime.now(timezone.utc) - began).total_seconds())


def digest_row(spark: SparkSession, digests: Written, position: int) -> DataFrame:
    """The report's row for the digests: time taken, end and size; lines are not reported for them."""
    return file_totals(spark, digests.path).select(
        F.lit(position).alias("position"),
        F.lit(digests.name).alias("output"),
        duration_text(F.lit(digests.seconds)).alias("extraction_time"),
        "finished_at",
        "size_bytes",
        F.lit(None).cast("long").alias("n_lines"),
        F.lit(None).cast("long").alias("n_distinct"),
    )


class Run(NamedTuple):
    """What a run leaves: the outputs, their digests, and its report as rows and as written text lines."""

    written: list[Written]
    digests: Written
    header: DataFrame
    lag: DataFrame
    rows: DataFrame
    report_path: str


def run(
    spark: SparkSession,
    config: dict,
    p: RunParams,
    out_dir: str,
    affiliate: str = "",
    version: str = "",
    now: datetime | None = None,
    check_replica: bool = True,
) -> Run:
    """Write all extracts of a run below ``out_dir``, digests of their files, and its control report beside them.

    Any failure is raised. A replica that is not fresh fails the run before the first extract, unless ``check_replica`` is off,
    as it is for a source that is no replica. ``now`` (UTC) dates the report and is what the replica's freshness is judged by;
    the clock's time if it is not given. ``config["activity_masks"]`` names the folder of activity masks, if they are kept.
    """
    prepare(spark)
    began = datetime.now(timezone.utc)
    main = load_tables(spark, config, "main")
    accounts = load_tables(spark, config, "accounts") if "accounts" in config else main
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    if check_replica:
        require_fresh(main["replica_stat"], moment(now))
    masks = None
    if config.get("activity_masks") and customer.masks_serve(p):
        masks = ActivityMasks(spark, config["activity_masks"]).up_to(main, p.end - timedelta(days=1))
    written = write_extracts(spark, main, accounts, p, out_dir, masks=masks)
    base = f"{out_dir.rstrip('/')}/{p.label}"
    digests = write_digests(spark, written, f"{base}/{DIGESTS}")
    seconds = (datetime.now(timezone.utc) - began).total_seconds()
    header = run_header(spark, p, affiliate, version, seconds, now)
    lag = lag_row(main["replica_stat"], moment(now))
    rows = control_report(spark, written, account_currency_of(main)).unionByName(digest_row(spark, digests, len(written)))
    path = f"{base}/control_report"
    report_lines(header, lag, rows).coalesce(1).write.mode("overwrite").text(path)  # a few dozen lines
    return Run(written, digests, header, lag, rows, path)


def account_currency_of(t: dict[str, DataFrame]) -> Column:
    return account_currency(env_value(t, "CURRENCY_CODE"))
