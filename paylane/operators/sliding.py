"""Activity totals over the last days, kept up from daily partials.

A day's partial holds, per user, type and side, the sum of amounts and the last transfer. Sums could be taken off again when a day
leaves the window, greatest dates cannot; so the window is kept as two stacks. The older days lie in tables of their own,
each the total from that day up to a common border; the newer ones in one running total behind the border. A window is the
older table of its first day and the running total, two tables however long it is. When the first day passes the border, the
border moves to the last day and the older tables are built anew from the daily partials, once per window length.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import moment
from ..session import file_names, remove_dir
from .activity import profile_of, side_events

KEYS = ("user_id", "user_type", "side")
SCHEMA = "user_id string, user_type string, side string, amount decimal(38,6), transfer_date timestamp_ntz"


def merged(events: DataFrame) -> DataFrame:
    """Partials of any events or partials: both are sums and maxima by key, null keys included."""
    sums = events.groupBy(*KEYS).agg(F.sum("amount").alias("amount"), F.max("transfer_date").alias("transfer_date"))
    return sums.select(*KEYS, F.col("amount").cast("decimal(38,6)").alias("amount"), "transfer_date")


def day_partial(ledger: DataFrame, day: datetime) -> DataFrame:
    """The partial of one day's settled transfers."""
    own = (F.col("transfer_date") >= moment(day)) & (F.col("transfer_date") < moment(day + timedelta(days=1)))
    return merged(side_events(ledger.where((F.col("settled") == "Y") & own)))


class SlidingTotals:
    """Partials and totals below a folder, for a window of ``days`` days.

    Days are added in order; one that comes later or again (late changes) replaces its partial, and the totals are built anew. A table counts once its success mark is there, so a run that died is repeated without harm.
    """

    def __init__(self, spark: SparkSession, path: str, days: int):
        self.spark, self.path, self.days = spark, path.rstrip("/"), days

    def _tables(self, folder: str) -> list[str]:
        return [n for n in file_names(self.spark, f"{self.path}/{folder}") if "_SUCCESS" in file_names(self.spark, f"{self.path}/{folder}/{n}")]

    def _read(self, *names: str) -> DataFrame:
        paths = [f"{self.path}/{n}" for n in names]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def _write(self, table: DataFrame, name: str) -> None:
        table.write.mode("overwrite").parquet(f"{self.path}/{name}")

    @staticmethod
    def _name(day: datetime) -> str:
        return f"{day:%Y%m%d}"

    def known_days(self) -> list[datetime]:
        return sorted(datetime.strptime(n, "%Y%m%d") for n in self._tables("daily"))

    def add(self, day: datetime, partial: DataFrame) -> None:
        """Take in a day. Skipped days count as days without transfers."""
        again = any(day <= known for known in self.known_days())
        self._write(partial, f"daily/{self._name(day)}")
        if again:
            for folder in ("older", "newer"):
                remove_dir(self.spark, f"{self.path}/{folder}")

    def _daily(self, first: datetime, last: datetime) -> list[str]:
        return [f"daily/{self._name(d)}" for d in self.known_days() if first <= d <= last]

    def _border(self, first: datetime, last: datetime) -> datetime | None:
        """The latest border whose older tables are complete and reach back to ``first``, at or before ``last``."""
        for name in reversed(file_names(self.spark, f"{self.path}/older")):
            border = datetime.strptime(name, "%Y%m%d")
            if first <= border <= last and self._name(first) in self._tables(f"older/{name}"):
                return border
        return None

    def _new_border(self, border: datetime, first: datetime) -> None:
        """Older tables up to ``border``, from the last day backwards: each the next one and one more day."""
        total: list[str] = []
        for back in range((border - first).days + 1):
            day = border - timedelta(days=back)
            name = f"older/{self._name(border)}/{self._name(day)}"
            self._write(merged(self._read(*total, *self._daily(day, day))), name)
            total = [name]

    def window(self, last: datetime) -> DataFrame:
        """Partials of the window that ends with day ``last``, both taken in."""
        first = last - timedelta(days=self.days - 1)
        border = self._border(first, last)
        if border is None:
            border = last
            self._new_border(border, first)
        parts = [f"older/{self._name(border)}/{self._name(first)}"]
        if border < last:
            parts.append(self._newer(border, last))
        return merged(self._read(*parts))

    def _newer(self, border: datetime, last: datetime) -> str:
        """The running total of the days after ``border``: the one before it and what has come since."""
        folder = f"newer/{self._name(border)}"
        known = [n for n in self._tables(folder) if n <= self._name(last)]
        if known and known[-1] == self._name(last):
            return f"{folder}/{known[-1]}"
        before = [f"{folder}/{known[-1]}"] if known else []
        since = datetime.strptime(known[-1], "%Y%m%d") if known else border
        self._write(merged(self._read(*before, *self._daily(since + timedelta(days=1), last))), f"{folder}/{self._name(last)}")
        return f"{folder}/{self._name(last)}"

    def forget(self, before: datetime) -> None:
        """Remove daily partials of days before, and older and newer tables of borders before."""
        for folder in ("daily", "older", "newer"):
            for name in file_names(self.spark, f"{self.path}/{folder}"):
                if name < self._name(before):
                    remove_dir(self.spark, f"{self.path}/{folder}/{name}")


def sliding_profile(totals: SlidingTotals, network: DataFrame, end: datetime) -> DataFrame:
    """``activity_profile`` of the window that ends before ``end``, from the kept totals alone."""
    return profile_of(totals.window(end - timedelta(days=1)), network)


def add_days(totals: SlidingTotals, ledger: DataFrame, days: Iterable[datetime]) -> None:
    """Take in days from a ledger that covers them."""
    for day in days:
        totals.add(day, day_partial(ledger, day))
