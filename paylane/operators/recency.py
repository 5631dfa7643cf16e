"""Which of the last days a user was active on, kept as bits and moved on a day at a time.

A row holds a user, a phone and two words of bits; bit k stands for the day that lies k days back, counted from the last day that
was taken in. Moving on shifts the bits, drops rows without any, and sets those of the new days, read from these days'
items alone. So the cohorts of a run (active of late, reactivated) need neither the days before it nor a join: they are tests
of bits.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import moment
from ..session import file_names, remove_dir
from .cohorts import _comparable, active_items

WORD = 62
DAYS = 2 * WORD
SCHEMA = "user_id string, msisdn string, recent long, older long"
FULL = (1 << WORD) - 1


def shifted(days: int) -> tuple[Column, Column]:
    """``recent`` and ``older`` so many days later."""
    recent, older = F.col("recent"), F.col("older")
    zero = F.lit(0).cast("long")
    if days >= DAYS:
        return zero, zero
    if days >= WORD:
        return zero, F.shiftleft(recent, days - WORD).bitwiseAND(F.lit(FULL))
    carried = F.shiftright(recent, WORD - days) if days else zero
    # Bits that would leave the word are cut off before it is shifted, so that none reaches the sign.
    low = F.lit((1 << (WORD - days)) - 1)
    return F.shiftleft(recent.bitwiseAND(low), days), F.shiftleft(older.bitwiseAND(low), days).bitwiseOR(carried)


def bits(lo: int, hi: int) -> tuple[int, int]:
    """Words with the bits of the days from ``lo`` to before ``hi`` back."""
    both = ((1 << hi) - 1) & ~((1 << lo) - 1)
    return both & FULL, both >> WORD


def active_on(lo: int, hi: int) -> Column:
    """Whether there was activity at least ``lo`` and less than ``hi`` days back; the last day lies 0 back."""
    recent, older = bits(lo, hi)
    return (F.col("recent").bitwiseAND(F.lit(recent)) != 0) | (F.col("older").bitwiseAND(F.lit(older)) != 0)


def day_masks(t: dict[str, DataFrame], first: datetime, last: datetime) -> DataFrame:
    """Masks of the days ``first`` to ``last``, both taken in, from their items alone."""
    items = active_items(t, first, last + timedelta(days=1))
    back = F.datediff(moment(last), F.col("transfer_date").cast("date"))
    places = items.select(F.col("party_id").alias("user_id"), F.col("account_id").alias("msisdn"), back.alias("back"))
    words = {"recent": f"if(back < {WORD}, shiftleft(1L, back), 0L)", "older": f"if(back >= {WORD}, shiftleft(1L, back - {WORD}), 0L)"}
    return added_up(places.selectExpr("user_id", "msisdn", *[f"{w} as {name}" for name, w in words.items()]))


def added_up(masks: DataFrame) -> DataFrame:
    return masks.groupBy("user_id", "msisdn").agg(F.bit_or("recent").alias("recent"), F.bit_or("older").alias("older"))


def moved_on(masks: DataFrame, days: int, fresh: DataFrame, read_again: int = 0) -> DataFrame:
    """``masks`` so many days later with ``fresh`` masks set; the last ``read_again`` old days are theirs alone."""
    recent, older = shifted(days)
    keep = [~x & FULL for x in bits(0, days + read_again)]
    old = masks.select("user_id", "msisdn", recent.alias("recent"), older.alias("older"))
    old = old.select("user_id", "msisdn", *[F.col(c).bitwiseAND(F.lit(k)).alias(c) for c, k in zip(("recent", "older"), keep)])
    return added_up(old.where("recent <> 0 or older <> 0").unionByName(fresh))


def recently_active(masks: DataFrame, days: int) -> DataFrame:
    """Users active in the last days, as ``cohorts.active_users`` finds them in the items."""
    return masks.where(active_on(0, days)).select("user_id", "msisdn")


def reactivated_users(masks: DataFrame, window_days: int, dormant_days: int) -> DataFrame:
    """Active in the window, not in the days before it, as ``cohorts.reactivated`` finds them. Who has no id or phone matches nobody."""
    before = active_on(window_days, window_days + dormant_days)
    return masks.where(active_on(0, window_days) & (~before | ~_comparable())).select("user_id", "msisdn")


class ActivityMasks:
    """Masks by last day below a folder: one table a day, of which the latest few are kept.

    ``up_to`` takes in what is missing: a day's items if the day before is there, else ``DAYS`` days at once. A table without
    its success mark is none, so a run that died is simply repeated.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def days(self) -> list[datetime]:
        names = [n for n in file_names(self.spark, self.path) if n.startswith("day=") and "_SUCCESS" in file_names(self.spark, f"{self.path}/{n}")]
        return sorted(datetime.strptime(n[4:], "%Y%m%d") for n in names)

    def _folder(self, day: datetime) -> str:
        return f"{self.path}/day={day:%Y%m%d}"

    def read(self, day: datetime) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self._folder(day))

    def up_to(self, t: dict[str, DataFrame], day: datetime, read_again: int = 0) -> DataFrame:
        """Masks with ``day`` as their last. ``read_again`` so many of the days taken in before, whose items may have changed."""
        known = [d for d in self.days() if d <= day]
        if known and known[-1] == day and not read_again:
            return self.read(day)
        known = [d for d in known if d < day and (day - d).days + read_again < DAYS]
        if known:
            passed = (day - known[-1]).days
            fresh = day_masks(t, day - timedelta(days=passed + read_again - 1), day)
            masks = moved_on(self.read(known[-1]), passed, fresh, read_again)
        else:
            masks = day_masks(t, day - timedelta(days=DAYS - 1), day)
        masks.write.mode("overwrite").parquet(self._folder(day))
        for old in self.days()[: -self.keep]:
            remove_dir(self.spark, self._folder(old))
        return self.read(day)
