"""Sets of users by activity, and unregistered receivers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import moment
from .ledger import in_run, late_items

# Categories that count as customers.
CUSTOMER_CATEGORIES = ("CHUSER", "SUBS")


def active_items(t: dict[str, DataFrame], start: datetime, end: datetime) -> DataFrame:
    """Settled main legs of financial services and customer categories in ``[start, end)``."""
    items = in_run(t["txn_item"], start, end).where(
        F.col("transaction_type").isin("MR", "MP") & (F.col("transfer_status") == "TS")
    )
    financial = t["service_type"].where(F.col("is_financial") == "Y").select("service_type")
    customers = t["category"].where(F.col("category_type").isin(*CUSTOMER_CATEGORIES)).select("category_code")
    return items.join(financial, "service_type", "left_semi").join(customers, "category_code", "left_semi")


def active_users(t: dict[str, DataFrame], start: datetime, end: datetime) -> DataFrame:
    items = active_items(t, start, end).select(F.col("party_id").alias("user_id"), F.col("account_id").alias("msisdn"))
    return items.distinct()


def _comparable() -> Column:
    return F.col("user_id").isNotNull() & F.col("msisdn").isNotNull()


def split_activity(events: DataFrame, at: Column, start: datetime) -> DataFrame:
    """Per user and phone, whether there is activity from ``start`` on and before it."""
    return events.groupBy("user_id", "msisdn").agg(
        F.bool_or(at >= moment(start)).alias("in_window"), F.bool_or(at < moment(start)).alias("before")
    )


def reactivated(t: dict[str, DataFrame], start: datetime, end: datetime, dormant_days: int) -> DataFrame:
    """Active in the window, not in the days before it.

    Both sets come from one pass over the items and one aggregation, in place of two distinct sets and an anti-join. A user
    without id or phone can be matched with nobody, so counts as not active before.
    """
    items = active_items(t, start - timedelta(days=dormant_days), end)
    events = items.select(F.col("party_id").alias("user_id"), F.col("account_id").alias("msisdn"), "transfer_date")
    split = split_activity(events, F.col("transfer_date"), start)
    return split.where(F.col("in_window") & (~F.col("before") | ~_comparable())).select("user_id", "msisdn")


def cohort_users(users: DataFrame, cohort: DataFrame) -> DataFrame:
    return users.join(cohort, ["user_id", "msisdn"], "left_semi")


def flag_cohort(users: DataFrame, cohort: DataFrame, flag: str = "in_cohort") -> DataFrame:
    """Mark the users of a cohort (which holds each user once), keeping the others."""
    marked = users.join(cohort.withColumn(flag, F.lit(True)), ["user_id", "msisdn"], "left")
    return marked.withColumn(flag, F.coalesce(flag, F.lit(False)))


def unregistered_receivers(
    t: dict[str, DataFrame], start: datetime, end: datetime, late_legs: DataFrame | None = None
) -> DataFrame:
    """Receivers without an account: of the window's transfers, and of late-changed ones.

    ``late_legs``: the stored items of the late headers, where the run has them already.
    """
    late_legs = late_items(t, start, end) if late_legs is None else late_legs

    def named(items: DataFrame) -> DataFrame:
        legs = items.where((F.col("transaction_type") == "MR") & F.col("unreg_user_id").isNotNull())
        return legs.select("transfer_id", "unreg_user_id")

    in_time = named(in_run(t["txn_item"], start, end))
    seen = in_time.unionByName(named(late_legs)).distinct()
    kyc = t["receiver_kyc"].select(F.col("p2p_transfer_id").alias("transfer_id"), "rec_fname", "rec_lname", "rec_dob", "rec_idno")
    return seen.join(kyc, "transfer_id").join(t["unreg_user"], "unreg_user_id")


def created_before(c: Column, start: datetime, dormant_days: int) -> Column:
    return c < moment(start - timedelta(days=dormant_days))

