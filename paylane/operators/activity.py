"""Debit and credit activity per user."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import volume_class
from ..functions.dates import moment
from ..functions.rules import volume_threshold
from ..params import RunParams
from .ledger import assemble_ledger, header_slice, in_run, late_headers, late_items, open_transfers
from .legs import Legs
from .lookups import only
from .parties import resolve_parties, with_domain


def activity_ledger(t: dict[str, DataFrame], p: RunParams, late_legs: DataFrame | None = None, legs: Legs | None = None) -> DataFrame:
    """The window's transfers together with the late-changed ones and their pairs, ``copies`` times each.

    ``late_legs`` and ``legs``: the stored items of the late headers, and the window's legs, where the run has them already.
    """
    late = late_headers(t["txn_header"], p.start, p.end)
    late_legs = late_items(t, p.start, p.end) if late_legs is None else late_legs
    headers = header_slice(t["txn_header"], p.ledger_start, p.end).unionByName(late)
    in_time = open_transfers(headers, in_run(t["txn_item"], p.ledger_start, p.end) if legs is None else legs, t)
    after = open_transfers(headers, late_legs, t)
    return assemble_ledger(in_time.unionByName(after), with_domain(resolve_parties(t, "party"), t["category"]), t)


def activity_profile(ledger: DataFrame, network: DataFrame, end: datetime, days: int) -> DataFrame:
    """Totals and last dates per user and type, over settled transfers of the last days.

    Debits and credits are two events of one aggregation. A user without id or type never matches across the two, so keeps a
    row for each.
    """
    recent = ledger.where((F.col("settled") == "Y") & (F.col("transfer_date") >= moment(end - timedelta(days=days))))
    return profile_of(side_events(recent), network)


def side_events(transfers: DataFrame) -> DataFrame:
    """Each transfer as a debit of its sender and a credit of its receiver; the amount is that of all its copies."""

    def event(side: str, who: str):
        return F.struct(
            F.lit(side).alias("side"), F.col(f"{who}_user_id").alias("user_id"), F.col(f"{who}_type").alias("user_type")
        )

    copies = F.col("copies") if "copies" in transfers.columns else F.lit(1)
    return transfers.select(
        (F.col("amount") * copies).alias("amount"),
        "transfer_date",
        F.explode(F.array(event("D", "sender"), event("C", "receiver"))).alias("e"),
    ).select("amount", "transfer_date", "e.*")


def profile_of(events: DataFrame, network: DataFrame) -> DataFrame:
    """Totals and last dates per user and type, from events or partial sums of them (side, user_id, user_type, amount, transfer_date)."""
    apart = F.when(F.col("user_id").isNull() | F.col("user_type").isNull(), F.col("side"))
    debit, credit = F.col("side") == "D", F.col("side") == "C"
    totals = events.groupBy("user_id", "user_type", apart.alias("_apart")).agg(
        F.sum(F.when(debit, F.col("amount"))).alias("total_debit"),
        F.sum(F.when(credit, F.col("amount"))).alias("total_credit"),
        F.max(F.when(debit, F.col("transfer_date"))).alias("max_debit_date"),
        F.max(F.when(credit, F.col("transfer_date"))).alias("max_credit_date"),
    )
    threshold = only(network, volume_threshold(F.col("network_code")), "network")
    return totals.drop("_apart").withColumns(
        {
            "last_transfer_date": F.greatest("max_debit_date", "max_credit_date"),
            "volume_class": volume_class(F.col("total_debit"), F.col("total_credit"), threshold),
        }
    )
