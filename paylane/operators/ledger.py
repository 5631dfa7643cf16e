"""The ledger: pairing the two legs of a transfer, charges, and the assembled transfers.

A transfer has receiver legs and payer legs. They pair when the transfer, both parties (swapped) and the value agree;
equal copies pair many-to-many. That fan-out is part of the result; it is carried as the number ``copies`` and rows are
multiplied where they are written (``legs.expanded`` where they are wanted before).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_window, is_settled, party_type, reclassify, scale, settled_flag
from ..functions.dates import moment
from ..functions.rules import CORRECTION_SERVICES, FEE_PARTY
from ..session import broadcast_if_small, staged
from ..sources.by_id import rows_of
from ..sources.tables import BY_ID
from .legs import ALL_KINDS, LEG_PAIRS, PAIR_KEY, Legs, payer_legs, receiver_legs
from .lookups import currency_factor
from .skew import LOT, with_lot

def header_slice(headers: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Headers transferred in ``[start, end)`` with their as-of date.

    The as-of date is the day of the last change if that is not before the transfer and not past the window.
    """
    changed = F.date_trunc("DAY", F.col("modified_on")).cast("timestamp_ntz")
    moved = F.date_trunc("DAY", F.col("transfer_date")).cast("timestamp_ntz")
    as_of = F.when((changed >= moved) & (changed < moment(end)), changed).otherwise(moved)
    return headers.where(in_window(F.col("transfer_date"), start, end)).withColumn("as_of_date", as_of)


def late_headers(headers: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Headers transferred before the window and changed inside it."""
    late = headers.where((F.col("transfer_date") < moment(start)) & in_window(F.col("modified_on"), start, end))
    return late.withColumn("as_of_date", F.date_trunc("DAY", F.col("modified_on")).cast("timestamp_ntz"))


SETTLING = ("transfer_status", "reconciliation_by", "service_type", "attr_2_name", "attr_2_value")


def with_settled(headers: DataFrame) -> DataFrame:
    return headers.withColumn("settled", settled_flag(*[F.col(c) for c in SETTLING]))


def settled_only(headers: DataFrame) -> DataFrame:
    return headers.where(is_settled(*[F.col(c) for c in SETTLING]))


def in_run(items: DataFrame, start: datetime, end: datetime) -> DataFrame:
    return items.where(in_window(F.col("transfer_date"), start, end))


def items_of(items: DataFrame, headers: DataFrame, by_id: DataFrame | None = None) -> DataFrame:
    """Items of the given headers, whatever their own date.

    ``by_id`` is the items' copy in order of transfer id, if there is one: then only row groups that hold a wanted id are read.
    Without it the ids are stored and counted first: few of them are broadcast, so that the undated item scan is not shuffled.
    """
    if by_id is not None:
        return rows_of(by_id, headers)
    ids = staged(headers.select("transfer_id").distinct(), "header-ids")
    return items.join(broadcast_if_small(ids), "transfer_id", "left_semi")


def late_items(t: dict[str, DataFrame], start: datetime, end: datetime) -> DataFrame:
    """Items of late-changed headers, stored: one lookup (or undated scan) serves every leg and every extract of a run."""
    late = late_headers(t["txn_header"], start, end)
    return staged(items_of(t["txn_item"], late, t.get(BY_ID["txn_item"])), "late-items")


def pair_legs(items: DataFrame | Legs, kinds: tuple[str, ...] = ALL_KINDS) -> DataFrame:
    """Pairs of the given kinds, ``copies`` times each; of windowed items, so that the window prunes their scans, or stored legs.

    One equi-join on all five parts of the key: a transfer with very many legs spreads over partitions by party and value.
    Equal legs that are stored as one make one pair row, which counts for all of theirs.
    """
    pairs = receiver_legs(items, kinds).join(payer_legs(items, kinds), list(PAIR_KEY))
    return pairs.withColumn("copies", F.col("_received") * F.col("_paid")).drop("_received", "_paid")


def is_charge() -> Column:
    """Whether a receiver leg is a service charge."""
    correction = F.col("receiver_service_type").isin(*CORRECTION_SERVICES) & (F.col("sender_user_id") == FEE_PARTY)
    return (F.col("kind") == "SCR") | ((F.col("kind") == "MR") & correction)


def charge_totals(items: DataFrame | Legs, factor: Column) -> DataFrame:
    """Total service charge per transfer, over all its pairs.

    Legs are counted per pairing key before they meet, and each pair of counts contributes value x count x count. So the
    pairs are never listed, and a transfer with many equal legs is a handful of rows. A charged main leg is paid by the fee
    party, so of the main payer legs only those are read. The totals are keyed by transfer and lot.
    """
    kinds = ("MR", "SCR")
    payable = items
    if not isinstance(items, Legs):
        payable = items.where((F.col("transaction_type") == LEG_PAIRS["SCR"]) | (F.col("party_id") == FEE_PARTY))
    payers = payer_legs(payable, kinds).where((F.col("kind") == "SCR") | (F.col("sender_user_id") == FEE_PARTY))
    charged = receiver_legs(items, kinds).where(is_charge()).groupBy(*PAIR_KEY).agg(F.sum("_received").alias("n_receiver"))
    paid = payers.groupBy(*PAIR_KEY).agg(F.sum("_paid").alias("n_payer"))
    total = F.sum(F.col("transfer_value") * F.col("n_receiver") * F.col("n_payer"))
    return (
        with_lot(charged.join(paid, list(PAIR_KEY)), "transfer_id")
        .groupBy("transfer_id", LOT)
        .agg(total.alias("_minor"))
        .select("transfer_id", LOT, (F.col("_minor") / factor).alias("total_charge"))
    )


def total_charge(pairs: DataFrame, items: DataFrame | Legs, factor: Column) -> DataFrame:
    """Pairs with the transfer's total charge on each, zero where nothing was charged."""
    joined = pairs.join(charge_totals(items, factor).drop(LOT), "transfer_id", "left")
    return joined.withColumn("total_charge", F.coalesce("total_charge", F.lit(0)))


def main_pairs(items: DataFrame | Legs) -> DataFrame:
    """Main pairs that are still main after reclassification."""
    kept = reclassify(F.col("kind"), F.col("receiver_service_type"), F.col("receiver_user_id"), F.col("sender_user_id"))
    return pair_legs(items, ("MR",)).where(kept == "MR")


def open_transfers(headers: DataFrame, items: DataFrame | Legs, t: dict[str, DataFrame]) -> DataFrame:
    """Main pairs of the headers, where the service is financial or the transfer was charged.

    Commission and charge pairs are never part of a ledger, so they are not built. Charges enter as totals over all legs
    (not over what reclassification leaves) and join the headers, one row each; only then do the pairs join, once.
    """
    head = with_lot(with_settled(headers), "transfer_id").select(
        "transfer_id",
        LOT,
        "transfer_date",
        "as_of_date",
        "created_on",
        "created_by",
        "transfer_subtype",
        "reference_number",
        "attr_2_value",
        "settled",
    )
    charged = head.join(charge_totals(items, currency_factor(t)), ["transfer_id", LOT], "left").drop(LOT)
    charged = charged.withColumn("total_charge", F.coalesce("total_charge", F.lit(0)))
    services = t["service_type"].select("service_type", "is_financial")
    wanted = (F.col("is_financial") == "Y") | (F.col("total_charge") > 0)
    return charged.join(main_pairs(items), "transfer_id").join(services, "service_type").where(wanted)


# What a ledger knows of the party behind each wallet.
PARTY_FACTS = {
    "user_type": "known_type",
    "designation": "designation",
    "state": "state",
    "domain_code": "domain",
    "network_code": "network",
}


def assemble_ledger(transfers: DataFrame, parties: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Transfers with what is known of sender and receiver, amounts in currency units.

    Both party joins take the parties under the same names and rename afterwards, so they share one shuffled copy.
    """
    ledger = transfers
    known = parties.selectExpr("wallet_number as _wallet", *[f"{c} as _{c}" for c in PARTY_FACTS])
    for side in ("sender", "receiver"):
        joined = ledger.join(known, F.expr(f"{side}_wallet = _wallet"), "left")
        taken = ", ".join(["_wallet", *[f"_{c}" for c in PARTY_FACTS]])
        ledger = joined.selectExpr(f"* except ({taken})", *[f"_{c} as {side}_{new}" for c, new in PARTY_FACTS.items()])
    factor = currency_factor(t)
    return ledger.withColumns(
        {
            "amount": scale(F.col("requested_value"), factor),
            "sender_type": party_type(F.col("sender_pseudo_user_id"), F.col("sender_known_type")),
            "receiver_type": party_type(F.col("receiver_pseudo_user_id"), F.col("receiver_known_type")),
            **{
                f"{side}_{when}_balance": scale(F.col(f"{side}_{when}_balance"), factor)
                for side in ("sender", "receiver")
                for when in ("pre", "post")
            },
        }
    )


def two_sided(ledger: DataFrame) -> DataFrame:
    """Each transfer twice: as seen by the sender (``D``, amount negative) and by the receiver (``C``).

    What is known of both sides turns into ``own_`` and ``contra_`` columns. The sides are opened from one pass over the
    ledger, not by a union of two readings of it.
    """
    columns = set(ledger.columns)
    names = sorted(c.removeprefix("sender_") for c in columns if c.startswith("sender_"))
    names = [n for n in names if f"receiver_{n}" in columns]

    def seen(side: str, amount: str, own: str, contra: str) -> str:
        swapped = [f"{who}_{n} as {role}_{n}" for role, who in (("own", own), ("contra", contra)) for n in names]
        return f"struct('{side}' as side, {amount} as signed_amount, {', '.join(swapped)})"

    sides = f"array({seen('D', '-amount', 'sender', 'receiver')}, {seen('C', 'amount', 'receiver', 'sender')})"
    return ledger.withColumn("_leg", F.explode(F.expr(sides))).select("*", "_leg.*").drop("_leg")


def moved_money(items: DataFrame | Legs, headers: DataFrame, by_id: DataFrame | None = None) -> DataFrame:
    """Wallets that sent or received in a settled main pair, once each. ``by_id``: the headers in order of transfer id.

    Existence is all that counts, so both directions are semi-joins: copies of legs never multiply.
    """
    legs = receiver_legs(items, ("MR",))
    # Headers are not dated here. Thinned by the legs' own ids, their history streams past the ids instead of being shuffled.
    ids = staged(legs.select("transfer_id").distinct(), "leg-ids")
    known = headers.join(broadcast_if_small(ids), "transfer_id", "left_semi") if by_id is None else rows_of(by_id, ids)
    settled = settled_only(known).select("transfer_id")
    receivers = legs.join(settled, "transfer_id", "left_semi")
    payers = payer_legs(items, ("MR",))
    received = receivers.join(payers, list(PAIR_KEY), "left_semi").select(F.col("receiver_wallet").alias("wallet_number"))
    sent = payers.join(receivers, list(PAIR_KEY), "left_semi").select(F.col("sender_wallet").alias("wallet_number"))
    return received.unionByName(sent).distinct()


def active_wallets(wallets: DataFrame, items: DataFrame | Legs, headers: DataFrame, by_id: DataFrame | None = None) -> DataFrame:
    return wallets.join(moved_money(items, headers, by_id), "wallet_number", "left_semi")
