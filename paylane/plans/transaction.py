"""Transaction extract and transaction extension: the ledger seen from both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    account_key,
    cash_flag,
    clock_text,
    customer_key,
    day_text,
    money_text,
    short_transfer_id,
    text_head,
    text_tail,
)
from ..operators.geography import account_currency, contra_currency, derive_geography, display_currency, with_mapped_currency
from ..operators.layout import Field, blanks, fixed_width, quoted_pipe, reserved
from ..operators.ledger import assemble_ledger, header_slice, in_run, items_of, open_transfers, settled_only, two_sided
from ..operators.legs import MAIN_KINDS, Legs, carrying, ledger_items, store_legs
from ..operators.lookups import lookup
from ..operators.parties import OUTPUT_TYPES, maybe_key, resolve_parties, with_domain
from ..operators.tags import match_rules
from ..params import ALL, RunParams
from ..session import staged

ORDER = ["customer", "business_type", "account_no", "business_no", "currency", "entry_date", "value_date", "transfer_no"]

# What an account key and a phone number print as when missing.
NO_ACCOUNT, NO_PHONE = "XXXX", "XXXXXXXX"


def run_legs(t: dict[str, DataFrame], p: RunParams, carried: tuple[str, ...] | None = None) -> Legs:
    """The legs of the ledger window, stored for all that pair them; ``carried``: all that these ask of them, besides their keys."""
    items = in_run(t["txn_item"], p.ledger_start, p.end)
    return store_legs(items if carried is None else carrying(items, carried))


def ledger_legs(t: dict[str, DataFrame], p: RunParams) -> Legs:
    """Same with what a ledger and its moving wallets ask of them: main legs, and the keys of charges."""
    return store_legs(ledger_items(in_run(t["txn_item"], p.ledger_start, p.end)))


def phone_items(items: DataFrame, msisdn: str) -> DataFrame:
    """All legs, as a ledger asks for them, of the transfers in which a main leg is of the phone; stored, as they are few."""
    mine = items.where(F.col("transaction_type").isin(*MAIN_KINDS) & (F.col("account_id") == msisdn))
    return staged(items_of(ledger_items(items), mine), "phone-items")


def ledger(t: dict[str, DataFrame], p: RunParams, all_states: bool = False, legs: Legs | None = None) -> DataFrame:
    """The window's transfers with geography and tag, ``copies`` times each; both transaction extracts start from it.

    They report settled transfers alone, so the others are left out at the header scan. A run for one phone number reports
    that phone's sides, so without stored legs only its transfers are assembled.
    """
    headers = header_slice(t["txn_header"], p.ledger_start, p.end)
    if not all_states:
        headers = settled_only(headers)
    items = in_run(t["txn_item"], p.ledger_start, p.end) if legs is None else legs
    if legs is None and p.msisdn != ALL:
        items = phone_items(items, p.msisdn)
        headers = items_of(headers, items)
    transfers = open_transfers(headers, items, t)
    parties = with_domain(resolve_parties(t, "party"), t["category"])
    located = derive_geography(assemble_ledger(transfers, parties, t), t).drop("as_of_date")
    return match_rules(located, t["tag_rule"])


def reported_sides(base: DataFrame, p: RunParams) -> DataFrame:
    """Both sides, kept where the side itself is a subscriber or channel user."""
    sides = two_sided(base).where(F.col("own_type").isin(*OUTPUT_TYPES))
    return maybe_key(sides, "own_msisdn", p.msisdn)


def extract_transaction(t: dict[str, DataFrame], p: RunParams, base: DataFrame | None = None) -> DataFrame:
    """Fixed-width lines of 39 fields."""
    base = ledger(t, p) if base is None else base
    x = reported_sides(with_mapped_currency(base, t["country"]), p)
    sender_mapped = F.when(F.col("side") == "D", F.col("own_mapped")).otherwise(F.col("contra_mapped"))
    sender_currency = F.when(F.col("side") == "D", F.col("own_currency")).otherwise(F.col("contra_currency"))
    business_type, account_no, business_no = account_key(F.col("own_wallet"), NO_ACCOUNT)
    layout = [
        Field("institute", F.lit(p.institute), 4),
        Field("customer", customer_key(F.col("own_type"), F.col("own_msisdn"), NO_PHONE), 16),
        Field("business_type", business_type, 4),
        Field("account_no", account_no, 11),
        Field("business_no", business_no, 11),
        Field("currency", account_currency(F.col("local_currency"))),
        Field("entry_date", day_text(F.col("created_on"))),
        Field("value_date", day_text(F.col("transfer_date"))),
        Field("transfer_no", short_transfer_id(F.col("transfer_id")), 16),
        *blanks(("text_key", 2), ("product", 8)),
        Field("amount_currency", display_currency(sender_mapped, sender_currency, F.col("local_currency"))),
        Field("amount", money_text(F.col("signed_amount"))),
        Field("original_amount", money_text(F.lit(0).cast("decimal(20,2)"))),
        *blanks(("branch", 10)),
        Field("contra_country", F.coalesce("contra_country", F.lit(" ")), 3),
        Field("contra_wallet", F.col("contra_wallet"), 35),
        *blanks(("contra_zip", 12)),
        Field("contra_name", F.col("contra_user_id"), 27),
        Field("cash", cash_flag(F.col("tag_name"))),
        *blanks(
            ("reason_1", 27),
            ("reason_2", 27),
            ("reason_3", 27),
            ("reason_4", 27),
            ("status", 1),
            ("flags", 24),
            ("employee", 16),
        ),
        Field("time", clock_text(F.col("transfer_date")), 17),
        Field("contra_customer", customer_key(F.col("contra_type"), F.col("contra_msisdn"), NO_PHONE), 16),
        Field("analytical_code", F.substring("transfer_id", 1, 2), 6),
        *blanks(
            ("early_liquidation", 1),
            ("contra_employee", 16),
            ("contra_owner", 1),
            ("owner_employee", 16),
            ("contra_business_type", 4),
            ("contra_h_account", 11),
            ("contra_business_no", 11),
        ),
        Field("contra_account_currency", contra_currency(F.col("contra_currency"), F.col("contra_mapped")), 3),
        *blanks(("filler", 7)),
    ]
    return fixed_width(x, layout, keys=tuple(ORDER))


def extract_transaction_ext(t: dict[str, DataFrame], p: RunParams, base: DataFrame | None = None) -> DataFrame:
    """Quoted lines of 67 fields, with the receiver's identity check and the balances before and after."""
    base = ledger(t, p) if base is None else base
    base = lookup(
        base,
        t["receiver_kyc"],
        {"transfer_id": "agcout_transfer_id"},
        {"rec_fname": "rec_fname", "rec_lname": "rec_lname", "rec_dob": "rec_dob", "rec_idno": "rec_idno"},
    )
    # Only the number of matching country rows matters here: a code held twice repeats the line.
    x = lookup(reported_sides(base, p), t["country"], {"own_country": "country_iso"}, {"id": "_country"})
    business_type, account_no, business_no = account_key(F.col("own_wallet"), NO_ACCOUNT)
    text = {
        "institute": F.lit(p.institute),
        "customer": customer_key(F.col("own_type"), F.col("own_msisdn"), NO_PHONE),
        "business_type": business_type,
        "account_no": account_no,
        "business_no": business_no,
        "currency": account_currency(F.col("local_currency")),
        "entry_date": day_text(F.col("created_on")),
        "value_date": day_text(F.col("transfer_date")),
        "transfer_no": short_transfer_id(F.col("transfer_id")),
        "txn_text_01": F.col("tag_name"),
        "txn_text_02": text_head(F.col("rec_fname"), 64),
        "txn_text_03": text_tail(F.col("rec_fname"), 64),
        "txn_text_04": text_head(F.col("rec_lname"), 64),
        "txn_text_05": text_tail(F.col("rec_lname"), 64),
        "txn_text_06": F.col("rec_idno"),
        "txn_text_07": day_text(F.col("rec_dob")),
        "txn_text_08": F.col("created_by"),
        "txn_text_09": F.col("service_type"),
        "txn_text_10": F.col("item_subtype"),
        "txn_text_11": F.col("local_currency"),
        "txn_text_12": F.col("transfer_id"),
    }
    numbers = {
        "txn_number_01": money_text(F.col("own_pre_balance")),
        "txn_number_02": money_text(F.col("own_post_balance")),
        "txn_number_03": money_text(F.col("signed_amount")),
    }
    fields = x.select(
        *[value.alias(name) for name, value in text.items()],
        *reserved("txn_text", 13, 48),
        *[value.alias(name) for name, value in numbers.items()],
        *reserved("txn_number", 4, 10, "decimal(20,2)"),
        "copies",
    )
    return quoted_pipe(fields, fields.columns[:57], fields.columns[57:-1], keys=tuple(ORDER))
