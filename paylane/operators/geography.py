"""Country and currency of both sides of a transfer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import first_field_is_one, part_k
from .lookups import last_two, lookup, with_params

# Designations of transfers that cross a border, and the partner whose GB origin is not reported.
CROSS_BORDER = ("IRT", "MFS", "TRANSINTER")
INBOUND, OUTBOUND = "IRTIN", "IRTOUT"
HIDDEN_ORIGIN = {4: "1IRTV3", 12: "WORLDREMIT", 5: "GB"}
COUNTRY_FIELD, CURRENCY_FIELD = 5, 6


def _hidden_origin(parts: Column) -> Column:
    test = F.lit(True)
    for k, value in HIDDEN_ORIGIN.items():
        part = part_k(parts, k)
        test = test & ((F.upper(part) if k == 12 else part) == value)
    return F.coalesce(test, F.lit(False))


def _by_designation(designation: Column, direction: str, coded: Column, local: Column) -> Column:
    """Nothing for a border crossing that names no country, the coded country if it does, else the local value."""
    return (
        F.when(designation.isin(direction, *CROSS_BORDER), None)
        .when(designation.startswith(direction), coded)
        .otherwise(local)
    )


def derive_geography(ledger: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Add country and currency of sender and receiver.

    The transfer's own ``#`` fields decide when the *other* side is a subscriber and the first field is 1; else the
    designation of the side itself does.
    """
    mode, parts = F.col("txn_mode"), F.col("_mode_parts")
    x = with_params(ledger, t).withColumns(
        {
            **{f"_{side}_coded": last_two(F.col(f"{side}_designation")) for side in ("sender", "receiver")},
            "_mode_parts": F.split("txn_mode", "#"),  # split once for all fields asked for below
        }
    )
    for side in ("sender", "receiver"):
        x = lookup(x, t["country"], {f"_{side}_coded": "country_iso"}, {"currency_iso": f"_{side}_coded_currency"}, unique=True)
    out = {}
    for side, other, direction in (("sender", "receiver", INBOUND), ("receiver", "sender", OUTBOUND)):
        designation = F.col(f"{side}_designation")
        home = F.coalesce("home_country", f"{side}_network")
        # The lookup may only be touched for a designation that carries a code.
        coded_currency = F.when(designation.startswith(direction), F.col(f"_{side}_coded_currency"))
        remote = F.coalesce((F.col(f"{other}_known_type") == "SUBSCRIBER") & first_field_is_one(mode), F.lit(False))
        country = F.coalesce(F.upper(part_k(parts, COUNTRY_FIELD)), home)
        currency = F.coalesce(F.upper(part_k(parts, CURRENCY_FIELD)), F.col("local_currency"))
        if side == "sender":
            shown = ~_hidden_origin(parts)
            country, currency = F.when(shown, country), F.when(shown, currency)
        out[f"{side}_country"] = F.when(remote, country).otherwise(
            _by_designation(designation, direction, F.col(f"_{side}_coded"), home)
        )
        out[f"{side}_currency"] = F.when(remote, currency).otherwise(
            _by_designation(designation, direction, coded_currency, F.col("local_currency"))
        )
    helpers = [*(f"_{side}_{c}" for side in ("sender", "receiver") for c in ("coded", "coded_currency")), "_mode_parts"]
    return x.select(F.expr(f"* except ({', '.join(helpers)})"), *[c.alias(name) for name, c in out.items()])


def with_mapped_currency(ledger: DataFrame, country: DataFrame) -> DataFrame:
    """Add the currency that each side's country uses."""
    for side in ("sender", "receiver"):
        ledger = lookup(ledger, country, {f"{side}_country": "country_iso"}, {"currency_iso": f"{side}_mapped"})
    return ledger


def display_currency(mapped: Column, own: Column, local: Column) -> Column:
    """Currency of the transfer: of the sender's country, else the sender's own unless ``NA``, else the local one."""
    return F.coalesce(mapped, F.when(own != "NA", own), local)


def account_currency(local: Column) -> Column:
    return F.when(local == "GNF", "GBP").otherwise(local)


def contra_currency(own: Column, mapped: Column) -> Column:
    return F.when(own.isNull(), "XX").when(own == "NA", F.coalesce(mapped, F.lit("XX"))).otherwise(own)
