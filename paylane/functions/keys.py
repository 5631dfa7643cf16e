"""Keys printed in the extracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

# Where the three parts of an account key lie in a wallet number.
WALLET_PARTS = ((1, 2), (3, 9), (12, 9))


def account_key(wallet: Column, default: str | None = None) -> list[Column]:
    parts = [blank_to_null(F.substring(wallet, at, size)) for at, size in WALLET_PARTS]
    return parts if default is None else [F.coalesce(part, F.lit(default)) for part in parts]


def customer_key(user_type: Column, msisdn: Column, default: str) -> Column:
    """First letter of the user type, then the phone number or the default."""
    return F.concat_ws("", F.substring(user_type, 1, 1), F.coalesce(msisdn, F.lit(default)))


def short_transfer_id(c: Column) -> Column:
    """First two characters and what follows the first dot (the whole id where there is none)."""
    return F.concat(F.substring(c, 1, 2), F.substr(c, F.instr(c, ".") + 1))
