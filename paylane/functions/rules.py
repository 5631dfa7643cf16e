"""Business tests on one row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import in_window

# Fixed values.
CORRECTION_SERVICES = ("ROLLBACK", "TXNCORRECT")
FEE_PARTY = "IND03"
VOLUME_THRESHOLD = 200_000
VOLUME_THRESHOLD_BY_NETWORK = {"GC": 2_500_000}


def is_settled(status: Column, reconciled_by: Column, service: Column, attr_name: Column, attr_value: Column) -> Column:
    """A settled, a reconciled or a failed-at-source recharge transfer. Usable as a filter; never true for unknowns."""
    failed_at_source = (service == "RC") & (attr_name == "FAILED_AT_IN") & (attr_value == "Y")
    return (status == "TS") | reconciled_by.isNotNull() | failed_at_source


def settled_flag(status: Column, reconciled_by: Column, service: Column, attr_name: Column, attr_value: Column) -> Column:
    return F.when(is_settled(status, reconciled_by, service, attr_name, attr_value), "Y").otherwise("N")


def cash_flag(tag: Column) -> Column:
    return F.when(tag.startswith("CASHIN") | tag.contains("CASHOUT"), "Y").otherwise("N")


def reclassify(leg_type: Column, service: Column, party: Column, second_party: Column) -> Column:
    """Main legs of a correction that involve the fee party are commission (``CR``) or charge (``SCR``) legs."""
    correction = (leg_type == "MR") & service.isin(*CORRECTION_SERVICES)
    return (
        F.when(correction & (party == FEE_PARTY), "CR")
        .when(correction & (second_party == FEE_PARTY), "SCR")
        .otherwise(leg_type)
    )


def party_type(pseudo_user: Column, resolved: Column) -> Column:
    return F.when(pseudo_user.isNotNull(), "PSEUDO").otherwise(resolved)


def changed_in_window(created: Column, modified: Column, wallet_modified: Column, start: datetime, end: datetime) -> Column:
    return in_window(created, start, end) | in_window(modified, start, end) | in_window(wallet_modified, start, end)


def gender_letter(code: Column) -> Column:
    """Fifth character of a gender code, blank if it has none."""
    return F.coalesce(F.nullif(F.substring(code, 5, 1), F.lit("")), F.lit(" "))


def volume_threshold(network: Column) -> Column:
    limit = F.lit(VOLUME_THRESHOLD)
    for code, value in VOLUME_THRESHOLD_BY_NETWORK.items():
        limit = F.when(network == code, value).otherwise(limit)
    return limit


def volume_class(debit: Column, credit: Column, threshold: Column) -> Column:
    """``F`` (frequent) when either total reaches the threshold, else ``L``."""
    return F.when(debit >= threshold, "F").when(credit >= threshold, "F").otherwise("L")
