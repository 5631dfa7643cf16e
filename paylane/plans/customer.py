"""Customer extract and customer extension: users that a run has to report, and unregistered receivers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    changed_in_window,
    customer_key,
    day_text,
    decode,
    gender_letter,
    sentinel_date,
    text_head,
    text_tail,
    unquote,
)
from ..operators.cohorts import active_users, created_before, flag_cohort, reactivated, unregistered_receivers
from ..operators.layout import Field, blanks, fixed_width, quoted_pipe, reserved
from ..operators.lookups import valid_country
from ..operators.parties import eligible, resolve_parties, route_identity, with_categories, with_grade, with_identity
from ..operators.recency import DAYS, reactivated_users, recently_active
from ..params import ALL, RunParams

ORDER = ["customer"]


def added_cohort(t: dict[str, DataFrame], p: RunParams, masks: DataFrame | None = None) -> DataFrame:
    """The users that the mode adds: the active ones of late, or the reactivated ones.

    ``masks``: the days that users were active on, with the run's last day as theirs; without them the days are read again.
    """
    if p.mode == "FULLACTIVE":
        return active_users(t, p.end - timedelta(days=p.active_days), p.end) if masks is None else recently_active(masks, p.active_days)
    if masks is None:
        return reactivated(t, p.start, p.end, p.dormant_days)
    return reactivated_users(masks, (p.end - p.start).days, p.dormant_days)


def masks_serve(p: RunParams) -> bool:
    """Whether masks can tell the run's cohort: whole days, and no more of them than masks hold."""
    days = (p.end - p.start).days
    whole = p.start + timedelta(days=days) == p.end and p.end == datetime.combine(p.end.date(), datetime.min.time())
    return whole and p.mode in ("DELTA", "FULLACTIVE") and max(p.active_days, days + p.dormant_days) <= DAYS


def reported_users(users: DataFrame, t: dict[str, DataFrame], p: RunParams, masks: DataFrame | None = None) -> DataFrame:
    """Users to report: changed in the window, or in the cohort that the mode adds.

    A full-active run adds the active ones, a delta run the reactivated ones that are older than the dormant period; other
    modes add none, and no activity is read for them. One pass over the users marks both reasons.
    """
    changed = changed_in_window(
        F.col("creation_date"), F.col("modification_date"), F.col("wallet_modified_on"), p.start, p.end
    )
    if p.msisdn != ALL:
        # The phone filter is for the changed users alone.
        changed = changed & (F.col("msisdn") == p.msisdn)
    if p.mode == "FULLACTIVE":
        return flag_cohort(users, added_cohort(t, p, masks)).where(F.col("in_cohort") | changed)
    if p.mode == "DELTA":
        older = created_before(F.col("creation_date"), p.start, p.dormant_days)
        return flag_cohort(users, added_cohort(t, p, masks)).where((F.col("in_cohort") & older) | changed)
    return users.where(changed)


def _or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(" "))


def _country(code: str, valid: str) -> Column:
    return F.when(F.col(valid), _or_blank(F.col(code))).otherwise(" ")


def run_users(t: dict[str, DataFrame], p: RunParams, masks: DataFrame | None = None) -> DataFrame:
    """The users that both customer extracts of a run report."""
    return reported_users(eligible(resolve_parties(t, "user"), primary_only=True), t, p, masks)


def extract_customer(
    t: dict[str, DataFrame], p: RunParams, users: DataFrame | None = None, late_legs: DataFrame | None = None
) -> DataFrame:
    """Fixed-width lines of 34 fields. Registered and unregistered customers share the layout.

    ``users`` and ``late_legs``: stored users to report and late items, where the run has them already.
    """
    users = run_users(t, p) if users is None else users
    users = with_identity(users, t["id_type"])
    users = valid_country(users, t["country"], "home_country_code", "home_valid")
    users = valid_country(users, t["country"], "nationality_code", "nationality_valid")
    passport, _ = route_identity(F.col("identity_type"), F.col("id_number"))
    registered = users.select(
        customer_key(F.col("user_type"), F.col("msisdn"), " ").alias("customer"),
        _or_blank(F.col("user_name")).alias("first_name"),
        F.coalesce(F.nullif(F.trim("last_name"), F.lit("")), F.lit("UNKNOWN")).alias("last_name"),
        _or_blank(F.col("address1")).alias("street"),
        _or_blank(F.col("city")).alias("town"),
        _country("home_country_code", "home_valid").alias("home_country"),
        _or_blank(F.col("user_mark")).alias("profession"),
        _or_blank(F.col("user_type")).alias("line_of_business"),
        sentinel_date(day_text(F.col("dob"))).alias("born_on"),
        sentinel_date(day_text(F.col("created_on"))).alias("customer_since"),
        _country("nationality_code", "nationality_valid").alias("nationality"),
        _or_blank(F.col("agent_code")).alias("employee"),
        passport.alias("passport"),
        gender_letter(F.col("gender")).alias("gender"),
    )
    space = F.lit(" ")
    unregistered = unregistered_receivers(t, p.start, p.end, late_legs).select(
        F.concat(F.lit("U"), _or_blank(F.col("msisdn"))).alias("customer"),
        _or_blank(F.col("rec_fname")).alias("first_name"),
        F.coalesce(F.nullif(F.trim("rec_lname"), F.lit("")), F.lit("UNKNOWN")).alias("last_name"),
        space.alias("street"),
        space.alias("town"),
        space.alias("home_country"),
        space.alias("profession"),
        F.lit("UNREGISTERED").alias("line_of_business"),
        sentinel_date(day_text(F.col("rec_dob"))).alias("born_on"),
        F.lit(" " * 8).alias("customer_since"),
        space.alias("nationality"),
        space.alias("employee"),
        space.alias("passport"),
        space.alias("gender"),
    )
    # Only the fields that vary are compared for distinctness, before the line is built.
    rows = _printed_distinct(registered).unionByName(_printed_distinct(unregistered))
    layout = [
        Field("institute", F.lit(p.institute), 4),
        *_fields("customer", "first_name", "last_name", "street"),
        *blanks(("zip", 7)),
        *_fields("town", "home_country"),
        *blanks(("second_country", 3), ("since", 8), ("csm_no", 12)),
        *_fields("profession", "line_of_business", "born_on", "customer_since"),
        *blanks(("exempt", 1), ("exempt_amount", 11), ("asylum", 1), ("salary", 17), ("salary_date", 8)),
        *_fields("nationality"),
        *blanks(("total_wealth", 17), ("property_wealth", 3), ("branch", 10), ("customer_type", 1), ("flags", 24)),
        *_fields("employee", "passport"),
        *blanks(("birth_country", 3), ("birth_place", 32), ("borrower", 1), ("direct_debit", 1)),
        *_fields("gender"),
        *blanks(("risk_class", 10)),
    ]
    return fixed_width(rows, layout, keys=("customer",))


# Printed widths of the fields that vary.
WIDTHS = {
    "customer": 16,
    "first_name": 32,
    "last_name": 32,
    "street": 32,
    "town": 28,
    "home_country": 3,
    "profession": 32,
    "line_of_business": 32,
    "born_on": 8,
    "customer_since": 8,
    "nationality": 3,
    "employee": 16,
    "passport": 17,
    "gender": 1,
}


def _printed_distinct(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.rpad(c, WIDTHS[c], " ").alias(c) for c in rows.columns]).distinct()


def _fields(*names: str) -> list[Field]:
    return [Field(n, F.col(n), WIDTHS[n]) for n in names]


def extract_customer_ext(
    t: dict[str, DataFrame], p: RunParams, users: DataFrame | None = None, late_legs: DataFrame | None = None
) -> DataFrame:
    """Quoted lines of 60 fields. Activity totals have no field in the layout, so they are no part of this plan."""
    users = run_users(t, p) if users is None else users
    users = with_grade(with_categories(with_identity(users, t["id_type"]), t), t["grade"], "user_grade")
    _, other_identity = route_identity(F.col("identity_type"), unquote(F.col("id_number")))
    institute = F.rpad(F.lit(p.institute), 4, " ")
    registered = users.select(
        institute.alias("institute"),
        customer_key(F.col("user_type"), F.col("msisdn"), " ").alias("customer"),
        unquote(text_tail(F.col("user_name"), 32)).alias("cust_text_01"),
        unquote(text_tail(F.col("last_name"), 32)).alias("cust_text_02"),
        unquote(text_tail(F.col("address1"), 32)).alias("cust_text_03"),
        unquote(F.col("address2")).alias("cust_text_04"),
        unquote(text_tail(F.col("city"), 28)).alias("cust_text_05"),
        other_identity.alias("cust_text_06"),
        F.col("clean_id_no").alias("cust_text_07"),
        F.col("identity_type").alias("cust_text_08"),
        F.col("category_code").alias("cust_text_09"),
        F.col("category_name").alias("cust_text_10"),
        decode(F.col("user_type"), "CHANNEL", F.col("state"), default=F.lit(None).cast("string")).alias("cust_text_11"),
        unquote(text_head(F.col("remarks"), 64)).alias("cust_text_17"),
        unquote(text_tail(F.col("remarks"), 64)).alias("cust_text_18"),
        F.col("user_id").alias("cust_text_19"),
        F.col("hierarchical_level").cast("string").alias("cust_text_20"),
        F.col("head_category_code").alias("cust_text_21"),
        F.col("head_category_name").alias("cust_text_22"),
        F.col("grade_name").alias("cust_text_26"),
    ).distinct()
    unregistered = unregistered_receivers(t, p.start, p.end, late_legs).select(
        institute.alias("institute"),
        F.concat(F.lit("U"), _or_blank(F.col("msisdn"))).alias("customer"),
        unquote(text_tail(F.col("rec_fname"), 32)).alias("cust_text_01"),
        unquote(text_tail(F.col("rec_lname"), 32)).alias("cust_text_02"),
        F.col("rec_idno").alias("cust_text_07"),
        F.col("unreg_user_id").alias("cust_text_19"),
    ).distinct()
    rows = registered.unionByName(unregistered, allowMissingColumns=True)
    slots = [c for lo, hi in ((12, 16), (23, 25), (27, 48)) for c in reserved("cust_text", lo, hi)]
    rows = rows.select("*", *slots, *reserved("cust_number", 1, 10, "decimal(20,2)"))
    text = ["institute", "customer", *[f"cust_text_{n:02d}" for n in range(1, 49)]]
    return quoted_pipe(rows, text, [f"cust_number_{n:02d}" for n in range(1, 11)], keys=("customer",))
