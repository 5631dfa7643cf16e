"""Account extract and account extension: wallets that moved money in the ledger window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import account_key, customer_key, day_text, decode, money_text, text_head
from ..operators.layout import Field, blanks, fixed_width, quoted_pipe, reserved
from ..operators.ledger import active_wallets, in_run
from ..operators.legs import Legs
from ..operators.lookups import currency_factor, lookup
from ..operators.parties import eligible, maybe_key, resolve_parties, with_grade
from ..params import RunParams
from ..sources.tables import BY_ID

ORDER = ["customer", "business_type", "account_no", "business_no", "currency"]


def moving_wallets(t: dict[str, DataFrame], p: RunParams, legs: Legs | None = None) -> DataFrame:
    """Wallets that moved money in the ledger window; both account extracts of a run start from them."""
    items = in_run(t["txn_item"], p.ledger_start, p.end) if legs is None else legs
    return active_wallets(t["wallet"], items, t["txn_header"], t.get(BY_ID["txn_header"]))


def active_accounts(t: dict[str, DataFrame], p: RunParams, wallets: DataFrame | None = None) -> DataFrame:
    """Eligible wallets active in the ledger window, with their owner, limit and kind."""
    wallets = moving_wallets(t, p) if wallets is None else wallets
    owners = eligible(resolve_parties(t, "user", wallets))
    x = lookup(owners, t["control_profile"], {"mpay_profile_id": "profile_id"}, {"max_balance": "max_balance", "grade_code": "grade_code"})
    x = lookup(x, t["payment_subtype"], {"payment_type_id": "payment_type_id"}, {"subtype_name": "wallet_kind"})
    return maybe_key(x, "msisdn", p.msisdn)


def with_balance(accounts: DataFrame, balances: DataFrame) -> DataFrame:
    """The wallet's main balance; a wallet without one is left out."""
    main = balances.where(F.col("wallet_sequence_number") == 0).select("wallet_number", "balance")
    return accounts.join(main, "wallet_number")


def extract_account(t: dict[str, DataFrame], p: RunParams, wallets: DataFrame | None = None) -> DataFrame:
    """Fixed-width lines of 35 fields."""
    factor = currency_factor(t)
    known = with_balance(active_accounts(t, p, wallets), t["wallet_balance"]).select(
        "user_type",
        "msisdn",
        "wallet_status",
        "network_code",
        "wallet_number",
        "wallet_modified_on",
        "wallet_created_on",
        "wallet_kind",
        (F.col("max_balance") / factor).alias("limit"),
        (F.col("balance") / factor).alias("balance"),
        "status",
        "wallet_primary",
    )
    x = lookup(known.distinct(), t["country"], {"network_code": "country_iso"}, {"currency_iso": "currency_iso"})
    business_type, account_no, business_no = account_key(F.col("wallet_number"))
    closed_on = decode(F.col("wallet_status"), "N", day_text(F.col("wallet_modified_on")), default=F.lit(" "))
    layout = [
        Field("institute", F.lit(p.institute), 4),
        Field("customer", customer_key(F.col("user_type"), F.col("msisdn"), " "), 16),
        Field("business_type", business_type, 4),
        Field("account_no", account_no, 11),
        Field("business_no", business_no, 11),
        Field("currency", F.col("currency_iso"), 3),
        Field("opened_on", day_text(F.col("wallet_created_on"))),
        Field("closed_on", closed_on, 8),
        *blanks(("holder_institute", 4), ("holder_customer", 16)),
        Field("limit", money_text(F.col("limit"))),
        Field("balance", money_text(F.col("balance"))),
        *blanks(
            ("credits_this_year", 17),
            ("debits_this_year", 17),
            ("number_of_accounts", 4),
            ("flags", 24),
            ("pod_type", 5),
            ("iban", 35),
            ("account_type", 1),
            ("hold_mail", 1),
            ("employee", 16),
        ),
        Field("purpose", F.col("wallet_kind"), 32),
        *blanks(
            ("contract_from", 8),
            ("contract_to", 8),
            ("tariff", 32),
            ("payment_period", 4),
            ("payment_mode", 2),
            ("payment_type", 1),
            ("acquisition", 2),
            ("life_increase", 1),
            ("life_length", 1),
            ("contract_status", 32),
            ("intermediary", 5),
            ("csm_no", 12),
            ("premium_payer", 12),
        ),
    ]
    return fixed_width(x, layout, keys=tuple(ORDER))


def extract_account_ext(t: dict[str, DataFrame], p: RunParams, wallets: DataFrame | None = None) -> DataFrame:
    """Quoted lines of 64 fields. No balance is asked for, so it can hold more wallets than the account extract."""
    factor = currency_factor(t)
    known = (
        with_grade(active_accounts(t, p, wallets), t["grade"], "grade_code")
        .select(
            "user_type",
            "msisdn",
            "status",
            "wallet_primary",
            "wallet_status",
            "network_code",
            "wallet_number",
            "wallet_modified_on",
            "wallet_created_on",
            "wallet_kind",
            (F.col("max_balance") / factor).alias("limit"),
            "payment_type_id",
            "grade_name",
            "user_id",
        )
        .distinct()
    )
    x = lookup(known, t["country"], {"network_code": "country_iso"}, {"currency_iso": "currency_iso"})
    business_type, account_no, business_no = account_key(F.col("wallet_number"))
    text, number = reserved("acc_text", 4, 48), reserved("acc_number", 1, 10, "decimal(20,2)")
    fields = x.select(
        F.rpad(F.lit(p.institute), 4, " ").alias("institute"),
        customer_key(F.col("user_type"), F.col("msisdn"), " ").alias("customer"),
        business_type.alias("business_type"),
        account_no.alias("account_no"),
        business_no.alias("business_no"),
        text_head(F.col("currency_iso"), 3).alias("currency"),
        F.col("user_id").alias("acc_text_01"),
        F.col("payment_type_id").alias("acc_text_02"),
        F.col("grade_name").alias("acc_text_03"),
        *text,
        *number,
    )
    return quoted_pipe(fields, fields.columns[:54], fields.columns[54:], keys=tuple(ORDER))
