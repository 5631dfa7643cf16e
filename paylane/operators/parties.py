"""Who stands behind a wallet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text, code_part, decode, has_structured_code, tidy_upper
from ..params import ALL
from .lookups import lookup

OUTPUT_TYPES = ("SUBSCRIBER", "CHANNEL")


def resolve_parties(t: dict[str, DataFrame], network_first: str = "user", wallets: DataFrame | None = None) -> DataFrame:
    """Wallets with their party and channel user, one row per match.

    A wallet is kept if it is an operator's or if someone is found for it. Most facts come from the party first, the
    network code from the side that ``network_first`` names. Columns that a plan does not use are pruned from the scans.
    """
    w, p, u = (wallets if wallets is not None else t["wallet"]).alias("w"), t["party"].alias("p"), t["channel_user"].alias("u")
    joined = w.join(p, F.expr("w.user_id = p.user_id and w.user_type = p.user_type"), "left").join(
        u, F.expr("w.user_id = u.user_id and w.user_type <> 'SUBSCRIBER'"), "left"
    )
    found = joined.where("w.user_type = 'OPERATOR' or p.user_id is not null or u.user_id is not null")

    def either(*names: str) -> list[str]:
        return [f"coalesce(p.{c}, u.{c}) as {c}" for c in names]

    def owner(party: str, user: str, wallet: str) -> str:
        """From whoever was found, even if that one has no value."""
        return f"case when p.user_id is not null then p.{party} when u.user_id is not null then u.{user} else w.{wallet} end"

    def day(e: str) -> str:
        return f"cast(date_trunc('DAY', {e}) as timestamp_ntz)"

    def operators_own(c: str) -> str:
        return f"case when w.user_type = 'OPERATOR' then w.{c} else coalesce(p.{c}, u.{c}) end as {c}"

    network = "p.network_code, u.network_code" if network_first == "party" else "u.network_code, p.network_code"
    facts = found.selectExpr(
        "w.wallet_number",
        operators_own("user_type"),
        operators_own("status"),
        f"{owner('msisdn', 'msisdn', 'msisdn')} as msisdn",
        "coalesce(w.user_id, p.user_id, u.user_id) as user_id",
        "w.is_primary as wallet_primary",
        "w.status as wallet_status",
        "w.created_on as wallet_created_on",
        "w.modified_on as wallet_modified_on",
        "w.payment_type_id",
        "w.mpay_profile_id",
        "w.user_grade",
        f"coalesce({network}) as network_code",
        "coalesce(p.category_code, u.category_code) as join_category",
        "coalesce(u.category_code, p.category_code) as category_code",
        *either("user_name", "last_name", "address1", "address2", "city", "gender", "designation", "state"),
        "u.agent_code",
        "p.remarks",
        f"{owner('state', 'designation', 'msisdn')} as user_mark",
        f"{day('coalesce(p.dob, u.dob)')} as dob",
        f"{owner('created_on', 'created_on', 'created_on')} as created_on",
        f"{day(owner('created_on', 'level2_approved_on', 'created_on'))} as creation_date",
        f"{day(owner('modified_on', 'modified_approved_on', 'modified_on'))} as modification_date",
        "p.external_code as party_code",
        "coalesce(p.external_code, u.external_code) as any_code",
        "p.residence_country as party_residence",
        "p.nationality as party_nationality",
        "p.id_type as party_id_type",
        "p.id_no as party_id_no",
    )
    return facts.withColumns({c: tidy_upper(F.col(c)) for c in ("designation", "state", "user_mark")})


def with_identity(parties: DataFrame, id_type: DataFrame) -> DataFrame:
    """Countries, identity type and identity number, read from a structured code or else from the columns of their own.

    The number's test reads either code, the number itself only the party's: a user's structured code gives no number. The
    type is the label of the code's letter, else the type on file, else ``OTHER``.
    """
    code, number = F.col("party_code"), F.col("party_id_no")
    x = parties.withColumns(
        {
            "home_country_code": code_part(code, 5, F.col("party_residence")),
            "nationality_code": code_part(code, 3, F.col("party_nationality")),
            "_type_letter": F.substring(code, 2, 1),
            "clean_id_no": clean_text(number),
            "id_number": F.when(
                has_structured_code(F.col("any_code")), F.nullif(F.substr(code, F.lit(7)), F.lit(""))
            ).otherwise(F.coalesce(number, clean_text(F.col("any_code")))),
        }
    )
    x = lookup(x, id_type, {"_type_letter": "type_id"}, {"idtype_label": "_label"}, unique=True)
    # A label is only asked for where the code is structured, so only there may a duplicate fail.
    label = F.when(has_structured_code(code), F.col("_label")).otherwise(F.coalesce("party_id_type", F.lit("OTHER")))
    return x.withColumn("identity_type", label).drop("_label", "_type_letter")


def with_domain(parties: DataFrame, category: DataFrame) -> DataFrame:
    return lookup(parties, category, {"join_category": "category_code"}, {"domain_code": "domain_code"})


def with_categories(parties: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Own category, and the head category that owns it."""
    owners = t["category_relation"].where((F.col("relation_type") == "OWNER") & (F.col("status") == "Y"))
    x = lookup(parties, owners, {"join_category": "to_category"}, {"from_category": "head_category_code"})
    x = lookup(x, t["category"], {"join_category": "category_code"}, {"category_name": "category_name", "sequence_no": "hierarchical_level"})
    return lookup(x, t["category"], {"head_category_code": "category_code"}, {"category_name": "head_category_name"})


def with_grade(df: DataFrame, grade: DataFrame, code: str) -> DataFrame:
    return lookup(df, grade.where(F.col("status") == "Y"), {code: "grade_code"}, {"grade_name": "grade_name"})


def route_identity(identity_type: Column, number: Column) -> tuple[Column, Column]:
    """The passport field and the other-identity field: the number is in one of them, the other is blank."""
    passport = decode(identity_type, "PASSPORT", number, default=F.lit(" "))
    other = decode(identity_type, "PASSPORT", F.lit(None).cast("string"), default=number)
    return passport, other


def eligible(parties: DataFrame, primary_only: bool = False) -> DataFrame:
    """Subscribers and channel users, neither they nor the wallet closed; a missing status does not pass."""
    kept = parties.where(
        F.col("user_type").isin(*OUTPUT_TYPES) & (F.col("status") != "N") & (F.col("wallet_status") != "N")
    )
    return kept.where(F.col("wallet_primary") == "Y") if primary_only else kept


def maybe_key(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows of one phone number, or all of them."""
    return df if value == ALL else df.where(F.col(col) == value)
