"""Source tables: expected columns, and one reader for parquet and JDBC sources.

A source config names two routes, since the account extracts may read from a second database::

    {"main": {"format": "parquet", "base": "/lake/ledger"},
     "accounts": {"format": "jdbc", "options": {"url": ..., "driver": ...},
                  "tables": {"wallet": {"partitionColumn": ..., "numPartitions": ...}}}}

A missing ``accounts`` route means the main one. Empty text is read as missing. A source that cannot hold empty text (any
copy of a database that stores it as missing) should say so with ``"empty_text": False``: its columns are then used bare,
so that tests on them reach the scan, and bucketing and runtime filters on keys apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .splits import table_predicates

# Physical table names in the source databases.
PHYSICAL_NAMES = {
    "txn_header": "mtx_transaction_header",
    "txn_item": "mtx_transaction_items",
    "wallet": "mtx_wallet",
    "wallet_balance": "mtx_wallet_balances",
    "party": "mtx_party",
    "channel_user": "users",
    "category": "mtx_categories",
    "category_relation": "mtx_category_relations",
    "control_profile": "mtx_trf_cntrl_profile",
    "grade": "channel_grades",
    "payment_subtype": "sys_payment_method_subtypes",
    "service_type": "sys_service_types",
    "system_preference": "mtx_system_preferences",
    "country": "imt_country_code",
    "id_type": "dbref_idtypes",
    "tag_rule": "dbref_tags",
    "env_param": "dbref_var_env",
    "network": "networks",
    "receiver_kyc": "recieverkyc",
    "unreg_user": "mtx_unreg_user",
    "replica_stat": "v$dataguard_stats",
}

# Columns used per table. A bare name is text; ":t" a timestamp, ":n" a decimal, ":i" an integer. ":c" is text
# that is only ever tested for equality with a non-empty constant: empty or missing, it fails alike, so it is never wrapped.
_COLUMNS = {
    "txn_header": "transfer_id transfer_date:t created_on:t created_by modified_on:t transfer_subtype transfer_status:c"
    " reconciliation_by service_type:c attr_2_name:c attr_2_value reference_number",
    "txn_item": "transfer_id transfer_date:t transaction_type:c party_id second_party account_id wallet_number"
    " transfer_value:n requested_value:n previous_balance:n post_balance:n pseudo_user_id unreg_user_id txn_mode"
    " service_type transfer_subtype transfer_status:c category_code",
    "wallet": "wallet_number user_id user_type msisdn is_primary:c status created_on:t modified_on:t created_by"
    " mpay_profile_id payment_type_id user_grade",
    "wallet_balance": "wallet_number wallet_sequence_number:i balance:n",
    "party": "user_id user_type msisdn user_name last_name address1 address2 city external_code residence_country"
    " nationality id_type id_no state designation dob:t created_on:t created_by modified_on:t gender status"
    " category_code network_code remarks ret_msisdn batch_id",
    "channel_user": "user_id user_type msisdn user_name last_name address1 address2 city designation state dob:t"
    " created_on:t created_by level2_approved_on:t modified_approved_on:t agent_code gender status category_code"
    " network_code external_code bulk_id batch_id",
    "category": "category_code category_name category_type:c domain_code sequence_no:i",
    "category_relation": "from_category to_category relation_type:c status:c",
    "control_profile": "profile_id max_balance:n grade_code",
    "grade": "grade_code grade_name status:c",
    "payment_subtype": "payment_type_id subtype_name",
    "service_type": "service_type is_financial:c",
    "system_preference": "preference_code:c default_value",
    "country": "id:i country_iso description currency_iso status:c",
    "id_type": "type_id idtype_label",
    "tag_rule": "tag_id:i tag_name transfer_subtype service_type sender_user_id sender_designation"
    " receiver_designation sender_domain_code receiver_domain_code sender_state receiver_state not_receiver_state"
    " reference_number2 source_txn_id",
    "env_param": "param_key:c param_val_text",
    "network": "network_code",
    "receiver_kyc": "p2p_transfer_id agcout_transfer_id rec_fname rec_lname rec_dob:t rec_idno",
    "unreg_user": "unreg_user_id msisdn",
    "replica_stat": "name:c value datum_time",
}
_TYPES = {"": "string", "c": "string", "t": "timestamp_ntz", "n": "decimal(38,6)", "i": "int"}

SCHEMAS = {
    table: {name: _TYPES[kind] for name, _, kind in (c.partition(":") for c in columns.split())}
    for table, columns in _COLUMNS.items()
}
_CODES = {
    table: {c[:-2] for c in columns.split() if c.endswith(":c")} for table, columns in _COLUMNS.items()
}


def conform(df: DataFrame, table: str, empty_text: bool = True) -> DataFrame:
    """The table's columns in their types. Empty text becomes missing, absent columns too; decimals keep their scale."""
    present = {f.name.lower(): (f"`{f.name}`", f.dataType.simpleString()) for f in df.schema.fields}
    out = []
    for name, kind in SCHEMAS[table].items():
        c, held = present.get(name, ("null", None))
        if held is None or not (held == kind or (kind.startswith("decimal") and held.startswith("decimal"))):
            c = f"cast({c} as {kind})"
        if held and kind == "string" and empty_text and name not in _CODES[table]:
            c = f"nullif({c}, '')"
        out.append(f"{c} as {name}")
    return df.selectExpr(*out)


def _read(spark: SparkSession, table: str, route: dict) -> DataFrame:
    own = dict(route.get("tables", {}).get(table, {}))
    kind = own.pop("format", route.get("format", "parquet"))
    if kind == "jdbc":
        # Partitioned reading is per table: by column bounds (reader options), by a list of predicates, or by ranges of equal
        # row counts of the column that ``split_by`` names with their number, as {"column": ..., "parts": ...}.
        predicates, split = own.pop("predicates", None), own.pop("split_by", None)
        options = {"preferTimestampNTZ": "true", **route.get("options", {}), "dbtable": PHYSICAL_NAMES[table], **own}
        if split:
            predicates = table_predicates(spark, {k: v for k, v in options.items() if k != "dbtable"}, PHYSICAL_NAMES[table], **split)
        if predicates:
            url, name = options.pop("url"), options.pop("dbtable")
            return spark.read.jdbc(url, name, predicates=predicates, properties=options)
        return spark.read.format("jdbc").options(**options).load()
    path = own.pop("path", None) or f"{route['base'].rstrip('/')}/{table}"
    return spark.read.format(kind).options(**{**route.get("options", {}), **own}).load(path)


# Histories of which a copy in order of transfer id may be kept, and what that copy goes by among the tables.
BY_ID = {table: f"{table}.by_id" for table in ("txn_item", "txn_header")}


def load_tables(spark: SparkSession, config: dict, route: str = "main") -> dict[str, DataFrame]:
    """All source tables of one route, conformed. Nothing is read until an extract uses it.

    A route's ``by_id`` names a folder with copies of ``BY_ID`` tables, written from conformed rows by ``append_by_id`` and kept
    up to date with them.
    """
    source = config.get(route) or config["main"]
    empty_text = source.get("empty_text", True)
    tables = {table: conform(_read(spark, table, source), table, empty_text) for table in SCHEMAS}
    if base := source.get("by_id"):
        for table, name in BY_ID.items():
            tables[name] = conform(spark.read.parquet(f"{base.rstrip('/')}/{table}"), table, empty_text=False)
    return tables
