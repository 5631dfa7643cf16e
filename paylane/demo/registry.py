"""Every operator as a query over the driver's tables, next to the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from ..functions.dates import moment
from ..operators import activity, cohorts, control, geography, ledger, lookups, parties, tags
from ..operators.legs import expanded
from ..operators.layout import Field, fixed_width, quoted_pipe, reserved
from ..params import RunParams
from ..plans import account, control as report, country, customer, transaction
from ..session import prepare, work_dir
from ..sources import BY_ID, SCHEMAS, append_by_id, file_manifest, load_tables, numbered, read_lines, write_lines
from . import oracle as o
from .tables import base_table, demo_tables

Tables = dict[str, DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Queries of the payments tables alone, as functions of those tables.
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}


def _day(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d")


# The ledger runs over the whole history, the customer runs over one year.
WHOLE = RunParams("CI", "DELTA", _day(o.WHOLE[0]), _day(o.WHOLE[1]), ledger_days=(_day(o.WHOLE[1]) - _day(o.WHOLE[0])).days)
YEAR = RunParams(
    "CI", "DELTA", _day(o.YEAR[0]), _day(o.YEAR[1]), ledger_days=(_day(o.YEAR[1]) - _day(o.YEAR[0])).days, activity_days=200
)
FLAGSHIP = RunParams("CI", "DELTA", datetime(2000, 1, 1), datetime(2000, 1, 31), ledger_days=30)


def query(name: str, sql: str | None):
    """Register a function of the payments tables, with its DuckDB counterpart if it has one."""

    def register(build: Callable[[Tables], DataFrame]):
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, sf_dir: build(demo_tables(prepare(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = o.sql(sql)
        return build

    return register


def raw_query(name: str, sql: str | None):
    """Same for a function of the session and the directory."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = o.sql(sql)
        return build

    return register


def dbl(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(30,2)").cast("double")


def sql_dbl(e: str) -> str:
    return f"cast(cast(round({e}, 2) as decimal(30,2)) as double)"


def whole_items(t: Tables) -> DataFrame:
    return ledger.in_run(t["txn_item"], WHOLE.ledger_start, WHOLE.end)


def whole_ledger(t: Tables, all_states: bool = True) -> DataFrame:
    return transaction.ledger(t, WHOLE, all_states, transaction.ledger_legs(t, WHOLE))


def raw_transfers(t: Tables) -> DataFrame:
    """Transfers ``copies`` times each; queries multiply their own few columns."""
    headers = ledger.header_slice(t["txn_header"], WHOLE.ledger_start, WHOLE.end)
    people = parties.with_domain(parties.resolve_parties(t, "party"), t["category"])
    return ledger.assemble_ledger(ledger.open_transfers(headers, transaction.ledger_legs(t, WHOLE), t), people, t)


# ---------------------------------------------------------------- sources and layouts


def _account_lines_written(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "account-lines")
    write_lines(account.extract_account(demo_tables(spark, sf_dir), WHOLE), path, account.ORDER)
    return path


@raw_query("s_manifest", "select cast(strlen(line) + 1 as bigint) as size_bytes, md5(line || chr(10)) as md5 from ora_country_lines")
def s_manifest(spark, sf_dir):
    """One line per file, so that each digest is that of a line."""
    path = work_dir(spark, "country-lines")
    write_lines(country.extract_country(demo_tables(spark, sf_dir)), path, country.ORDER, lines_per_file=1)
    return file_manifest(spark, path).select("size_bytes", "md5")


def _name_column(table: str) -> str:
    return next(c for c, kind in SCHEMAS[table].items() if kind == "string")


@raw_query(
    "s_tables",
    " union all ".join(
        f"select '{table}' as table_name, '{route}' as route, cast(count(*) as bigint) as n_rows,"
        f" cast(count({_name_column(table)}) as bigint) as n_filled, cast(coalesce(sum(length({_name_column(table)})), 0) as bigint) as n_letters from {table}"
        for table in SCHEMAS
        for route in ("main", "accounts")
    ),
)
def s_tables(spark, sf_dir):
    """Every table written and read again by both routes; on the main one missing text has been stored as empty text."""
    t, base = demo_tables(spark, sf_dir), {r: work_dir(spark, f"lake-{r}") for r in ("main", "accounts")}
    for table in SCHEMAS:
        plain = t[table]
        texts = {c: F.coalesce(c, F.lit("")) for c, kind in SCHEMAS[table].items() if kind == "string"}
        plain.withColumns(texts).write.parquet(f"{base['main']}/{table}")
        plain.write.parquet(f"{base['accounts']}/{table}")
    config = {"main": {"base": base["main"]}, "accounts": {"base": base["accounts"], "empty_text": False}}
    rows = None
    for route in ("main", "accounts"):
        for table, df in load_tables(spark, config, route).items():
            name = F.col(_name_column(table))
            counts = df.agg(
                F.count(F.lit(1)).alias("n_rows"), F.count(name).alias("n_filled"), F.coalesce(F.sum(F.char_length(name)), F.lit(0)).alias("n_letters")
            ).select(F.lit(table).alias("table_name"), F.lit(route).alias("route"), "*")
            rows = counts if rows is None else rows.unionByName(counts)
    return rows


@raw_query("s_lines_roundtrip", o.account_lines())
def s_lines_roundtrip(spark, sf_dir):
    return read_lines(spark, _account_lines_written(spark, sf_dir))


@query(
    "p_fixed_width",
    f"""select {o.rp('user_id', 8)} as user_id, {o.glue(o.rp('user_id', 8), o.rp('last_name', 12), o.rp('id_type', 5), "gender")} as line, 'short' as form from party
 union all select {o.rp('user_id', 8)}, {o.glue(o.rp('user_id', 8), f"coalesce({o.rp('last_name', 12)}, {o.sp(12)})", f"coalesce({o.rp('id_type', 5)}, {o.sp(5)})", "gender")}, 'aligned' from party""",
)
def p_fixed_width(t):
    layout = [
        Field("user_id", F.col("user_id"), 8),
        Field("last_name", F.col("last_name"), 12),
        Field("id_type", F.col("id_type"), 5),
        Field("gender", F.col("gender")),
    ]
    short = fixed_width(t["party"], layout, keys=("user_id",)).withColumn("form", F.lit("short"))
    aligned = fixed_width(t["party"], layout, keys=("user_id",), pad_nulls=True).withColumn("form", F.lit("aligned"))
    return short.unionByName(aligned)


@query(
    "p_quoted_pipe",
    "select concat('\"', wallet_number, '\"|\"', '', '\"|', wallet_sequence_number, '|', balance, '|') as line from wallet_balance",
)
def p_quoted_pipe(t):
    rows = t["wallet_balance"].withColumns({"note": F.lit(None).cast("string"), "slot": F.lit(None).cast("double")})
    return quoted_pipe(rows, ["wallet_number", "note"], ["wallet_sequence_number", "balance", "slot"])


@query(
    "p_reserved",
    "select wallet_number, cast(null as varchar) as spare_02, cast(null as varchar) as spare_03, cast(null as double) as spare_number_01 from wallet",
)
def p_reserved(t):
    return t["wallet"].select("wallet_number", *reserved("spare", 2, 3), *reserved("spare_number", 1, 1, "double"))


@query(
    "p_account_key",
    """select wallet_number, left(wallet_number, 2) as business_type, substring(wallet_number, 3, 9) as account_no,
 substring(wallet_number, 12, 9) as business_no from wallet""",
)
def p_account_key(t):
    a, b, c = fx.account_key(F.col("wallet_number"), "XXXX")
    return t["wallet"].select("wallet_number", a.alias("business_type"), b.alias("account_no"), c.alias("business_no"))


@query(
    "p_customer_key",
    "select wallet_number, left(user_type, 1) || coalesce(nullif(msisdn, '22C1'), 'XXXXXXXX') as customer from wallet",
)
def p_customer_key(t):
    phone = F.nullif(F.col("msisdn"), F.lit("22C1"))
    return t["wallet"].select("wallet_number", fx.customer_key(F.col("user_type"), phone, "XXXXXXXX").alias("customer"))


@query(
    "p_short_id",
    """select transfer_id, left(transfer_id, 2) || split_part(transfer_id, '.', 2) as short_id,
 left(created_by, 2) || created_by as short_plain from txn_header""",
)
def p_short_id(t):
    return t["txn_header"].select(
        "transfer_id",
        fx.short_transfer_id(F.col("transfer_id")).alias("short_id"),
        fx.short_transfer_id(F.col("created_by")).alias("short_plain"),
    )


@raw_query(
    "p_text_split",
    "select doc_id, nullif(substring(text, 1, 64), '') as head, nullif(substring(text, 65), '') as tail from documents",
)
def p_text_split(spark, sf_dir):
    text = F.col("text")
    return base_table(spark, sf_dir, "documents").select(
        "doc_id", fx.text_head(text, 64).alias("head"), fx.text_tail(text, 64).alias("tail")
    )


# ---------------------------------------------------------------- filters


@query("f_window", f"select transfer_id, transfer_date from txn_header where {o.span('transfer_date', o.YEAR)}")
def f_window(t):
    return t["txn_header"].where(fx.in_window(F.col("transfer_date"), YEAR.start, YEAR.end)).select("transfer_id", "transfer_date")


@query(
    "f_maybe_key",
    "select 'one' as asked, transfer_id, transaction_type from txn_item where account_id = '22S1' union all select 'all', transfer_id, transaction_type from txn_item",
)
def f_maybe_key(t):
    def asked(label, value):
        return parties.maybe_key(t["txn_item"], "account_id", value).select(
            F.lit(label).alias("asked"), "transfer_id", "transaction_type"
        )

    return asked("one", "22S1").unionByName(asked("all", "ALL"))


@query("f_settled", f"select transfer_id, {o.settled('h')} as settled from txn_header h")
def f_settled(t):
    return ledger.with_settled(t["txn_header"]).select("transfer_id", "settled")


@query(
    "f_eligible",
    f"select wallet_number, user_type, wallet_primary from ora_people where {o._FINE}",
)
def f_eligible(t):
    return parties.eligible(parties.resolve_parties(t)).select("wallet_number", "user_type", "wallet_primary")


@query("f_changed", f"select wallet_number, coalesce({o._CHANGED}, false) as changed from ora_people")
def f_changed(t):
    changed = fx.changed_in_window(
        F.col("creation_date"), F.col("modification_date"), F.col("wallet_modified_on"), YEAR.start, YEAR.end
    )
    return parties.resolve_parties(t).select("wallet_number", F.coalesce(changed, F.lit(False)).alias("changed"))


@query(
    "f_cash_flag",
    """select transfer_id, case when starts_with(tag, 'CASHIN') or contains(tag, 'CASHOUT') then 'Y' else 'N' end as cash
 from (select transfer_id, case when reference_number is null then null when attr_2_value = 'Y' then transfer_subtype || '_CASHOUT' else transfer_subtype end as tag from txn_header)""",
)
def f_cash_flag(t):
    tag = F.when(F.col("attr_2_value") == "Y", F.concat("transfer_subtype", F.lit("_CASHOUT"))).otherwise(F.col("transfer_subtype"))
    tag = F.when(F.col("reference_number").isNotNull(), tag)
    return t["txn_header"].select("transfer_id", fx.cash_flag(tag).alias("cash"))


# ---------------------------------------------------------------- joins


@query(
    "j_pair_legs",
    f"select transfer_id, kind, receiver as receiver_user_id, sender as sender_user_id, s_wallet as sender_wallet, r_wallet as receiver_wallet, {sql_dbl('val')} as value from ora_pairs",
)
def j_pair_legs(t):
    return ledger.pair_legs(whole_items(t)).select(
        "transfer_id", "kind", "receiver_user_id", "sender_user_id", "sender_wallet", "receiver_wallet", dbl("transfer_value").alias("value")
    )


PEOPLE = ("wallet_number", "user_type", "msisdn", "user_id", "status", "designation", "state", "user_mark", "creation_date", "modification_date", "created_on")


@query(
    "j_parties",
    f"select {', '.join(PEOPLE)}, network_u as network_user_first, network_p as network_party_first, cat_name as category_name, head_code as head_category_code, head_name as head_category_name from ora_people",
)
def j_parties(t):
    both = parties.with_categories(parties.resolve_parties(t, "user"), t)
    # A wallet number held twice has one network here, so distinct rows match each wallet once.
    other = parties.resolve_parties(t, "party").select("wallet_number", F.col("network_code").alias("network_party_first")).distinct()
    return both.join(other, "wallet_number").select(
        *PEOPLE,
        F.col("network_code").alias("network_user_first"),
        "network_party_first",
        "category_name",
        "head_category_code",
        "head_category_name",
    )


ACTIVE_WALLETS = "select wallet_number, user_id from wallet where wallet_number in (select wallet_number from ora_moving)"


@query("j_active_wallets", ACTIVE_WALLETS)
def j_active_wallets(t):
    return ledger.active_wallets(t["wallet"], whole_items(t), t["txn_header"], t.get(BY_ID["txn_header"])).select("wallet_number", "user_id")


@query("j_reactivated", "select user_id, msisdn from ora_back")
def j_reactivated(t):
    return cohorts.reactivated(t, YEAR.start, YEAR.end, YEAR.dormant_days)


@query(
    "j_cohort_users",
    "select p.wallet_number, p.user_id, p.msisdn from ora_people p where exists (select 1 from ora_active_90 a where a.user_id = p.user_id and a.msisdn = p.msisdn)",
)
def j_cohort_users(t):
    active = cohorts.active_users(t, datetime(2000, 4, 2), YEAR.end)
    return cohorts.cohort_users(parties.resolve_parties(t), active).select("wallet_number", "user_id", "msisdn")


def year_activity(t: Tables) -> DataFrame:
    return activity.activity_profile(activity.activity_ledger(t, YEAR), t["network"], YEAR.end, YEAR.activity_days)


@query(
    "j_activity",
    f"""select user_id, user_type, {sql_dbl('debit')} as total_debit, {sql_dbl('credit')} as total_credit, debit_on as max_debit_date,
 credit_on as max_credit_date, greatest(debit_on, credit_on) as last_transfer_date from ({o.activity(YEAR.activity_days)})""",
)
def j_activity(t):
    return year_activity(t).select(
        "user_id",
        "user_type",
        dbl("total_debit").alias("total_debit"),
        dbl("total_credit").alias("total_credit"),
        "max_debit_date",
        "max_credit_date",
        "last_transfer_date",
    )


@query(
    "j_ledger",
    f"""select transfer_id, s_wallet as sender_wallet, r_wallet as receiver_wallet, s_type as sender_type, r_type as receiver_type,
 {sql_dbl('amount')} as amount, {sql_dbl('charged')} as total_charge, done as settled from ora_transfers""",
)
def j_ledger(t):
    rows = raw_transfers(t).select(
        "transfer_id",
        "sender_wallet",
        "receiver_wallet",
        "sender_type",
        "receiver_type",
        dbl(F.round("amount", 2)).alias("amount"),
        dbl(F.round("total_charge", 2)).alias("total_charge"),
        "settled",
        "copies",
    )
    return expanded(rows)


@query("j_tags", "select transfer_id, s_wallet as sender_wallet, r_wallet as receiver_wallet, tag as tag_name from ora_tagged")
def j_tags(t):
    return expanded(whole_ledger(t).select("transfer_id", "sender_wallet", "receiver_wallet", "tag_name", "copies"))


@query(
    "j_lookup",
    f"""select w.wallet_number, {sql_dbl('cp.max_balance')} as max_balance, cp.grade_code, g.grade_name, ps.subtype_name
 from wallet w left join control_profile cp on cp.profile_id = w.mpay_profile_id left join grade g on g.grade_code = cp.grade_code and g.status = 'Y'
 left join payment_subtype ps on ps.payment_type_id = w.payment_type_id""",
)
def j_lookup(t):
    x = lookups.lookup(t["wallet"], t["control_profile"], {"mpay_profile_id": "profile_id"}, {"max_balance": "max_balance", "grade_code": "grade_code"})
    x = parties.with_grade(x, t["grade"], "grade_code")
    x = lookups.lookup(x, t["payment_subtype"], {"payment_type_id": "payment_type_id"}, {"subtype_name": "subtype_name"})
    return x.select("wallet_number", dbl("max_balance").alias("max_balance"), "grade_code", "grade_name", "subtype_name")


@query(
    "j_valid_country",
    """select wallet_number, home, nation, home in (select country_iso from country where status = 'Y') and home is not null as home_valid,
 nation in (select country_iso from country where status = 'Y') and nation is not null as nation_valid from (
 select wallet_number, home, nation from ora_people where home is not null and nation is not null
 union all select wallet_number, home, nation from ora_people where home is null and nation is null)""",
)
def j_valid_country(t):
    x = parties.with_identity(parties.resolve_parties(t), t["id_type"]).select(
        "wallet_number", F.col("home_country_code").alias("home"), F.col("nationality_code").alias("nation")
    )
    x = lookups.valid_country(x, t["country"], "home", "home_valid")
    return lookups.valid_country(x, t["country"], "nation", "nation_valid")


@query(
    "j_params",
    f"""select wallet_number, wallet_sequence_number, {sql_dbl('balance * 0.01')} as balance, (select max(param_val_text) from env_param where param_key = 'CURRENCY_CODE') as local_currency,
 (select max(param_val_text) from env_param where param_key = 'COMPLIANCE_INSTITUTE') as home_country from wallet_balance""",
)
def j_params(t):
    x = lookups.with_params(t["wallet_balance"], t)
    return x.select(
        "wallet_number",
        "wallet_sequence_number",
        dbl(F.round(F.col("balance") / F.col("factor"), 2)).alias("balance"),
        "local_currency",
        "home_country",
    )


@query("j_unique_lookup", "select wallet_number, idtype as identity_type from ora_people")
def j_unique_lookup(t):
    return parties.with_identity(parties.resolve_parties(t), t["id_type"]).select("wallet_number", "identity_type")


@query("j_unregistered", "select distinct unreg_user_id, msisdn, p2p_transfer_id as transfer_id, rec_fname, rec_lname, rec_idno, rec_dob from ora_unreg")
def j_unregistered(t):
    return cohorts.unregistered_receivers(t, YEAR.start, YEAR.end).select(
        "unreg_user_id", "msisdn", "transfer_id", "rec_fname", "rec_lname", "rec_idno", "rec_dob"
    )


@query(
    "j_balance",
    f"select w.wallet_number, w.user_id, {sql_dbl('b.balance')} as balance from wallet w, wallet_balance b where w.wallet_number = b.wallet_number and b.wallet_sequence_number = 0",
)
def j_balance(t):
    return account.with_balance(t["wallet"], t["wallet_balance"]).select("wallet_number", "user_id", dbl("balance").alias("balance"))


# ---------------------------------------------------------------- aggregates, windows, order, sets


@query(
    "a_keep_first",
    """select i.party_id, max(i.transfer_id) as first_transfer from txn_item i
 join (select party_id, min(transfer_value) as least from txn_item group by party_id) m on m.party_id = i.party_id and i.transfer_value = m.least
 group by i.party_id""",
)
def a_keep_first(t):
    first = tags.max_keep_first(F.col("transfer_id"), F.col("transfer_value"))
    return t["txn_item"].groupBy("party_id").agg(first.alias("first_transfer"))


@query("a_line_count", f"select cast(count(*) as bigint) as n_lines from ({o.account_lines()})")
def a_line_count(t):
    return control.line_count(account.extract_account(t, WHOLE))


@query(
    "a_volume_class",
    f"""select user_id, user_type, case when debit >= lim or credit >= lim then 'F' else 'L' end as volume_class
 from ({o.activity(YEAR.activity_days)}), (select case when max(network_code) = 'GC' then 2500000 else 200000 end as lim from network)""",
)
def a_volume_class(t):
    return year_activity(t).select("user_id", "user_type", "volume_class")


@query(
    "w_total_charge",
    f"select transfer_id, kind, s_wallet as sender_wallet, r_wallet as receiver_wallet, {sql_dbl('charged')} as total_charge from ora_pairs",
)
def w_total_charge(t):
    # Pairs are asked for their wallets here, and charges are told by the service.
    legs = transaction.run_legs(t, WHOLE, carried=("wallet_number", "service_type"))
    x = ledger.total_charge(ledger.pair_legs(legs), legs, lookups.currency_factor(t))
    return expanded(x.select("transfer_id", "kind", "sender_wallet", "receiver_wallet", dbl(F.round("total_charge", 2)).alias("total_charge"), "copies"))


def _runs(lines: str, key: str) -> str:
    return f"""select coalesce(sum(case when k <> prior then 1 else 0 end), 0) from (
 select k, lag(k, 1, '') over (order by line) as prior from (select line, trim(coalesce({key}, '')) as k from ({lines})))"""


@query("w_run_count", f"select cast(({_runs(o.transaction_lines(), 'substring(line, 50, 29)')}) as bigint) as n_runs")
def w_run_count(t):
    lines = transaction.extract_transaction(t, WHOLE, whole_ledger(t, all_states=False))
    key = F.concat("entry_date", "value_date", F.substring("transfer_no", 1, 13))
    return control.run_count(lines, key, transaction.ORDER)


@query("o_total_order", f"select line, row_number() over (order by line) - 1 as position from ({o.account_lines()})")
def o_total_order(t):
    return numbered(account.extract_account(t, WHOLE), account.ORDER).select("line", "position")


@query(
    "u_two_sided",
    f"""select transfer_id, 'D' as side, s_wallet as own_wallet, r_wallet as contra_wallet, {sql_dbl('-amount')} as signed_amount from ora_transfers
 union all select transfer_id, 'C', r_wallet, s_wallet, {sql_dbl('amount')} from ora_transfers""",
)
def u_two_sided(t):
    sides = ledger.two_sided(raw_transfers(t)).select(
        "transfer_id", "side", "own_wallet", "contra_wallet", dbl(F.round("signed_amount", 2)).alias("signed_amount"), "copies"
    )
    return expanded(sides)


@query("u_cohorts", f"select wallet_number, user_id, msisdn from ({o.reported('DELTA')})")
def u_cohorts(t):
    users = parties.eligible(parties.resolve_parties(t), primary_only=True)
    return customer.reported_users(users, t, YEAR).select("wallet_number", "user_id", "msisdn")


# ---------------------------------------------------------------- scalars


@query(
    "x_decode",
    """select transfer_id, case when reconciliation_by is null then 'open' when reconciliation_by = 'OP1' then 'first' else 'other' end as by_whom,
 case transfer_status when 'TS' then 1 when 'TF' then 2 else 3 end as rank from txn_header""",
)
def x_decode(t):
    by_whom = fx.decode(F.col("reconciliation_by"), None, "open", "OP1", "first", default=F.lit("other"))
    rank = fx.decode(F.col("transfer_status"), "TS", 1, "TF", 2, default=F.lit(3))
    return t["txn_header"].select("transfer_id", by_whom.alias("by_whom"), rank.alias("rank"))


@query("x_rpad", f"select user_id, {o.rp('user_name', 24)} as wide, {o.rp('user_name', 5)} as narrow, {o.rp('last_name', 12)} as maybe from party")
def x_rpad(t):
    name = F.col("user_name")
    return t["party"].select("user_id", fx.pad(name, 24).alias("wide"), fx.pad(name, 5).alias("narrow"), fx.pad(F.col("last_name"), 12).alias("maybe"))


@query(
    "x_money_text",
    f"select transfer_id, transaction_type, {o.money('transfer_value * 0.01')} as credit, {o.money('-transfer_value * 0.01')} as debit from txn_item",
)
def x_money_text(t):
    amount = F.col("transfer_value") / F.lit(100).cast("decimal(20,6)")
    return t["txn_item"].select("transfer_id", "transaction_type", fx.money_text(amount).alias("credit"), fx.money_text(-amount).alias("debit"))


@raw_query(
    "x_padded_id",
    "select o_orderkey, case when o_custkey > 999 then '###' else printf('%03d', o_custkey) end as padded from orders",
)
def x_padded_id(spark, sf_dir):
    return base_table(spark, sf_dir, "orders").select("o_orderkey", fx.padded_id(F.col("o_custkey")).alias("padded"))


@query(
    "x_sentinel_date",
    "select user_id, case when dob is null then '        ' when dob < timestamp '1955-01-01' then '19000101' else strftime(dob, '%Y%m%d') end as born_on from party",
)
def x_sentinel_date(t):
    # Old dates stand in for unset ones.
    text = F.when(F.col("dob") < moment(datetime(1955, 1, 1)), "00000000").otherwise(fx.day_text(F.col("dob")))
    return t["party"].select("user_id", fx.sentinel_date(text).alias("born_on"))


FIELDS = (1, 4, 5, 6, 12)


@query(
    "x_field_k",
    f"select transfer_id, transaction_type, {', '.join(o.hash_field('txn_mode', k) + f' as field_{k}' for k in FIELDS)} from txn_item",
)
def x_field_k(t):
    return t["txn_item"].select(
        "transfer_id", "transaction_type", *[fx.field_k(F.col("txn_mode"), k).alias(f"field_{k}") for k in FIELDS]
    )


@query("x_first_field_one", f"select transfer_id, transaction_type, {o.starts_one('txn_mode')} as is_one from txn_item")
def x_first_field_one(t):
    return t["txn_item"].select("transfer_id", "transaction_type", fx.first_field_is_one(F.col("txn_mode")).alias("is_one"))


@query("x_id_code", "select wallet_number, home, nation, id_no2 as id_number from ora_people")
def x_id_code(t):
    return parties.with_identity(parties.resolve_parties(t), t["id_type"]).select(
        "wallet_number", F.col("home_country_code").alias("home"), F.col("nationality_code").alias("nation"), "id_number"
    )


_PLAIN = "translate(text, '{0}', '{1}')".format(
    "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
)


@raw_query(
    "x_clean_text",
    f"select doc_id, nullif(replace(replace(regexp_replace({_PLAIN}, '[^\\x00-\\x7F]', '?', 'g'), chr(10), ' '), chr(13), ' '), '') as clean from documents",
)
def x_clean_text(spark, sf_dir):
    return base_table(spark, sf_dir, "documents").select("doc_id", fx.clean_text(F.col("text")).alias("clean"))


@query(
    "x_lag_seconds",
    """select name, value, datum_time, cast(cast(substring(value, 1, 3) as int) * 86400 + cast(substring(value, 5, 2) as int) * 3600
 + cast(substring(value, 8, 2) as int) * 60 + cast(substring(value, 11, 2) as int) as double) as seconds from replica_stat""",
)
def x_lag_seconds(t):
    return t["replica_stat"].select("name", "value", "datum_time", fx.lag_seconds(F.col("value")).cast("double").alias("seconds"))


@query("x_gender", "select user_id, coalesce(nullif(substring(gender, 5, 1), ''), ' ') as letter, ' ' as none from party")
def x_gender(t):
    return t["party"].select(
        "user_id", fx.gender_letter(F.col("gender")).alias("letter"), fx.gender_letter(F.substring("gender", 1, 4)).alias("none")
    )


_DOW = "((isodow(o_orderdate) + 1) % 7 + 1)"


@raw_query(
    "x_week_of_month",
    f"""select o_orderkey, cast({_DOW} as int) as day_no,
 cast(ceil((day(o_orderdate) + {_DOW} - case when isodow(date_trunc('month', o_orderdate)) = 7 then 1 else 0 end) / 7.0) as int) as week_no from orders""",
)
def x_week_of_month(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return base_table(spark, sf_dir, "orders").select(
        "o_orderkey", fx.day_of_week_from_saturday(d).alias("day_no"), fx.week_of_month(d).alias("week_no")
    )


@raw_query(
    "x_duration",
    """select event_id, case when s >= 172800 then (s // 86400) || ' days, ' when s >= 86400 then '1 day, ' else '' end
 || ((s % 86400) // 3600) || ':' || lpad(cast((s % 3600) // 60 as varchar), 2, '0') || ':' || lpad(cast(s % 60 as varchar), 2, '0') as took
 from (select event_id, event_id * 37 as s from events)""",
)
def x_duration(spark, sf_dir):
    return base_table(spark, sf_dir, "events").select("event_id", fx.duration_text(F.col("event_id") * 37).alias("took"))


# ---------------------------------------------------------------- business rules


@query(
    "t_geography",
    """select transfer_id, s_wallet as sender_wallet, r_wallet as receiver_wallet, s_country as sender_country, s_currency as sender_currency,
 r_country as receiver_country, r_currency as receiver_currency from ora_located""",
)
def t_geography(t):
    rows = geography.derive_geography(raw_transfers(t), t).select(
        "transfer_id", "sender_wallet", "receiver_wallet", "sender_country", "sender_currency", "receiver_country", "receiver_currency", "copies"
    )
    return expanded(rows)


@query(
    "t_asof",
    f"""select transfer_id, case when date_trunc('day', modified_on) >= date_trunc('day', transfer_date) and modified_on < timestamp '{o.YEAR[1]}'
 then cast(date_trunc('day', modified_on) as timestamp) else cast(date_trunc('day', transfer_date) as timestamp) end as as_of_date
 from txn_header where {o.span('transfer_date', o.YEAR)}""",
)
def t_asof(t):
    return ledger.header_slice(t["txn_header"], YEAR.start, YEAR.end).select("transfer_id", "as_of_date")


@query(
    "t_reclassify",
    """select transfer_id, transaction_type, party_id, second_party, case when transaction_type = 'MR' and service_type in ('ROLLBACK', 'TXNCORRECT') then
 case when party_id = 'IND03' then 'CR' when second_party = 'IND03' then 'SCR' else 'MR' end else transaction_type end as final_type from txn_item""",
)
def t_reclassify(t):
    final = fx.reclassify(F.col("transaction_type"), F.col("service_type"), F.col("party_id"), F.col("second_party"))
    return t["txn_item"].select("transfer_id", "transaction_type", "party_id", "second_party", final.alias("final_type"))


LATE_PAIRS = f"select transfer_id, kind, s_wallet as sender_wallet, r_wallet as receiver_wallet from ({o.pairs(None, 'ora_late_items')})"


@query("t_late", LATE_PAIRS)
def t_late(t):
    late = ledger.late_headers(t["txn_header"], YEAR.start, YEAR.end)
    return ledger.pair_legs(ledger.items_of(t["txn_item"], late, t.get(BY_ID["txn_item"]))).select("transfer_id", "kind", "sender_wallet", "receiver_wallet")


class TablesById(Mapping):
    """The payments tables with copies of items and headers in order of transfer id, kept for the query; each is built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._tables, self._copies = spark, demo_tables(spark, sf_dir), {}

    def __getitem__(self, name: str) -> DataFrame:
        table = next((table for table, copy in BY_ID.items() if copy == name), None)
        if table is None:
            return self._tables[name]
        if name not in self._copies:
            rows, path = self._tables[table], f"{work_dir(self._spark, 'by-id')}/{table}"
            append_by_id(rows, path)
            self._copies[name] = self._spark.read.schema(rows.schema).parquet(path)
        return self._copies[name]

    def __iter__(self):
        return iter([*self._tables, *BY_ID.values()])

    def __len__(self):
        return len(self._tables) + len(BY_ID)


def tables_by_id(spark: SparkSession, sf_dir: str) -> Tables:
    return TablesById(spark, sf_dir)


@raw_query("t_late_by_id", LATE_PAIRS)
def t_late_by_id(spark, sf_dir):
    """As ``t_late``, with the items looked up in their copy by transfer id."""
    return t_late(tables_by_id(spark, sf_dir))


@raw_query("j_active_wallets_by_id", ACTIVE_WALLETS)
def j_active_wallets_by_id(spark, sf_dir):
    """As ``j_active_wallets``, with the headers looked up in their copy by transfer id."""
    return j_active_wallets(tables_by_id(spark, sf_dir))


@query(
    "t_scale",
    f"select transfer_id, transaction_type, {sql_dbl('coalesce(case when txn_mode is not null then requested_value end * 0.01, 0)')} as amount from txn_item",
)
def t_scale(t):
    asked = F.when(F.col("txn_mode").isNotNull(), F.col("requested_value"))
    return t["txn_item"].select(
        "transfer_id", "transaction_type", dbl(F.round(fx.scale(asked, lookups.currency_factor(t)), 2)).alias("amount")
    )


@query(
    "t_currency",
    """select t.transfer_id, t.s_wallet as sender_wallet, t.r_wallet as receiver_wallet, 'XOF' as account_currency,
 coalesce(sc.currency_iso, case when s_currency <> 'NA' then s_currency end, 'XOF') as shown,
 case when r_currency is null then 'XX' when r_currency = 'NA' then coalesce(rc.currency_iso, 'XX') else r_currency end as contra
 from ora_located t left join country sc on sc.country_iso = t.s_country left join country rc on rc.country_iso = t.r_country""",
)
def t_currency(t):
    x = geography.with_mapped_currency(geography.derive_geography(raw_transfers(t), t), t["country"])
    local = F.col("local_currency")
    rows = x.select(
        "transfer_id",
        "sender_wallet",
        "receiver_wallet",
        geography.account_currency(local).alias("account_currency"),
        geography.display_currency(F.col("sender_mapped"), F.col("sender_currency"), local).alias("shown"),
        geography.contra_currency(F.col("receiver_currency"), F.col("receiver_mapped")).alias("contra"),
        "copies",
    )
    return expanded(rows)


@query(
    "t_party_type",
    "select transfer_id, transaction_type, case when pseudo_user_id is null then category_code else 'PSEUDO' end as kind from txn_item",
)
def t_party_type(t):
    kind = fx.party_type(F.col("pseudo_user_id"), F.col("category_code"))
    return t["txn_item"].select("transfer_id", "transaction_type", kind.alias("kind"))


@query(
    "t_identity",
    "select wallet_number, case when idtype = 'PASSPORT' then id_no2 else ' ' end as passport, case when coalesce(idtype, '') <> 'PASSPORT' then id_no2 end as other from ora_people",
)
def t_identity(t):
    x = parties.with_identity(parties.resolve_parties(t), t["id_type"])
    passport, other = parties.route_identity(F.col("identity_type"), F.col("id_number"))
    return x.select("wallet_number", passport.alias("passport"), other.alias("other"))


# ---------------------------------------------------------------- cohorts, extracts, control


@query("c_active_users", "select user_id, msisdn from ora_during")
def c_active_users(t):
    return cohorts.active_users(t, YEAR.start, YEAR.end)


for _mode in ("DELTA", "FULLACTIVE", "FULL", "DELTAMONTH", "REGEN"):
    _p = replace(YEAR, mode=_mode)
    _name = _mode.lower()
    query(f"c_customer_{_name}", o.customer_lines(_mode))(lambda t, p=_p: customer.extract_customer(t, p).select("line"))
    _ext = "c_customer_ext" if _mode == "DELTA" else f"c_customer_ext_{_name}"
    query(_ext, o.customer_ext_lines(_mode))(lambda t, p=_p: customer.extract_customer_ext(t, p).select("line"))


@query("c_account", o.account_lines())
def c_account(t):
    return account.extract_account(t, WHOLE).select("line")


@query("c_account_ext", o.account_ext_lines())
def c_account_ext(t):
    return account.extract_account_ext(t, WHOLE).select("line")


@query("c_transaction", o.transaction_lines())
def c_transaction(t):
    return expanded(transaction.extract_transaction(t, WHOLE, whole_ledger(t, all_states=False)).select("line", "copies"))


@query("c_transaction_ext", o.transaction_ext_lines())
def c_transaction_ext(t):
    return expanded(transaction.extract_transaction_ext(t, WHOLE, whole_ledger(t, all_states=False)).select("line", "copies"))


# Runs for one phone number.
ONE_USER, ONE_SELLER = "22C22", "22S3"


@query("c_customer_phone", o.customer_lines("DELTA", f"msisdn = '{ONE_USER}'"))
def c_customer_phone(t):
    return customer.extract_customer(t, replace(YEAR, msisdn=ONE_USER)).select("line")


@query("c_account_phone", f"select line from ({o.account_lines()}) where substring(line, 6, 15) = rpad('{ONE_SELLER}', 15, ' ')")
def c_account_phone(t):
    return account.extract_account(t, replace(WHOLE, msisdn=ONE_SELLER)).select("line")


@query("c_transaction_phone", f"select line from ({o.transaction_lines()}) where substring(line, 6, 15) = rpad('{ONE_SELLER}', 15, ' ')")
def c_transaction_phone(t):
    return expanded(transaction.extract_transaction(t, replace(WHOLE, msisdn=ONE_SELLER)).select("line", "copies"))


country_lines = o.country_lines


@query("c_country", country_lines())
def c_country(t):
    return country.extract_country(t).select("line")


def _control_sql() -> str:
    """Sizes and counts over the oracle's own lines, for the one-year delta run of an institute with a name of four letters."""
    lines = {
        "in_country": (country_lines(), None),
        "in_customer": (o.customer_lines("DELTA"), "substring(split_part(line, ' ', 1), 5, 9)"),
        "in_customer_extension_hist": (o.customer_ext_lines("DELTA"), "substring(split_part(line, '|', 2), 2, 9)"),
        "in_account": (o.account_lines(), "substring(split_part(line, ' ', 1), 5, 9)"),
        "in_account_extension_hist": (o.account_ext_lines(), "substring(split_part(line, '|', 2), 2, 9)"),
        "in_transaction": (o.transaction_lines(), "substring(line, 50, 29)"),
        "in_transaction_extension": (
            o.transaction_ext_lines(),
            "substring(split_part(line, '|', 8), 2, 8) || substring(split_part(line, '|', 9), 2, 13)",
        ),
    }
    rows = []
    for name, (text, key) in lines.items():
        text = f"""select replace(replace(line, 'CI  ', 'CIXX'), '"CI"', '"CIXX"') as line from ({text})"""
        distinct = f"({_runs(text, key)})" if key else "count(*)"
        rows.append(
            f"select '{name}' as output, cast(sum(strlen(line) + 1) as bigint) as size_bytes, cast(count(*) as bigint) as n_lines,"
            f" cast({distinct} as bigint) as n_distinct from ({text})"
        )
    return " union all ".join(rows)


@raw_query("c_control", _control_sql())
def c_control(spark, sf_dir):
    t = demo_tables(spark, sf_dir)
    out = work_dir(spark, "run")
    # Customers over the one-year run, the ledger over the whole history.
    written = [
        *report.write_extracts(spark, t, t, replace(YEAR, institute="CIXX"), out, report.OUTPUTS[:3]),
        *report.write_extracts(spark, t, t, replace(WHOLE, institute="CIXX"), out, report.OUTPUTS[3:]),
    ]
    rows = report.control_report(spark, written, report.account_currency_of(t))
    return rows.select("output", F.col("size_bytes").cast("bigint").alias("size_bytes"), "n_lines", "n_distinct")


ORACLES_FRESH = f"""select case when secs > 1800 then 'DELAY' when value is null then ' Critical Data Broken status'
 when epoch(timestamp '{o.NOW}') - epoch(strptime(datum_time, '%m/%d/%Y %H:%M:%S')) > 1800 then 'DELAY' else 'OK' end as status, value as lag
 from (select *, cast(substring(value, 1, 3) as int) * 86400 + cast(substring(value, 5, 2) as int) * 3600
 + cast(substring(value, 8, 2) as int) * 60 + cast(substring(value, 11, 2) as int) as secs from replica_stat where name = 'apply lag')"""


@query("c_freshness", ORACLES_FRESH)
def c_freshness(t):
    return control.freshness_status(t["replica_stat"], moment(datetime.strptime(o.NOW, "%Y-%m-%d %H:%M:%S")))


@query(
    "c_report",
    f"""select * from (values ('Generation Date', '16/01/2024 12:00:00', null), ('Data of', '01/07/1999', null), ('Timezone', 'UTC', null), ('Country', 'Ivory Coast', null),
 ('Duration of treatment', '1:01:01', null), ('Compliance Package Version', '1.0', null)) v(name, value, status)
 union all select 'Synchronization DBREF', concat('16/01/2024 12:00:00;', coalesce(lag, '')), status from ({ORACLES_FRESH})""",
)
def c_report(t):
    now = datetime.strptime(o.NOW, "%Y-%m-%d %H:%M:%S")
    header = report.run_header(t["network"].sparkSession, YEAR, "Ivory Coast", "1.0", 3661.0, now)
    lag = report.lag_row(t["replica_stat"], moment(now))
    at = F.date_format("checked_at", "dd/MM/yyyy HH:mm:ss")
    rows = lag.select(F.col("control").alias("name"), F.concat(at, F.lit(";"), F.coalesce("lag", F.lit(""))).alias("value"), "status")
    return header.select("name", "value", F.lit(None).cast("string").alias("status")).unionByName(rows)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wallets that moved money in January 2000."""
    t = demo_tables(prepare(spark), sf_dir)
    items = ledger.in_run(t["txn_item"], FLAGSHIP.ledger_start, FLAGSHIP.end)
    return ledger.active_wallets(t["wallet"], items, t["txn_header"]).select("wallet_number", "user_id", "user_type", "msisdn")
