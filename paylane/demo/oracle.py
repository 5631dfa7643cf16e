"""The same questions in plain DuckDB SQL, written from the rules and not from the operators.

``FRAGMENTS`` are named subqueries over the payments views; ``sql(query)`` puts whatever a query names in front of it.
"""

from __future__ import annotations

from .tables import VIEWS, with_clause

# Run windows: the whole history for the ledger, one year with its preceding days for customers.
WHOLE = ("1995-01-01", "2001-08-02")
YEAR = ("1999-07-01", "2000-07-01")
NOW = "2024-01-16 12:00:00"


def span(col: str, window: tuple[str, str]) -> str:
    return f"{col} >= timestamp '{window[0]}' and {col} < timestamp '{window[1]}'"


def money(e: str) -> str:
    r = f"round({e}, 2)"
    whole = f"cast(floor(abs({r})) as hugeint)"
    cents = f"cast(abs({r}) * 100 as hugeint) % 100"
    return (
        f"(case when {r} < 0 then '-' else '+' end || lpad(cast({whole} as varchar), 13, '0') || '.'"
        f" || lpad(cast({cents} as varchar), 2, '0'))"
    )


def rp(e: str, n: int) -> str:
    return f"rpad(nullif({e}, ''), {n}, ' ')"


def glue(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def sp(n: int) -> str:
    return f"'{' ' * n}'"


def ymd(e: str) -> str:
    return f"strftime({e}, '%Y%m%d')"


def hash_field(e: str, k: int) -> str:
    """The k-th field, closed by a further mark."""
    parts = f"string_split({e}, '#')"
    return f"(case when len({parts}) > {k} then nullif({parts}[{k}], '') end)"


def starts_one(e: str) -> str:
    first = hash_field(e, 1)
    return f"coalesce(regexp_full_match({first}, '[0-9]+') and try_cast({first} as bigint) = 1, false)"


def settled(h: str) -> str:
    return (
        f"(case when {h}.transfer_status = 'TS' then 'Y' when {h}.reconciliation_by is not null then 'Y'"
        f" when {h}.service_type = 'RC' and {h}.attr_2_name = 'FAILED_AT_IN' and {h}.attr_2_value = 'Y' then 'Y' else 'N' end)"
    )


def geo(side: str, what: str) -> str:
    other, direction = ("r", "IRTIN") if side == "s" else ("s", "IRTOUT")
    design = f"{side}_design"
    coded = f"right({design}, 2)"
    k = 5 if what == "country" else 6
    local = f"coalesce('CI', {side}_network)" if what == "country" else "'XOF'"
    if what == "currency":
        coded = f"(select max(currency_iso) from country where country_iso = right({design}, 2))"
    hidden = "false"
    if side == "s":
        hidden = (
            f"coalesce({hash_field('txn_mode', 4)} = '1IRTV3' and upper({hash_field('txn_mode', 12)}) = 'WORLDREMIT'"
            f" and {hash_field('txn_mode', 5)} = 'GB', false)"
        )
    return f"""case when coalesce({other}_known = 'SUBSCRIBER', false) and {starts_one('txn_mode')}
      then case when {hidden} then null else coalesce(upper({hash_field('txn_mode', k)}), {local}) end
      when {design} in ('{direction}', 'IRT', 'MFS', 'TRANSINTER') then null
      when {design} like '{direction}%' then {coded} else {local} end"""


def pairs(window: tuple[str, str] | None, source: str = "txn_item") -> str:
    where = f"where {span('r.transfer_date', window)} and {span('q.transfer_date', window)}" if window else ""
    return f"""
select r.transfer_id, r.transaction_type as kind, r.service_type as r_service, r.party_id as receiver, r.second_party as sender,
 r.transfer_value as val, r.txn_mode, r.wallet_number as r_wallet, r.account_id as r_phone, r.pseudo_user_id as r_pseudo,
 r.previous_balance as r_pre, r.post_balance as r_post, q.service_type as service, q.wallet_number as s_wallet,
 q.account_id as s_phone, q.pseudo_user_id as s_pseudo, q.requested_value as asked, q.transfer_subtype as q_subtype,
 q.previous_balance as s_pre, q.post_balance as s_post,
 sum(case when r.transaction_type = 'SCR' or (r.transaction_type = 'MR' and r.service_type in ('ROLLBACK', 'TXNCORRECT') and r.second_party = 'IND03')
   then r.transfer_value * 0.01 else 0 end) over (partition by q.transfer_id) as charged
from {source} r join {source} q on r.transfer_id = q.transfer_id and r.party_id = q.second_party and r.second_party = q.party_id
 and r.transfer_value = q.transfer_value
 and r.transaction_type || q.transaction_type in ('MRMP', 'CRCP', 'SCRSCP')
{where}"""


def transfers(headers: str, paired: str) -> str:
    return f"""
select h.transfer_id, h.transfer_date, h.created_on, h.created_by, h.transfer_subtype, h.reference_number, h.attr_2_value, {settled('h')} as done,
 x.service, x.q_subtype, x.txn_mode, x.sender, x.receiver, x.s_wallet, x.r_wallet, x.s_phone, x.r_phone, x.charged,
 coalesce(x.asked * 0.01, 0) as amount, coalesce(x.s_pre * 0.01, 0) as s_pre, coalesce(x.s_post * 0.01, 0) as s_post,
 coalesce(x.r_pre * 0.01, 0) as r_pre, coalesce(x.r_post * 0.01, 0) as r_post,
 a.user_type as s_known, b.user_type as r_known,
 case when x.s_pseudo is not null then 'PSEUDO' else a.user_type end as s_type,
 case when x.r_pseudo is not null then 'PSEUDO' else b.user_type end as r_type,
 a.designation as s_design, b.designation as r_design, a.network_p as s_network, b.network_p as r_network,
 a.state as s_state, b.state as r_state, a.domain as s_domain, b.domain as r_domain
from {headers} h join {paired} x on x.transfer_id = h.transfer_id
 join service_type st on st.service_type = x.service
 left join ora_people a on a.wallet_number = x.s_wallet left join ora_people b on b.wallet_number = x.r_wallet
where x.kind = 'MR' and not (x.r_service in ('ROLLBACK', 'TXNCORRECT') and (x.receiver = 'IND03' or x.sender = 'IND03'))
 and (st.is_financial = 'Y' or x.charged > 0)"""


def active(start: str, end: str) -> str:
    return f"""
select distinct i.party_id as user_id, i.account_id as msisdn from txn_item i
where exists (select 1 from service_type s where s.service_type = i.service_type and s.is_financial = 'Y')
 and exists (select 1 from category c where c.category_code = i.category_code and c.category_type in ('CHUSER', 'SUBS'))
 and i.transaction_type in ('MR', 'MP') and i.transfer_status = 'TS'
 and i.transfer_date >= {start} and i.transfer_date < {end}"""


_Y0, _Y1 = f"timestamp '{YEAR[0]}'", f"timestamp '{YEAR[1]}'"
_FINE = "status <> 'N' and wallet_status <> 'N' and user_type in ('SUBSCRIBER', 'CHANNEL')"
_CHANGED = f"({span('creation_date', YEAR)} or {span('modification_date', YEAR)} or {span('wallet_modified_on', YEAR)})"
_CODE = "'1[A-Z]{{5}}.+'"


def reported(mode: str, changed: str = "true") -> str:
    """Users of a run; ``changed`` narrows those that are reported for a change."""
    extra = {
        "DELTA": f"or (creation_date < {_Y0} - interval 91 day and exists (select 1 from ora_back a where a.user_id = p.user_id and a.msisdn = p.msisdn))",
        "FULLACTIVE": "or exists (select 1 from ora_active_90 a where a.user_id = p.user_id and a.msisdn = p.msisdn)",
    }.get(mode, "")
    return f"select p.* from ora_people p where {_FINE} and wallet_primary = 'Y' and (({_CHANGED} and {changed}) {extra})"


def _born(e: str) -> str:
    return f"rpad(coalesce({ymd(e)}, ' '), 8, ' ')"


_CUSTOMER_GAPS = {
    "zip": sp(7),
    "after_home": sp(3 + 8 + 12),
    "after_since": sp(1 + 11 + 1 + 17 + 8),
    "after_nation": sp(17 + 3 + 10 + 1 + 24),
    "after_pass": sp(3 + 32 + 1 + 1),
    "risk": sp(10),
}


def customer_lines(mode: str, changed: str = "true") -> str:
    g = _CUSTOMER_GAPS
    valid = "exists (select 1 from country c where c.country_iso = {0} and c.status = 'Y')"
    registered = f"""
select distinct rpad(left(user_type, 1) || coalesce(msisdn, ' '), 16, ' ') as f1, rpad(coalesce(user_name, ' '), 32, ' ') as f2,
 rpad(coalesce(nullif(trim(last_name), ''), 'UNKNOWN'), 32, ' ') as f3, rpad(coalesce(address1, ' '), 32, ' ') as f4,
 rpad(coalesce(city, ' '), 28, ' ') as f5,
 case when {valid.format('home')} then rpad(home, 3, ' ') else '   ' end as f6,
 rpad(coalesce(user_mark, ' '), 32, ' ') as f7, rpad(coalesce(user_type, ' '), 32, ' ') as f8, {_born('dob')} as f9, {_born('created_on')} as f10,
 case when {valid.format('nation')} then rpad(nation, 3, ' ') else '   ' end as f11,
 rpad(coalesce(agent_code, ' '), 16, ' ') as f12, rpad(case when idtype = 'PASSPORT' then id_no2 else ' ' end, 17, ' ') as f13,
 coalesce(nullif(substring(gender, 5, 1), ''), ' ') as f14
from ({reported(mode, changed)})"""
    unknown = f"""
select distinct rpad('U' || coalesce(msisdn, ' '), 16, ' '), rpad(coalesce(rec_fname, ' '), 32, ' '),
 rpad(coalesce(nullif(trim(rec_lname), ''), 'UNKNOWN'), 32, ' '), {sp(32)}, {sp(28)}, {sp(3)}, {sp(32)}, rpad('UNREGISTERED', 32, ' '),
 {_born('rec_dob')}, {sp(8)}, {sp(3)}, {sp(16)}, {sp(17)}, ' ' from ora_unreg"""
    line = glue(
        "'CI  '", "f1", "f2", "f3", "f4", g["zip"], "f5", "f6", g["after_home"], "f7", "f8", "f9", "f10", g["after_since"],
        "f11", g["after_nation"], "f12", "f13", g["after_pass"], "f14", g["risk"],
    )
    return f"select {line} as line from ({registered} union all {unknown})"


def _q(*cols: str) -> list[str]:
    return [f"""'"', {c}, '"|'""" for c in cols]


def customer_ext_lines(mode: str) -> str:
    unq = "nullif(replace({0}, '\"', ' '), '')"

    def tail(c: str, n: int) -> str:
        return unq.format(f"substring({c}, {n})")

    slots = {1: "c1", 2: "c2", 3: "c3", 4: "c4", 5: "c5", 6: "c6", 7: "c7", 8: "c8", 9: "c9", 10: "c10", 11: "c11", 17: "c17",
             18: "c18", 19: "c19", 20: "c20", 21: "c21", 22: "c22", 26: "c26"}
    registered = f"""
select distinct left(user_type, 1) || coalesce(msisdn, ' ') as who, {tail('user_name', 33)} as c1, {tail('last_name', 33)} as c2,
 {tail('address1', 33)} as c3, {unq.format('address2')} as c4, {tail('city', 29)} as c5,
 case when idtype = 'PASSPORT' then null else {unq.format('id_no2')} end as c6, id_no1 as c7, idtype as c8, user_category as c9,
 cat_name as c10, case when user_type = 'CHANNEL' then state end as c11, {unq.format('substring(remarks, 1, 64)')} as c17,
 {tail('remarks', 65)} as c18, user_id as c19, cast(cat_level as varchar) as c20, head_code as c21, head_name as c22, grade_name as c26
from ({reported(mode)})"""
    unknown = f"""
select distinct 'U' || coalesce(msisdn, ' '), {tail('rec_fname', 33)}, {tail('rec_lname', 33)}, null, null, null, null, rec_idno,
 null, null, null, null, null, null, unreg_user_id, null, null, null, null from ora_unreg"""
    cols = ["'CI  '", "who", *[slots.get(n, "''") for n in range(1, 49)]]
    line = glue(*_q(*cols), sp(0), "'|||||||||'")
    return f"select {line} as line from ({registered} union all {unknown})"


_DC = {
    "D": dict(own="s", other="r", sign="-"),
    "C": dict(own="r", other="s", sign=""),
}


def sides(extra: str, joins: str = "") -> str:
    """The located transfers seen from both sides; ``extra`` may use {own} and {other}."""
    out = []
    for side, d in _DC.items():
        out.append(
            f"select '{side}' as side, {d['own']}_wallet as own_wallet, {d['other']}_wallet as other_wallet, {d['sign']}amount as signed,"
            f" left({d['own']}_type, 1) || coalesce({d['own']}_phone, 'XXXXXXXX') as who,"
            f" left({d['other']}_type, 1) || coalesce({d['other']}_phone, 'XXXXXXXX') as other_who,"
            f" {extra.format(own=d['own'], other=d['other'], other_party='receiver' if side == 'D' else 'sender')}"
            f" from ora_tagged t {joins.format(own=d['own'], other=d['other'])}"
            f" where {d['own']}_type in ('SUBSCRIBER', 'CHANNEL') and done = 'Y'"
        )
    return " union all ".join(out)


_SHORT = "left(transfer_id, 2) || substring(transfer_id, instr(transfer_id, '.') + 1)"


def country_lines() -> str:
    number = "printf('%03d', id)"
    return f"select {glue(number, rp('country_iso', 3), rp('description', 128))} as line from country where status = 'Y'"


def transaction_lines() -> str:
    inner = sides(
        "txn_mode, transfer_id, transfer_date, created_on, tag, {other}_country as other_country, {other_party} as other_party,"
        " coalesce(sc.currency_iso, case when s_currency <> 'NA' then s_currency end, 'XOF') as shown,"
        " case when {other}_currency is null then 'XX' when {other}_currency = 'NA' then coalesce({other}c.currency_iso, 'XX') else {other}_currency end as contra",
        "left join country sc on sc.country_iso = t.s_country left join country rc on rc.country_iso = t.r_country",
    )
    line = glue(
        "'CI  '", rp("who", 16), rp("left(own_wallet, 2)", 4), rp("substring(own_wallet, 3, 9)", 11), rp("substring(own_wallet, 12, 9)", 11),
        "'XOF'", ymd("created_on"), ymd("transfer_date"), rp(_SHORT, 16), sp(10), "shown", money("signed"), "'+0000000000000.00'", sp(10),
        rp("coalesce(other_country, ' ')", 3), rp("other_wallet", 35), sp(12), rp("other_party", 27),
        "case when tag like 'CASHIN%' or tag like '%CASHOUT%' then 'Y' else 'N' end", sp(4 * 27 + 1 + 24 + 16),
        rp("strftime(transfer_date, '%H:%M:%S')", 17), rp("other_who", 16), rp("left(transfer_id, 2)", 6), sp(1 + 16 + 1 + 16 + 4 + 11 + 11),
        rp("contra", 3), sp(7),
    )
    return f"select {line} as line from ({inner})"


def transaction_ext_lines() -> str:
    inner = sides(
        "transfer_id, transfer_date, created_on, created_by, tag, service, q_subtype, {own}_pre as pre, {own}_post as post,"
        " k.rec_fname, k.rec_lname, k.rec_idno, k.rec_dob",
        "left join receiver_kyc k on k.agcout_transfer_id = t.transfer_id left join country c on c.country_iso = t.{own}_country",
    )
    text = [
        "'CI'", "who", "left(own_wallet, 2)", "substring(own_wallet, 3, 9)", "substring(own_wallet, 12, 9)", "'XOF'", ymd("created_on"),
        ymd("transfer_date"), _SHORT, "tag", "substring(rec_fname, 1, 64)", "substring(rec_fname, 65)", "substring(rec_lname, 1, 64)",
        "substring(rec_lname, 65)", "rec_idno", ymd("rec_dob"), "created_by", "service", "q_subtype", "'XOF'", "transfer_id",
        *["''"] * 36,
    ]
    line = glue(*_q(*text), money("pre"), "'|'", money("post"), "'|'", money("signed"), "'|||||||'")
    return f"select {line} as line from ({inner})"


def account_rows(balance: bool) -> str:
    more = ", b.balance * 0.01 as balance" if balance else ", w.payment_type_id, g.grade_name, w.user_id"
    join = (
        "join wallet_balance b on b.wallet_number = w.wallet_number and b.wallet_sequence_number = 0"
        if balance
        else "left join grade g on g.grade_code = cp.grade_code and g.status = 'Y'"
    )
    return f"""
select distinct w.user_type, w.msisdn, w.network_u as network, w.wallet_number, w.wallet_created_on, ps.subtype_name, cp.max_balance * 0.01 as cap{more}
from ora_people w left join control_profile cp on cp.profile_id = w.mpay_profile_id
 left join payment_subtype ps on ps.payment_type_id = w.payment_type_id {join}
where w.wallet_number in (select wallet_number from ora_moving) and w.status <> 'N' and w.wallet_status <> 'N'
 and w.user_type in ('CHANNEL', 'SUBSCRIBER')"""


def account_lines() -> str:
    line = glue(
        "'CI  '", rp("left(user_type, 1) || coalesce(msisdn, ' ')", 16), rp("left(wallet_number, 2)", 4), rp("substring(wallet_number, 3, 9)", 11),
        rp("substring(wallet_number, 12, 9)", 11), rp("currency_iso", 3), ymd("wallet_created_on"), sp(8), sp(20), money("cap"), money("balance"),
        sp(17 + 17 + 4 + 24 + 5 + 35 + 1 + 1 + 16), rp("subtype_name", 32), sp(8 + 8 + 32 + 4 + 2 + 1 + 2 + 1 + 1 + 32 + 5 + 12 + 12),
    )
    return f"select {line} as line from ({account_rows(True)}) a left join country c on c.country_iso = a.network"


def account_ext_lines() -> str:
    text = [
        "'CI  '", "left(user_type, 1) || coalesce(msisdn, ' ')", "left(wallet_number, 2)", "substring(wallet_number, 3, 9)",
        "substring(wallet_number, 12, 9)", "substring(currency_iso, 1, 3)", "user_id", "payment_type_id", "grade_name", *["''"] * 45,
    ]
    line = glue(*_q(*text), "'|||||||||'")
    return f"select {line} as line from ({account_rows(False)}) a left join country c on c.country_iso = a.network"


FRAGMENTS = {
    "ora_country_lines": country_lines(),
    "ora_people": f"""
select w.wallet_number, case when w.user_type = 'OPERATOR' then w.user_type else coalesce(p.user_type, u.user_type) end as user_type,
 case when p.user_id is not null then p.msisdn when u.user_id is not null then u.msisdn else w.msisdn end as msisdn,
 coalesce(w.user_id, p.user_id, u.user_id) as user_id,
 case when w.user_type = 'OPERATOR' then w.status else coalesce(p.status, u.status) end as status,
 w.is_primary as wallet_primary, w.status as wallet_status, w.created_on as wallet_created_on, w.modified_on as wallet_modified_on,
 w.mpay_profile_id, w.payment_type_id, coalesce(u.network_code, p.network_code) as network_u, coalesce(p.network_code, u.network_code) as network_p,
 coalesce(p.user_name, u.user_name) as user_name, p.last_name, p.address1, p.address2, p.city, p.remarks, p.gender, p.dob as dob, u.agent_code,
 nullif(upper(trim(u.designation)), '') as designation, nullif(upper(trim(coalesce(p.state, u.state))), '') as state,
 upper(trim(case when p.user_id is not null then p.state when u.user_id is not null then u.designation else w.msisdn end)) as user_mark,
 case when p.user_id is not null then p.created_on when u.user_id is not null then u.created_on else w.created_on end as created_on,
 case when p.user_id is not null then p.created_on when u.user_id is not null then u.level2_approved_on else w.created_on end as creation_date,
 case when p.user_id is not null then p.modified_on when u.user_id is not null then u.modified_approved_on else w.modified_on end as modification_date,
 case when regexp_full_match(p.external_code, {_CODE}) and substring(p.external_code, 5, 2) <> 'XX' then substring(p.external_code, 5, 2) else upper(p.residence_country) end as home,
 case when regexp_full_match(p.external_code, {_CODE}) and substring(p.external_code, 3, 2) <> 'XX' then substring(p.external_code, 3, 2) else upper(p.nationality) end as nation,
 case when regexp_full_match(p.external_code, {_CODE}) then (select max(idtype_label) from id_type where type_id = substring(p.external_code, 2, 1)) else coalesce(p.id_type, 'OTHER') end as idtype,
 p.id_no as id_no1,
 case when regexp_full_match(coalesce(p.external_code, u.external_code), {_CODE}) then nullif(substring(p.external_code, 7), '')
  else coalesce(p.id_no, p.external_code, u.external_code) end as id_no2,
 coalesce(u.category_code, p.category_code) as user_category, k.category_name as cat_name, k.domain_code as domain, k.sequence_no as cat_level,
 o.from_category as head_code, hk.category_name as head_name, g.grade_name
from wallet w left join party p on p.user_id = w.user_id and p.user_type = w.user_type
 left join channel_user u on u.user_id = w.user_id and w.user_type <> 'SUBSCRIBER'
 left join category k on k.category_code = coalesce(p.category_code, u.category_code)
 left join category_relation o on o.to_category = coalesce(p.category_code, u.category_code) and o.relation_type = 'OWNER' and o.status = 'Y'
 left join category hk on hk.category_code = o.from_category
 left join grade g on g.grade_code = w.user_grade and g.status = 'Y'
where w.user_type = 'OPERATOR' or p.user_id is not null or u.user_id is not null""",
    "ora_pairs": pairs(WHOLE),
    "ora_heads": f"select * from txn_header where {span('transfer_date', WHOLE)}",
    "ora_transfers": transfers("ora_heads", "ora_pairs"),
    "ora_located": f"""
select x.*, {geo('s', 'country')} as s_country, {geo('s', 'currency')} as s_currency, {geo('r', 'country')} as r_country, {geo('r', 'currency')} as r_currency
from ora_transfers x""",
    "ora_tagged": """
select x.*, coalesce((select arg_max(tag_name, (-tag_id, tag_name)) from tag_rule g where g.transfer_subtype = x.transfer_subtype
 and (g.service_type is null or g.service_type = x.service)
 and (g.sender_user_id is null or g.sender_user_id = x.sender)
 and (g.sender_designation is null or g.sender_designation = x.s_design)
 and (g.receiver_designation is null or g.receiver_designation = x.r_design)
 and (g.sender_domain_code is null or g.sender_domain_code = x.s_domain)
 and (g.receiver_domain_code is null or g.receiver_domain_code = x.r_domain)
 and (g.sender_state is null or g.sender_state = x.s_state)
 and (g.receiver_state is null or g.receiver_state = x.r_state)
 and (g.not_receiver_state is null or g.not_receiver_state <> x.r_state)
 and (g.reference_number2 is null or g.reference_number2 = upper(left(trim(x.reference_number), 2)))
 and (g.source_txn_id is null or g.source_txn_id = upper(left(trim(x.attr_2_value), 2)))), x.transfer_subtype) as tag
from ora_located x""",
    "ora_moving": f"""
select distinct unnest([q.wallet_number, r.wallet_number]) as wallet_number
from txn_header h join txn_item r on r.transfer_id = h.transfer_id join txn_item q on r.transfer_id = q.transfer_id and r.party_id = q.second_party
 and r.second_party = q.party_id and r.transfer_value = q.transfer_value
where r.transaction_type = 'MR' and q.transaction_type = 'MP' and {settled('h')} = 'Y' and {span('r.transfer_date', WHOLE)} and {span('q.transfer_date', WHOLE)}""",
    "ora_before": active(f"{_Y0} - interval 91 day", _Y0),
    "ora_during": active(_Y0, _Y1),
    "ora_active_90": active(f"{_Y1} - interval 90 day", _Y1),
    "ora_back": """
select d.* from ora_during d left join ora_before b on b.user_id = d.user_id and b.msisdn = d.msisdn where b.user_id is null""",
    "ora_late": f"select * from txn_header where transfer_date < {_Y0} and {span('modified_on', YEAR)}",
    "ora_late_items": "select i.* from txn_item i where i.transfer_id in (select transfer_id from ora_late)",
    "ora_unreg": f"""
select k.*, n.unreg_user_id, n.msisdn from receiver_kyc k join (
 select transfer_id, unreg_user_id from txn_item where transaction_type = 'MR' and {span('transfer_date', YEAR)}
 union all select transfer_id, unreg_user_id from ora_late_items where transaction_type = 'MR') i on i.transfer_id = k.p2p_transfer_id
 join unreg_user n on n.unreg_user_id = i.unreg_user_id""",
    "ora_year_pairs": f"{pairs(YEAR)} union all {pairs(None, 'ora_late_items')}",
    "ora_year_heads": f"select * from txn_header where {span('transfer_date', YEAR)} union all select * from ora_late",
    "ora_year_transfers": transfers("ora_year_heads", "ora_year_pairs"),
}


def activity(days: int) -> str:
    since = f"{_Y1} - interval {days} day"
    half = "select {0} as u, {1}_type as ty, sum(amount) as total, max(transfer_date) as latest from ora_year_transfers where done = 'Y' and transfer_date >= {2} group by all"
    return f"""
select coalesce(d.u, c.u) as user_id, coalesce(d.ty, c.ty) as user_type, d.total as debit, c.total as credit, d.latest as debit_on, c.latest as credit_on
from ({half.format('sender', 's', since)}) d full outer join ({half.format('receiver', 'r', since)}) c on c.u = d.u and c.ty = d.ty"""


def sql(query: str) -> str:
    return with_clause(query, {**VIEWS, **FRAGMENTS}, "duckdb")
