"""Payments tables derived from the order tables, in SQL that Spark and DuckDB read alike.

Three tokens differ by engine and are filled in per dialect: the zone-less timestamp literal, and the opening of a transfer
leg into its payer and its receiver item.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources import conform
from ..sources.tables import SCHEMAS

BASE_TABLES = ("customer", "supplier", "orders", "lineitem", "nation", "events", "documents")

VIEWS = {
    "txn_header": """
select case o_orderkey % 3 when 0 then 'CI' when 1 then 'PP' else 'MR' end || cast(o_orderkey % 97 as string) || '.' || cast(o_orderkey as string) as transfer_id,
 o_orderkey, o_orderdate as transfer_date, o_orderdate as created_on, o_orderdate + interval '1' day * (o_orderkey % 5) as modified_on,
 'U' || cast(o_custkey as string) as created_by,
 case when o_orderstatus = 'F' then 'TS' when o_orderstatus = 'O' then 'TF' else 'TA' end as transfer_status,
 case when o_orderkey % 11 = 0 then 'OP1' end as reconciliation_by,
 case o_orderpriority when '1-URGENT' then 'CASHIN' when '2-HIGH' then 'P2P' when '3-MEDIUM' then 'RC' when '4-NOT SPECIFIED' then 'ROLLBACK' else 'BILLPAY' end as service_type,
 case o_orderpriority when '1-URGENT' then 'CASHIN' when '2-HIGH' then 'P2P' when '3-MEDIUM' then 'RC' when '4-NOT SPECIFIED' then 'ROLLBACK' else 'BILLPAY' end as transfer_subtype,
 case when o_orderkey % 2 = 0 then 'FAILED_AT_IN' else 'OTHER' end as attr_2_name,
 case when o_orderkey % 3 = 0 then 'Y' else 'xy9' end as attr_2_value,
 case when o_orderkey % 4 = 0 then ' ab' || cast(o_orderkey as string) end as reference_number, o_custkey
from orders""",
    "txn_leg": """
select h.transfer_id, h.transfer_date, h.service_type, h.transfer_subtype, h.transfer_status, l.l_linenumber, h.o_orderkey, l.l_suppkey,
 'C' || cast(h.o_custkey as string) as cust_party,
 case when h.service_type = 'ROLLBACK' and l.l_suppkey % 4 = 0 then 'IND03' else 'S' || cast(l.l_suppkey as string) end as supp_party,
 case when h.o_custkey % 10 = 9 then '02' else '01' end || '000' || cast(100000 + h.o_custkey as string) || '000000000' as cust_wallet,
 '03000' || cast(100000 + l.l_suppkey as string) || '000000000' as supp_wallet,
 cast(l.l_extendedprice as decimal(20,2)) as amt, h.o_custkey,
 case when l.l_linenumber = 1 then case o_orderkey % 6
   when 0 then '1#a#b#1IRTV3#GB#GBP#g#h#i#j#k#WorldRemit#z' when 1 then '01#a#b#c#fr#eur#x' when 2 then '2#a#b#c#FR#EUR#'
   when 3 then '1#a#b#c##' when 4 then 'abc' else '1#a#b#c#bf#na#x' end end as txn_mode
from lineitem l join txn_header h on h.o_orderkey = l.l_orderkey
 join (select * from (values (0),(1),(1)) as v(twice)) c on c.twice = case when l.l_linenumber = 1 and l.l_orderkey % 40 = 0 then 1 else 0 end""",
    "txn_item": """
select transfer_id, transfer_date, service_type, transfer_subtype, transfer_status,
 case when side = 'P' then case l_linenumber when 1 then 'MP' when 2 then 'CP' else 'SCP' end
      else case l_linenumber when 1 then 'MR' when 2 then 'CR' else 'SCR' end end as transaction_type,
 case when side = 'P' then cust_party else supp_party end as party_id,
 case when side = 'P' then supp_party else cust_party end as second_party,
 '22' || case when side = 'P' then cust_party else supp_party end as account_id,
 case when side = 'P' then cust_wallet else supp_wallet end as wallet_number,
 amt as transfer_value, amt as requested_value,
 cast(amt * 3 as decimal(30,2)) as previous_balance,
 cast(amt * case when side = 'P' then 2 else 4 end as decimal(30,2)) as post_balance, txn_mode,
 case when side = 'P' then 'SUBS' else 'AGT' end as category_code,
 case when o_orderkey % 50 = case when side = 'P' then 7 else 8 end then 'P1' end as pseudo_user_id,
 case when side = 'R' and o_orderkey % 9 = 0 then 'N' || cast(o_custkey as string) end as unreg_user_id
from {legs_by_side}""",
    "wallet": """
select case when c_custkey % 10 = 9 then '02' else '01' end || '000' || cast(100000 + c_custkey as string) || '000000000' as wallet_number,
 'C' || cast(c_custkey as string) as user_id, 'SUBSCRIBER' as user_type, '22C' || cast(c_custkey as string) as msisdn,
 case when c_custkey % 13 = 0 then 'N' else 'Y' end as status, case when c_custkey % 17 = 0 then 'N' else 'Y' end as is_primary,
 {ts} '1995-01-01 00:00:00' + interval '1' day * (c_custkey % 2000) as created_on,
 {ts} '1996-01-01 00:00:00' + interval '1' day * (c_custkey % 2000) as modified_on,
 'M' || cast(c_custkey % 3 as string) as mpay_profile_id, cast(12 + c_custkey % 2 as string) as payment_type_id,
 'G' || cast(c_custkey % 3 as string) as user_grade, cast(c_acctbal * 100 as decimal(20,2)) as balance
from customer
union all
select case when c_custkey % 10 = 9 then '02' else '01' end || '000' || cast(100000 + c_custkey as string) || '000000000',
 'C' || cast(c_custkey as string), 'SUBSCRIBER', '22C' || cast(c_custkey as string), 'Y', 'N',
 {ts} '1997-01-01 00:00:00', {ts} '1998-01-01 00:00:00', 'M1', '11', 'G0', cast(c_acctbal * 100 as decimal(20,2))
from customer where c_custkey % 29 = 5
union all
select '03000' || cast(100000 + s_suppkey as string) || '000000000', 'S' || cast(s_suppkey as string),
 case when s_suppkey % 20 = 0 then 'OPERATOR' else 'CHANNEL' end, '22S' || cast(s_suppkey as string),
 case when s_suppkey % 13 = 0 then 'N' else 'Y' end, 'Y',
 {ts} '1995-01-01 00:00:00' + interval '1' day * s_suppkey, {ts} '2000-01-01 00:00:00' + interval '1' day * s_suppkey,
 'M' || cast(s_suppkey % 3 as string), '11', 'G1', cast(s_acctbal * 100 as decimal(20,2))
from supplier""",
    "wallet_balance": """
select wallet_number, cast(balance as decimal(30,2)) as balance, 0 as wallet_sequence_number from wallet
union all select wallet_number, cast(balance * 2 as decimal(30,2)), 1 from wallet""",
    "party": """
select 'C' || cast(c_custkey as string) as user_id, 'SUBSCRIBER' as user_type, '22C' || cast(c_custkey as string) as msisdn,
 case when c_custkey % 3 = 0 then c_name || ' of "the" ' || c_mktsegment || ' trade' else c_name end as user_name,
 case when c_custkey % 19 = 0 then cast(null as string) else 'Last ' || c_mktsegment end as last_name,
 case c_custkey % 4 when 0 then '1PN1XX' || cast(c_custkey as string) when 1 then '1CFRXX' || cast(c_custkey as string) when 2 then '1PXXBF' || cast(c_custkey as string) end as external_code,
 'ID' || cast(c_custkey as string) as id_no, 'bf' as residence_country, 'fr' as nationality,
 'GEN_' || case when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
 case when c_custkey % 23 = 0 then 'N' else 'Y' end as status, case when c_custkey % 5 = 0 then 'PASSPORT' end as id_type,
 'N' || cast(c_nationkey as string) as network_code, 'SUBS' as category_code,
 {ts} '1998-01-01 00:00:00' + interval '1' day * (c_custkey % 1500) as created_on,
 {ts} '1999-01-01 00:00:00' + interval '1' day * (c_custkey % 1500) as modified_on,
 case when c_custkey % 7 <> 0 then {ts} '1950-01-01 00:00:00' + interval '1' day * (c_custkey % 15000) end as dob,
 'Block ' || c_mktsegment || ', north side of the "' || c_name || '" road' as address1,
 case when c_custkey % 2 = 0 then 'Flat "' || cast(c_custkey as string) || '"' end as address2,
 'Town of ' || c_mktsegment || ' upon ' || c_name as city, ' region ' || cast(c_nationkey as string) as state,
 case when c_custkey % 3 = 1 then 'Opened at the "' || c_mktsegment || '" desk by the agent who keeps the file of ' || c_name || ' since then' end as remarks
from customer""",
    "channel_user": """
select 'S' || cast(s_suppkey as string) as user_id, 'CHANNEL' as user_type, '22S' || cast(s_suppkey as string) as msisdn, s_name as user_name,
 'Y' as status, 'AGT' as category_code, 'N' || cast(s_nationkey as string) as network_code,
 case s_suppkey % 6 when 0 then 'IRTIN' when 1 then 'IRTINN1' when 2 then ' irtoutN2' when 3 then 'IRTOUT' when 4 then 'MFS' else 'SHOP' end as designation,
 {ts} '1996-01-01 00:00:00' + interval '1' day * s_suppkey as created_on,
 {ts} '1996-02-01 00:00:00' + interval '1' day * s_suppkey as level2_approved_on,
 {ts} '1999-09-01 00:00:00' + interval '1' day * s_suppkey as modified_approved_on,
 'A' || cast(s_suppkey as string) as agent_code, ' zone ' || cast(s_nationkey as string) as state,
 case when s_suppkey % 3 = 0 then '1PFRBF' || cast(s_suppkey as string) when s_suppkey % 3 = 1 then 'X-' || cast(s_suppkey as string) end as external_code
from supplier""",
    "tag_rule": """
select * from (values
 (1,'P2P','P2P_SHOP',cast(null as string),cast(null as string),cast(null as string),'SHOP',cast(null as string),cast(null as string),cast(null as string),cast(null as string),cast(null as string),cast(null as string),cast(null as string)),
 (2,'P2P','P2P_ANY',null,null,null,null,null,null,null,null,null,null,null),
 (2,'P2P','P2P_ANY2',null,null,null,null,null,null,null,null,null,null,null),
 (3,'CASHIN','CASHIN_WRONG','P2P',null,null,null,null,null,null,null,null,null,null),
 (4,'CASHIN','CASHIN_OTHER',null,'C1',null,null,null,null,null,null,null,null,null),
 (5,'CASHIN','CASHIN_REF',null,null,null,null,null,null,null,null,null,'AB',null),
 (6,'CASHIN','CASHIN_XY',null,null,null,null,null,null,null,null,null,null,'XY'),
 (7,'CASHIN','CASHIN_STD','CASHIN',null,null,null,null,null,null,null,null,null,null),
 (8,'RC','RC_CASHOUT',null,null,null,'MFS',null,null,null,null,null,null,null),
 (9,'RC','RC_FROM_SHOP',null,null,'SHOP',null,null,null,null,null,null,null,null),
 (10,'RC','RC_ZONE',null,null,null,null,null,null,null,'ZONE 3',null,null,null),
 (11,'RC','RC_REGION',null,null,null,null,null,null,'REGION 4',null,null,null,null),
 (12,'RC','RC_AWAY',null,null,null,null,'DOM1','DOM2',null,null,'ZONE 5',null,null),
 (13,'ROLLBACK','BACK_TO_1',null,null,null,null,'DOM2',null,null,null,null,null,null),
 (14,'ROLLBACK','BACK_ANY',null,null,null,null,null,'DOM2',null,null,null,null,null))
 as t(tag_id,transfer_subtype,tag_name,service_type,sender_user_id,sender_designation,receiver_designation,sender_domain_code,receiver_domain_code,
 sender_state,receiver_state,not_receiver_state,reference_number2,source_txn_id)""",
    "receiver_kyc": """
select transfer_id as p2p_transfer_id, transfer_id as agcout_transfer_id,
 case when o_custkey % 2 = 0 then 'First' || cast(o_custkey as string) || ' with a long given "name" that runs on and on, well past the field' else 'First' || cast(o_custkey as string) end as rec_fname,
 case when o_custkey % 7 = 0 then cast(null as string) else ' Doe ' end as rec_lname,
 {ts} '1970-01-01 00:00:00' + interval '1' day * (o_custkey % 9000) as rec_dob, 'K' || cast(o_custkey as string) as rec_idno
from txn_header where o_orderkey % 9 = 0""",
    "unreg_user": """
select distinct 'N' || cast(o_custkey as string) as unreg_user_id, '99' || cast(o_custkey as string) as msisdn from orders where o_orderkey % 9 = 0""",
    "category": """
select * from (values ('SUBS','SUBS','Subscriber','DOM1',10),('AGT','CHUSER','Agent','DOM2',20),('HEAD','OTHER','Head office','DOM2',1))
 as t(category_code,category_type,category_name,domain_code,sequence_no)""",
    "category_relation": """
select * from (values ('HEAD','AGT','OWNER','Y'),('HEAD','SUBS','OWNER','N')) as t(from_category,to_category,relation_type,status)""",
    "service_type": """
select * from (values ('CASHIN','Y'),('P2P','Y'),('RC','Y'),('ROLLBACK','N'),('BILLPAY','N')) as t(service_type,is_financial)""",
    "country": """
select n_nationkey as id, 'N' || cast(n_nationkey as string) as country_iso, n_name as description,
 'C' || cast(10 + n_nationkey as string) as currency_iso, case when n_nationkey % 6 = 5 then 'N' else 'Y' end as status from nation
union all select 900, 'FR', 'France', 'EUR', 'Y' union all select 901, 'BF', 'Burkina', 'XOF', 'Y' union all select 902, 'GB', 'Britain', 'GBP', 'N'""",
    "id_type": "select * from (values ('P','PASSPORT'),('C','CONSULAR_CARD')) as t(type_id,idtype_label)",
    "system_preference": "select 'CURRENCY_FACTOR' as preference_code, '100' as default_value",
    "env_param": "select * from (values ('CURRENCY_CODE','XOF'),('COMPLIANCE_INSTITUTE','CI')) as t(param_key,param_val_text)",
    "network": "select 'CI' as network_code",
    "control_profile": "select * from (values ('M0',1000000,'G0'),('M1',2500000,'G1')) as t(profile_id,max_balance,grade_code)",
    "grade": "select * from (values ('G0','Basic','Y'),('G1','Gold','Y'),('G2','Closed','N')) as t(grade_code,grade_name,status)",
    "payment_subtype": "select * from (values ('11','Agent float'),('12','Main wallet')) as t(payment_type_id,subtype_name)",
    # One replica sample per event: the lag grows with the event number, the sample time is the event's.
    "replica_stat": """
select case when event_type = 'error' then 'transport lag' else 'apply lag' end as name,
 case when event_id % 17 = 0 then cast(null as string)
  else '+0' || cast(event_id % 2 as string) || ' 00:' || lpad(cast(event_id % 60 as string), 2, '0') || ':' || lpad(cast(event_id % 59 as string), 2, '0') end as value,
 substring(cast(ts as string), 6, 2) || '/' || substring(cast(ts as string), 9, 2) || '/' || substring(cast(ts as string), 1, 4) || ' ' || substring(cast(ts as string), 12, 8) as datum_time
from events""",
}

DIALECTS = {
    "spark": {
        "ts": "timestamp_ntz",
        "legs_by_side": "(select *, explode(array('P', 'R')) as side from txn_leg)",
    },
    "duckdb": {
        "ts": "timestamp",
        "legs_by_side": "(select *, unnest(['P', 'R']) as side from txn_leg)",
    },
}


def with_clause(query: str, views: dict[str, str], dialect: str) -> str:
    """``query`` behind a WITH of the views that it needs, in an order that defines each before its use."""
    filled = {name: sql.format(**DIALECTS[dialect]).strip() for name, sql in views.items()}
    order: list[str] = []
    seen: set[str] = set()

    def visit(sql: str) -> None:
        for word in re.findall(r"\b[a-z_0-9]+\b", sql):
            if word in views and word not in seen:
                seen.add(word)
                visit(filled[word])
                order.append(word)

    visit(query)
    parts = [f"{name} as ({filled[name]})" for name in order]
    return f"with {', '.join(parts)} {query}" if parts else query


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class DemoTables(Mapping):
    """The payments tables over one test directory, conformed like any source and built when first used.

    No view is registered in the session: every table carries the views that it needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        base = {n: f"select * from parquet.`{sf_dir.rstrip('/')}/{n}.parquet`" for n in BASE_TABLES}
        self._views = {**base, **VIEWS}
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(name)
        if name not in self._built:
            text = with_clause(f"select * from {name}", self._views, "spark")
            self._built[name] = conform(self._spark.sql(text), name, empty_text=False)
        return self._built[name]

    def __iter__(self):
        return iter(SCHEMAS)

    def __len__(self):
        return len(SCHEMAS)


def demo_tables(spark: SparkSession, sf_dir: str) -> DemoTables:
    return DemoTables(spark, sf_dir)
