"""Work-tracking source tables derived from the driver's TPC-H-style parquet.

Each definition is one SQL text shared by Spark and the DuckDB oracle, so both
engines see identical inputs.  ``{TS}`` is the zone-less timestamp keyword and
``{FMT(x)}`` formats an instant as month/day/year text, ``{LIST(x, y)}`` makes an
array; everything else is portable SQL.  Unmatched keys are made by shifting keys,
so every row of the raw tables takes part.  Table references are ``{name}`` placeholders: Spark binds them to
DataFrames (``spark.sql(text, name=df)``), the oracle to its own views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from quillmart.sources.catalog import Catalog

_DEFS: dict[str, str] = {
    "f_task": """
select cast(floor(o_orderkey/3) as bigint) as gid, o_orderkey as version_id,
  o_orderdate as upserted_at, 'task ' || cast(o_orderkey as string) as name,
  case when o_orderpriority='5-LOW' then true
       when o_orderpriority='4-NOT SPECIFIED' then cast(null as boolean) else false end as is_deleted,
  'task' as resource_type, 'default_task' as resource_subtype,
  '<body>' || 'task ' || cast(o_orderkey as string) || '</body>' as html_notes,
  'task ' || cast(o_orderkey as string) as notes,
  'https://app.example.com/0/' || cast(o_orderkey as string) as permalink_url,
  case when o_orderkey%29<>0 then o_custkey end as assignee_gid, o_orderdate as created_at, o_orderdate as modified_at,
  case when o_orderkey%3=0 then o_orderdate + interval '14' day + interval '17' hour end as due_at,
  case when o_orderkey%5<>0 then cast(o_orderdate + interval '14' day as date) end as due_on,
  case o_orderstatus when 'F' then true when 'O' then false end as completed,
  case when o_orderstatus='F' then o_custkey end as completed_by_gid,
  case when o_orderstatus='F' then o_orderdate + (o_orderkey%40) * interval '1' day
       + (o_orderkey%24) * interval '1' hour end as completed_at
from {orders}""",
    "f_task_project": """
select cast(floor(l_orderkey/3) + case when floor(l_orderkey/3) % 10 = 9 then 1000000000 else 0 end as bigint) as task_gid,
  cast(floor(l_partkey/2) as bigint) as project_gid, l_returnflag='R' as is_deleted, l_shipdate as upserted_at
from {lineitem}""",
    "f_project": """
select cast(floor(p_partkey/2) + case when floor(p_partkey/2) % 10 = 7 then 1000000000 else 0 end as bigint) as gid, p_partkey as version_id, p_name as name,
  {TS} '1995-01-01 00:00:00' + p_size * interval '1' day as upserted_at
from {part}""",
    "f_user": """
select c_custkey as gid, 0 as version_id, c_name as name, lower(c_name) || '@example.com' as email,
  {TS} '1995-01-01 00:00:00' as upserted_at from {customer}
union all
select c_custkey as gid, 1 as version_id, c_name || ' (renamed)' as name,
  lower(c_name) || '@example.com' as email, {TS} '1995-06-01 00:00:00' as upserted_at
from {customer} where c_custkey%4=0""",
    "f_cfv": """
select cast(floor(event_id/5) as bigint) as task_gid, event_type as field_gid, event_id as version_id,
  ts as upserted_at,
  case when event_type='signup' then {FMT(ts)} when event_id%11=0 then cast(null as string)
       else props end as display_value
from {events}""",
    "f_pay_rate": """
select lower(c_name) || '@example.com' as worker_email, o_orderkey as version_id,
  o_orderdate as effective_from, o_orderpriority as position_title
from {orders} join {customer} on o_custkey=c_custkey""",
    "f_workers": """
select case when c_custkey%2=0 then '' else 'other-' end || lower(c_name) || '@example.com' as work_email_address_copy,
  case when c_custkey%10=0 then '[null]' when c_custkey%10=2 then '[]'
       when c_custkey%10=4 then '[{{"a":1}}]' when c_custkey%10=6 then '["' || n_name || '",{{"a":1,"a":2}}]' else '["' || n_name || '"]' end as manager_name,
  '["' || r_name || '"]' as director_name
from {customer} join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey
union all
select case when c_custkey%20=6 then '' else 'second-' end || lower(c_name) || '@example.com' as work_email_address_copy,
  '["Second"]' as manager_name, '["Second"]' as director_name
from {customer}""",
    "f_company": """
select s_suppkey as id, s_name as property_name,
  case when s_suppkey%4=0 then 'https://app.example.com/0/' || cast(s_suppkey as string) || '/list'
       when s_suppkey%4=1 then 'https://app.example.com/1/99/project/' || cast(s_suppkey-1 as string)
       when s_suppkey%4=2 then 'https://example.com/none' end as property_asana_project,
  case when s_acctbal<0 then 'Cancelled' else 'Active' end as property_client_status,
  s_nationkey as property_brand_director, (s_nationkey+7)%25 as property_brand_manager,
  {TS} '1995-01-01 00:00:00' + (s_suppkey%30*90) * interval '1' day as property_effective_from,
  case when s_suppkey%3=0 then {TS} '1995-01-01 00:00:00'
       + (s_suppkey%30*90 + s_suppkey%7*30 - 30) * interval '1' day end as property_effective_to,
  case when s_suppkey%13=0 then true when s_suppkey%17=0 then cast(null as boolean)
       else false end as is_deleted
from {supplier}""",
    "f_deal_company": """
select l_suppkey as company_id, l_orderkey as deal_id from {lineitem}""",
    "f_deal": """
select o_orderkey as deal_id, o_orderstatus as deal_pipeline_stage_id,
  case when o_orderkey%9=0 then cast(null as string) else lower(o_orderpriority) end as property_dealtype,
  case when o_orderkey%8<>0 then o_orderdate end as property_effective_from,
  o_orderkey%10=0 as is_deleted
from {orders}""",
    "f_owner": """
select n_nationkey as owner_id, n_name as first_name, case when n_regionkey<>3 then r_name end as last_name
from {nation} join {region} on n_regionkey=r_regionkey""",
    "f_sync_existing": """
select o_orderkey + case when o_orderkey%10=0 then 1000000000 else 0 end as ref_id, o_orderstatus as status, o_totalprice as price,
  cast(o_custkey as string) as code, o_orderkey%2=0 as flag,
  case when o_orderkey%13=0 then cast(null as string)
       else '{{"a": 1, "b": ' || cast(o_orderkey%5 as string) || '}}' end as payload,
  o_orderkey + 9007199254740992 as big, '{{"r":1,"q":1.0}}' as rate,
  '["' || o_orderstatus || '",null]' as tags,
  {TS} '2001-09-01 00:00:00' as synced_at
from {orders}""",
    "f_sync_incoming": """
select o_orderkey + case when o_orderkey%10=1 then 2000000000 else 0 end as ref_id, case when o_orderkey%11=0 then cast(null as string) else o_orderstatus end as status,
  case when o_orderkey%7=0 then o_totalprice+1 else o_totalprice end as price,
  cast(o_custkey as string) || '.0' as code,
  case when o_orderkey%2=0 then 'TRUE' else 'False' end as flag,
  case when o_orderkey%13=0 then cast(null as string)
       else '{{"b":' || cast(o_orderkey%5 as string) || ',"a":1}}' end as payload,
  case when o_orderkey%17=0 then o_orderpriority end as priority,
  o_orderkey + 9007199254740992 + case when o_orderkey%19=0 then 1 else 0 end as big,
  case when o_orderkey%23=0 then '{{"r":1.0,"q":1}}' when o_orderkey%29=0 then '{{"r":7,"q":1.0,"r":1}}'
       when o_orderkey%37=0 then '{{"q":1.00, "r":1}}' else '{{"r":1,"q":1.0}}' end as rate,
  {LIST(case when o_orderkey%31=0 then 'new' else o_orderstatus end, cast(null as string))} as tags
from {orders}""",
}

FIXTURES = tuple(_DEFS)
_LIST = re.compile(r"\{LIST\(([^{}]*)\)\}")
_FMT = re.compile(r"\{FMT\((\w+)\)\}")
_REF = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def fixture_sql(name: str, dialect: str) -> str:
    """Definition text with engine-specific tokens filled in.

    Table placeholders stay as ``{table}`` (and JSON braces stay doubled) for
    Spark's formatter; the DuckDB text is fully formatted.
    """
    text = _DEFS[name]
    if dialect == "spark":
        text = _LIST.sub(r"array(\1)", text.replace("{TS}", "timestamp_ntz"))
        return _FMT.sub(r"date_format(\1 - interval '25' year, 'MM/dd/yyyy HH:mm:ss')", text)
    text = _LIST.sub(r"[\1]", text.replace("{TS}", "timestamp"))
    text = _FMT.sub(r"strftime(\1 - interval '25' year, '%m/%d/%Y %H:%M:%S')", text)
    return text.format(**{t: t for t in _REF.findall(text)})


def raw_tables(name: str) -> list[str]:
    return sorted(set(_REF.findall(_DEFS[name])) - {"TS"})


class Fixtures:
    """Spark DataFrames for the derived tables over one data folder."""

    def __init__(self, spark, sf_dir: str):
        self.spark = spark
        self.catalog = Catalog(spark, sf_dir)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            refs = {t: self.catalog.table(t) for t in raw_tables(name)}
            self._frames[name] = self.spark.sql(fixture_sql(name, "spark"), **refs)
        return self._frames[name]


def oracle_ctes(names) -> str:
    """``WITH`` clause defining the given derived tables for the DuckDB oracle."""
    parts = [f"{n} AS ({fixture_sql(n, 'duckdb').strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
