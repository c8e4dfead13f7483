"""The jobs' input tables, derived from the star-schema test tables.

Every binding reads whole tables. The same SQL text serves Spark and the SQL
check; ``{S}``, ``{T}`` and ``{G}`` stand for what the two dialects spell
differently: the string type, the timestamp type and the replace-all flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from namelens.schemas import VOTER_FIELDS

# Names are made once per part, before the joins.
NAMED = (
    "(select p_partkey, p_name || ' ' || translate(cast(p_partkey as {S}),'0123456789','abcdefghij') as name"
    " from part) p"
)

# The fields of a voter file, by position, from an order; the others hold their name.
_DAY = "substring(cast(o_orderdate as {S}), 1, 10)"
_OWN_VALUES = {
    "state_voter_id": "case when o_orderkey % 11 = 0 then 'n/a' else cast(o_orderkey as {S}) end",
    "first_name": "'Ren\u00e9-' || cast(o_custkey as {S})",
    "birth_year": "case when o_orderkey % 13 = 0 then 'unknown' else cast(1930 + o_custkey % 70 as {S}) end",
    "gender": "case when o_custkey % 2 = 0 then 'F' else 'm' end",
    "middle_name": "case when o_custkey % 3 = 0 then cast(null as {S}) else 'M.' end",
    "registration_zip_code": "cast(10000 + o_custkey % 80000 as {S})",
    "registration_date": f"case when o_orderkey % 17 = 0 then '31.12.1999' else {_DAY} end",
    "last_voted_date": f"substring({_DAY}, 6, 2) || '/' || substring({_DAY}, 9, 2) || '/' || substring({_DAY}, 1, 4)",
}
VOTER_VALUES = {name: _OWN_VALUES.get(name, f"'{name}'") for name in VOTER_FIELDS}

TEXTS = {
    "ssa_raw": f"""
select p.name as first_name,
 case when l.l_returnflag='N' and l.l_linenumber=1 then 'x'
      when (l.l_orderkey*7) % 100 < (p.p_partkey*37) % 101 then ' male' else 'F' end as gender,
 cast(case when p.p_partkey % 7 = 0 then 1 + l.l_linenumber % 3
           when p.p_partkey % 7 = 1 then 1 + l.l_linenumber
           else l.l_quantity end as bigint) as quantity,
 cast(1930 + (p.p_partkey*13 + l.l_orderkey % 11) % 97 as int) as year
from lineitem l join {NAMED} on l.l_partkey = p.p_partkey
""",
    "voter_raw": f"""
select o.o_orderkey as state_voter_id, cast(null as {{S}}) as name_suffix, p.name as first_name,
 o.o_orderpriority as middle_name, o.o_orderstatus || '-Fam' as last_name,
 case when o.o_custkey % 9 = 0 then 'U'
      when (o.o_custkey*7) % 100 < (p.p_partkey*37) % 101 then 'm ' else 'Female' end as gender,
 case when o.o_custkey % 41 = 0 then cast(null as int)
      else cast(1930 + (p.p_partkey*13 + o.o_custkey % 23) % 97 as int) end as birth_year,
 case when o.o_orderkey % 13 = 0 then 'n/a'
      else lpad(cast((o.o_orderkey*37) % 100000 as {{S}}),5,'0') || '-0001' end as registration_zip_code,
 'WA' as registration_state,
 case when o.o_custkey % 5 = 0 then cast(null as {{S}})
      else lpad(cast((o.o_custkey*53) % 100000 as {{S}}),5,'0') end as mailing_zip_code,
 'WA' as mailing_state, cast('2026-03-01 00:00:00' as {{T}}) as loaded_ts
from (select *, o_orderkey % (select count(*) from part) as pk from orders) o
join {NAMED} on p.p_partkey = o.pk
""",
    "person_input": f"""
select cast(c.c_nationkey + 1 as bigint) as client_id,
 cast((c.c_nationkey + 1)*10 + c.c_custkey % 3 as bigint) as batch_id,
 case when c.c_custkey % 50 = 0 then 'R-' || cast(c.c_custkey as {{S}})
      else cast(c.c_custkey as {{S}}) end as record_id,
 case when c.c_custkey % 29 = 0 then cast(null as {{S}})
      when c.c_custkey % 31 = 0 then ' 12 '
      when c.c_custkey % 17 = 0 then 'Zz' || p.name
      else '  ' || upper(p.name) || ' ' end as first_name,
 c.c_mktsegment || '-' as last_name,
 case when c.c_custkey % 13 = 0 then 'AB-12'
      else lpad(cast((c.c_custkey*37) % 100000 as {{S}}),5,'0') || '-0001' end as zip,
 cast('2026-04-10 12:00:00' as {{T}}) as load_ts
from customer c join {NAMED} on p.p_partkey = c.c_custkey
""",
    "landing": f"""
select cast(c.c_custkey as {{S}}) as record_id, p.name as first_name,
 c.c_mktsegment as last_name, cast((c.c_custkey*37) % 100000 as {{S}}) as zip,
 'uploads/' || case when c.c_custkey % 97 = 0 then 'misc' else 'client_org-' || cast(c.c_nationkey as {{S}}) end
 || '/batch_b-' || cast(c.c_nationkey*10 + c.c_custkey % 3 as {{S}})
 || '/u' || cast(c.c_nationkey as {{S}}) || '-x_my_file.csv' as storage_file_name,
 cast('2026-04-10 12:00:00' as {{T}}) as load_ts
from customer c join {NAMED} on p.p_partkey = c.c_custkey
""",
    "client": """
select cast(n_nationkey + 1 as bigint) as id, 'org-' || cast(n_nationkey as {S}) as app_organization_id,
 n_name as name, n_regionkey % 2 = 0 as model_improvement_program_participant
from nation
""",
    # One batch per client and third of its customers; those of rich customers are delivered.
    "client_batch": """
select cast((c_nationkey + 1)*10 + c_custkey % 3 as bigint) as id,
 cast(c_nationkey + 1 as bigint) as client_id,
 'b-' || cast(c_nationkey*10 + c_custkey % 3 as {S}) as app_batch_id,
 'my_file.csv' as file_name,
 'uploads/client_org-' || cast(c_nationkey as {S}) || '/batch_b-' || cast(c_nationkey*10 + c_custkey % 3 as {S})
 || '/u' || cast(c_nationkey as {S}) || '-x_my_file.csv' as storage_file_name,
 cast(count(*) as bigint) as record_count, cast(null as bigint) as processed_record_count,
 case when sum(cast(floor(c_acctbal) as bigint)) > 5000 * count(*) then cast('2026-04-01 00:00:00' as {T}) else cast(null as {T}) end as delivery_complete_ts,
 cast(null as {S}) as download_object_key
from customer group by c_nationkey, c_custkey % 3
""",
    "approval_results": """
select 'org-' || cast(o_custkey % 50 as {S}) as app_organization_id, 'b-' || cast(o_custkey as {S}) as app_batch_id,
 case o_orderstatus when 'O' then 'DENIED' else 'APPROVED' end as status,
 o_orderkey * 2 as requested_credits,
 case o_orderstatus when 'O' then cast(null as bigint) else o_orderkey end as approved_credits,
 case o_orderstatus when 'O' then 'no credits' end as denial_reason,
 case when o_orderstatus = 'P' then cast(null as {T}) else cast(o_orderdate as {T}) end as decision_ts,
 cast(o_orderdate as {T}) as created_ts, o_orderkey as seq
from orders
""",
    # One approval request per customer.
    "approval_queue": """
select 'org-' || cast(c_custkey % 50 as {S}) as app_organization_id, 'b-' || cast(c_custkey as {S}) as app_batch_id,
 c_custkey as batch_id, case when c_acctbal < 0 then 'DENIED' else 'PENDING' end as status,
 cast(null as bigint) as requested_credits, cast(null as bigint) as approved_credits,
 cast(null as {S}) as denial_reason, cast(null as {T}) as decision_ts,
 cast('2026-04-09 08:00:00' as {T}) as created_ts, cast('2026-04-09 08:00:00' as {T}) as updated_ts
from customer
""",
    # The batches behind those requests, and their owners.
    "request_batch": """
select c_custkey as id, cast(c_custkey % 50 as bigint) as client_id, 'b-' || cast(c_custkey as {S}) as app_batch_id,
 'uploads/client_org-' || cast(c_custkey % 50 as {S}) || '/batch_b-' || cast(c_custkey as {S}) || '/u_x.csv' as storage_file_name,
 case when c_acctbal < 500 then cast(null as bigint) else cast(floor(c_acctbal) as bigint) end as record_count,
 cast(null as bigint) as processed_record_count, cast(null as {T}) as delivery_complete_ts
from customer
""",
    "request_client": """
select distinct cast(c_custkey % 50 as bigint) as id, 'org-' || cast(c_custkey % 50 as {S}) as app_organization_id
from customer
""",
    # One landed row per order, in the file of the ordering customer's batch.
    "request_landing": """
select cast(o_orderkey as {S}) as record_id,
 'uploads/client_org-' || cast(o_custkey % 50 as {S}) || '/batch_b-' || cast(o_custkey as {S}) || '/u_x.csv' as storage_file_name
from orders
""",
    "output_config": """
select 'org-' || cast(c_custkey % 50 as {S}) as app_organization_id, 'b-' || cast(c_custkey as {S}) as app_batch_id,
 '{"attributes":[{"code":"GNDRPR","label":"Gender Predictions"}' || case when c_custkey % 3 = 0 then ',{"code":"AGEXPD","label":"Age"}' else '' end
 || case when c_custkey % 5 = 0 then ',{"code":null,"label":"x"}' else '' end
 || '],"output_fields":[{"field_name":"RECORD_ID","sort_order":null},{"field_name":"PREDICTED_GENDER","sort_order":2},{"field_name":"MALE_PROBABILITY","sort_order":1}'
 || case when c_acctbal < 1000 then ',{"field_name":"FIRST_NAME","sort_order":null},{"field_name":null,"sort_order":3}' else '' end
 || '],"retain_source_fields":true}' as config_json
from customer
""",
    # One enrichment per customer and order priority, so at most five per batch.
    "enrichment_status": """
select cast(o_custkey % 50 as bigint) as client_id, o_custkey as batch_id,
 'b-' || cast(o_custkey as {S}) as app_batch_id,
 o_orderpriority as enrichment_type,
 case substring(o_orderpriority, 1, 1) when '1' then 'GNDRPR' when '2' then 'AGEXPD' when '3' then 'AGCLPS'
   else 'CODE' || substring(o_orderpriority, 1, 1) end as enrichment_type_code,
 min(case o_orderstatus when 'O' then 'PENDING' when 'F' then 'COMPLETED' else 'RUNNING' end) as enrichment_status,
 min(case when o_orderstatus = 'F' then '{"analysis_type":"a","n":' || cast(o_custkey as {S}) || '}'
      when o_orderstatus = 'P' then '{bad' end) as enrichment_metrics_payload,
 min(case when o_totalprice > 100000 then cast(o_orderdate as {T}) end) as started_ts,
 cast(null as {T}) as completed_ts, min(case when o_totalprice < 50000 then 'old error' end) as error_message,
 cast('2026-04-09 08:00:00' as {T}) as created_ts, cast('2026-04-09 08:00:00' as {T}) as updated_ts
from orders group by 1, 2, 3, 4, 5
""",
    # One message per customer, sent or not.
    "outbox": """
select c_custkey as id, cast(c_custkey % 50 as bigint) as client_id, c_custkey as batch_id,
 'b-' || cast(c_custkey as {S}) as app_batch_id, 'org-' || cast(c_custkey % 50 as {S}) as app_organization_id,
 '{"old":true}' as payload, 'DELIVERY_STATUS_UPDATED' as event_type,
 case when c_acctbal < 2000 then 'SUCCEEDED' else 'READY' end as status,
 case when c_acctbal < 0 then cast(null as int) else 1 end as attempt_count,
 cast(null as {T}) as last_attempt_ts, 'old error' as last_error,
 cast('2026-04-09 08:00:00' as {T}) as created_ts,
 case when c_acctbal < 2000 then cast('2026-04-09 09:00:00' as {T}) else cast(null as {T}) end as processed_ts
from customer
""",
    # What the deliveries about customers with pending orders came back with.
    "delivery_outcomes": """
select o_custkey as id, cast(min(case o_orderpriority when '1-URGENT' then 200 when '2-HIGH' then 204
   when '3-MEDIUM' then 404 when '5-LOW' then 500 end) as int) as http_status,
 min(case when o_orderpriority = '5-LOW' then repeat('x', 6000) else o_orderpriority end) as body,
 'timed out' as error
from orders where o_orderstatus = 'P' group by o_custkey
""",
    # One raw person per order, in the ordering customer's batch.
    "request_people": """
select cast(o_custkey % 50 as bigint) as client_id, o_custkey as batch_id, cast(o_orderkey as {S}) as record_id
from orders
""",
    # Downloads announced before: for customers with a pending order.
    "ready_queue": """
select distinct 'org-' || cast(o_custkey % 50 as {S}) as app_organization_id, 'b-' || cast(o_custkey as {S}) as app_batch_id,
 'downloads/old' as download_object_key, 'READY' as download_status,
 cast('2026-04-01 08:00:00' as {T}) as queued_ts, 'SUCCEEDED' as processing_status,
 cast('2026-04-01 08:00:01' as {T}) as processing_started_ts, cast('2026-04-01 08:00:02' as {T}) as processed_ts,
 'old error' as error_message, cast('2026-04-01 08:00:00' as {T}) as created_ts,
 cast('2026-04-01 08:00:02' as {T}) as updated_ts
from orders where o_orderstatus = 'P'
""",
    # A download order per batch; those of rich customers are still to be prepared.
    "download_queue": """
select 'org-' || cast(c_nationkey as {S}) as app_organization_id,
 'b-' || cast(c_nationkey*10 + c_custkey % 3 as {S}) as app_batch_id,
 case when sum(cast(floor(c_acctbal) as bigint)) > 5000 * count(*) then 'PENDING' else 'SUCCEEDED' end as processing_status
from customer group by c_nationkey, c_custkey % 3
""",
    "attribute": """
select 'a' as id, 'GNDRPR' as code, 'Gender' as label union all
select 'b', 'AGEXPD', 'Age, seven groups' union all select 'c', 'AGCLPS', 'Age, four groups'
""",
    # Voter file fields as text: numbers and dates in several spellings, some unusable.
    "voter_text": """
select case when o_orderstatus = 'P' then 'n/a' else cast(o_orderkey as {S}) end as state_voter_id,
 o_orderpriority as first_name,
 case when o_orderstatus = 'F' then ' 19' || cast(10 + o_custkey % 90 as {S}) || ' ' else 'unknown' end as birth_year,
 case o_orderstatus when 'O' then substring(cast(o_orderdate as {S}), 1, 10)
   when 'F' then substring(cast(o_orderdate as {S}), 6, 2) || '/' || substring(cast(o_orderdate as {S}), 9, 2) || '/' || substring(cast(o_orderdate as {S}), 1, 4)
   else '31.12.1999' end as registration_date
from orders
""",
    # A whole voter file as text: every field, some unusable; the kind says how many fields its line has.
    "voter_file": "select " + ", ".join(f"{value} as {name}" for name, value in VOTER_VALUES.items()) + """,
 case o_orderkey % 50 when 0 then 'short' when 1 then 'long' else 'whole' end as kind
from orders""",
    # Configurations with fields nobody knows, explicit nulls, and some that are no JSON.
    "dirty_config": """
select 'org-' || cast(c_custkey % 50 as {S}) as app_organization_id, 'b-' || cast(c_custkey as {S}) as app_batch_id,
 case c_custkey % 6 when 0 then '{bad' when 1 then '[1,2]' when 2 then cast(null as {S})
  when 3 then '{"attributes":[{"code":"GNDRPR","new":{"a":[1]}},{"code":null},{"label":"x"}],"output_fields":null,"version":7}'
  when 4 then '{"output_fields":[{"field_name":"ZIP","sort_order":2},{"field_name":"RECORD_ID","sort_order":null,"note":"n"},{"field_name":null,"sort_order":1},{"field_name":"LAST_NAME","sort_order":1},{"field_name":"FIRST_NAME"}],"attributes":"none"}'
  else '{"attributes":[{"code":"AGCLPS","label":"b"},{"code":"AGEXPD","label":"a"}],"output_fields":[{"field_name":"ZIP","sort_order":"x"},3,null]}' end as config_json
from customer
""",
    # Earlier results: one per customer with an urgent pending order, plus records no longer sent.
    "old_records": """
select distinct cast(c.c_nationkey + 1 as bigint) as client_id,
 cast((c.c_nationkey + 1)*10 + c.c_custkey % 3 as bigint) as batch_id,
 case when c.c_custkey % 50 = 0 then 'R-' || cast(c.c_custkey as {S}) else cast(c.c_custkey as {S}) end as record_id
from customer c join orders o on o.o_custkey = c.c_custkey
where o.o_orderstatus = 'P' and o.o_orderpriority = '1-URGENT'
union all
select cast(s_nationkey + 1 as bigint), cast((s_nationkey + 1)*10 as bigint), 'S-' || cast(s_suppkey as {S}) from supplier
""",
}

TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem"]


def spark_text(name: str) -> str:
    """A binding in Spark SQL."""
    return _fill(TEXTS[name], "string", "timestamp_ntz", "")


def duckdb_text(name: str) -> str:
    """A binding in the SQL of the check."""
    return _fill(TEXTS[name], "varchar", "timestamp", ",'g'")


def _fill(text: str, string: str, timestamp: str, flag: str) -> str:
    return text.replace("{S}", string).replace("{T}", timestamp).replace("{G}", flag)


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One binding over the parquet tables of a folder."""
    text = spark_text(name)
    used = [t for t in TABLES if f" {t}" in text]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    for t in used:
        text = text.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    if not used:
        return spark.sql(text)
    return _sql(spark, text, frames)


def _sql(spark: SparkSession, text: str, frames: dict[str, DataFrame]) -> DataFrame:
    for t, df in frames.items():
        view = f"namelens_{t}"
        df.createOrReplaceTempView(view)
        text = text.replace(f"{{{t}}}", view)
    return spark.sql(text)
