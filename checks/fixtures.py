"""Derived business tables over the supplied star schema.

Each text runs unchanged in Spark SQL and in DuckDB, so a query and its oracle start from the same
rows. Spark reads only the parquet tables a text names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIEWS = {
    "fx_visits": """
select row_no, patient_id, patient_name, dos, visit_stage, provider, facility, payer_type, payer, referral_source, visit_type,
 last_billed, primary_allowed,
 cast(last_billed - primary_allowed as decimal(18,2)) as primary_not_allowed,
 primary_paid, secondary_paid, patient_paid,
 cast(primary_paid + secondary_paid + patient_paid as decimal(18,2)) as total_paid,
 cast(case when row_no % 16 = 0 then primary_allowed * cast(0.50 as decimal(3,2)) else 0 end as decimal(18,2)) as written_off,
 cast(case when visit_stage = 'Open' then coalesce(last_billed, 0) - primary_paid - patient_paid else 0 end as decimal(18,2)) as current_balance
from (
 select o_orderkey as row_no, o_custkey as patient_id, concat('N', substr(c_name, 10), ', Customer') as patient_name,
  cast(o_orderdate as date) as dos,
  case when o_orderstatus = 'F' then 'Closed' when o_orderstatus = 'O' then 'Open'
   when o_orderpriority = '1-URGENT' then 'Review' when o_orderpriority = '2-HIGH' then 'No Show'
   when o_orderpriority = '3-MEDIUM' then 'Patient Canceled' when o_orderpriority = '4-NOT SPECIFIED' then 'Center Canceled'
   else 'Not Started' end as visit_stage,
  concat('PRV', cast(o_orderkey % 20 as string)) as provider, r_name as facility, c_mktsegment as payer_type,
  concat('PAYER_', cast(o_custkey % 30 as string)) as payer, concat('REF_', cast(o_custkey % 9 as string)) as referral_source,
  case o_orderkey % 4 when 0 then 'COM PT' when 1 then 'AUTO PT' when 2 then 'Com Chiro' else 'AUTO MT' end as visit_type,
  case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then cast(0 as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end as last_billed,
  cast(case when c_mktsegment = 'BUILDING' then 0 else cast(o_totalprice as decimal(18,2)) * cast(0.40 as decimal(3,2)) end as decimal(18,2)) as primary_allowed,
  cast(case when o_orderstatus = 'F' and o_orderkey % 8 <> 0 then cast(o_totalprice as decimal(18,2)) * cast(0.30 as decimal(3,2))
   when o_orderstatus = 'O' and o_orderkey % 3 = 0 then cast(o_totalprice as decimal(18,2)) * cast(0.10 as decimal(3,2)) else 0 end as decimal(18,2)) as primary_paid,
  cast(case when o_orderkey % 21 = 0 then 40 else 0 end as decimal(18,2)) as secondary_paid,
  cast(case when o_orderkey % 5 = 0 then 25 else 0 end as decimal(18,2)) as patient_paid
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
) v
""",
    "fx_patients": """
select c_custkey as patient_id, concat('N', substr(c_name, 10), ', Customer') as patient_name,
 date '1940-01-01' + cast(c_custkey % 900 as int) as dob from customer
""",
    "fx_claims": """
select *, cast(charges - coalesce(adjustments, 0) - insurance_payments - patient_payments as decimal(18,2)) as current_balance from (
select o.o_orderkey as row_no,
 case when o.o_custkey % 25 = 0 then concat('Walkin ', substr(c_name, 10)) when o.o_custkey % 7 = 0 then concat('Customer Q N', substr(c_name, 10)) else concat('customer N', substr(c_name, 10)) end as patient_name,
 case when o.o_custkey % 50 = 0 then date '1900-01-01' else date '1940-01-01' + cast(c_custkey % 900 as int) end as dob,
 cast(o_orderdate as date) + cast(case when o.o_orderkey % 13 = 0 then 1 else 0 end as int) as service_date,
 cast(o_orderdate as date) + cast(o.o_orderkey % 30 - 3 as int) as first_bill_date,
 concat(cast(100000 + n_regionkey as string), ' - CLINIC ', r_name) as office,
 cast(cast(o_totalprice as decimal(18,2)) + case when o.o_orderkey % 9 = 0 then 10 else 0 end as decimal(18,2)) as charges,
 cast(case when o.o_orderkey % 6 = 0 then 0 when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) * cast(0.30 as decimal(3,2)) + case when o.o_orderkey % 6 = 1 then 5 else 0 end when o.o_orderkey % 11 = 0 then 50 else 0 end as decimal(18,2)) as insurance_payments,
 cast(case when o.o_orderkey % 5 = 0 then 25 when o.o_orderkey % 14 = 0 then 15 else 0 end as decimal(18,2)) as patient_payments,
 a.adjustments
from orders o join customer on o.o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
left join (select l_orderkey, cast(sum(cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as decimal(18,2))) as decimal(18,2)) as adjustments from lineitem group by l_orderkey) a on a.l_orderkey = o.o_orderkey
where o.o_orderkey % 10 <> 0
) c
""",
    "fx_deposits": """
select l_orderkey * 10 + l_linenumber as row_no, cast(l_shipdate as date) as txn_date, cast(l_extendedprice as decimal(18,2)) as amount, p_name as memo,
 cleared, p_brand as account, r_name as facility
from (select l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey, 'Cleared' as cleared from lineitem
 union all select l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey, 'Reconciled' as cleared from lineitem where l_orderkey % 20 = 0) l
join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "fx_pl_wide": """
with b as (
 select r_name as facility, year(l_shipdate) as yr, case when l_linestatus = 'F' then 'Income' else 'Expenses' end as sect, p_type as category, month(l_shipdate) as m, sum(cast(l_extendedprice as decimal(18,2))) as amt
 from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
 group by 1, 2, 3, 4, 5),
r as (
 select facility, yr, case sect when 'Income' then 2 else 5 end as ord, category as label, m, amt from b
 union all select facility, yr, case sect when 'Income' then 3 else 6 end as ord, concat('Total for ', sect) as label, m, amt from b
 union all select facility, yr, 7 as ord, 'Net Income' as label, m, case when sect = 'Income' then amt else -amt end as amt from b
 union all select distinct facility, yr, case sect when 'Income' then 1 else 4 end as ord, sect as label, cast(null as int) as m, cast(null as decimal(18,2)) as amt from b)
select facility, yr, row_number() over (partition by facility, yr order by ord, label) as row_no, label,
 '$' || cast(cast(sum(case when m = 1 then amt end) as decimal(18,2)) as string) as m01,
 '$' || cast(cast(sum(case when m = 2 then amt end) as decimal(18,2)) as string) as m02,
 '$' || cast(cast(sum(case when m = 3 then amt end) as decimal(18,2)) as string) as m03,
 '$' || cast(cast(sum(case when m = 4 then amt end) as decimal(18,2)) as string) as m04,
 '$' || cast(cast(sum(case when m = 5 then amt end) as decimal(18,2)) as string) as m05,
 '$' || cast(cast(sum(case when m = 6 then amt end) as decimal(18,2)) as string) as m06,
 '$' || cast(cast(sum(case when m = 7 then amt end) as decimal(18,2)) as string) as m07,
 '$' || cast(cast(sum(case when m = 8 then amt end) as decimal(18,2)) as string) as m08,
 '$' || cast(cast(sum(case when m = 9 then amt end) as decimal(18,2)) as string) as m09,
 '$' || cast(cast(sum(case when m = 10 then amt end) as decimal(18,2)) as string) as m10,
 '$' || cast(cast(sum(case when m = 11 then amt end) as decimal(18,2)) as string) as m11,
 '$' || cast(cast(sum(case when m = 12 then amt end) as decimal(18,2)) as string) as m12
from r group by facility, yr, ord, label
""",
    "fx_manifest": """
select concat(source, '_2001', lpad(cast(1 + doc_id % 12 as string), 2, '0'), lpad(cast(1 + doc_id % 28 as string), 2, '0'), '_', lpad(cast(doc_id % 24 as string), 2, '0'), '0000', case when doc_id % 3 = 0 then '.md' else '.csv' end) as file_name,
 source as prefix, date '2001-01-01' + cast(doc_id % 240 as int) as modified, n_chars as size from documents
""",
    "fx_decisions": """
select concat('WALKIN ', substr(c_name, 10)) as name_norm, case when c_custkey % 50 = 0 then date '1900-01-01' else date '1940-01-01' + cast(c_custkey % 900 as int) end as dob,
 case when c_custkey % 2 = 1 then cast(c_custkey as string) else 'UNMATCHED' end as decision from customer where c_custkey % 25 = 0
""",
    # Export-like text cells in all the shapes the parsers have to read.
    "fx_text": """
select o_orderkey as row_no,
 case o_orderkey % 8 when 0 then '$' || cast(o_orderkey % 9 as string) || ',' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || '.50'
  when 1 then cast(cast(o_totalprice as decimal(18,2)) as string) when 2 then '(' || cast(o_orderkey % 100 as string) || '.25)'
  when 3 then '-' when 4 then '' when 5 then 'nan' when 6 then null else ' $ ' || cast(o_orderkey % 50 as string) || ' ' end as money_text,
 case o_orderkey % 6 when 0 then substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4)
  when 1 then cast(cast(substr(d, 6, 2) as int) as string) || '/' || cast(cast(substr(d, 9, 2) as int) as string) || '/' || substr(d, 1, 4)
  when 2 then d when 3 then '13/45/2025' when 4 then null else '' end as date_text,
 case o_orderkey % 6 when 0 then '  ' || c_name || ' ' when 1 then 'Doe ,  ' || c_name when 2 then 'jane   q  doe' when 3 then null
  when 4 then '   ' else 'Last, First, Jr' end as name_text
from (select *, cast(cast(o_orderdate as date) as string) as d from orders) o join customer on o_custkey = c_custkey
""",
}

# The supplied tables each derived table reads.
READS = {
    "fx_visits": ('region', 'nation', 'customer', 'orders'),
    "fx_patients": ('customer',),
    "fx_claims": ('region', 'nation', 'customer', 'orders', 'lineitem'),
    "fx_deposits": ('region', 'nation', 'supplier', 'part', 'lineitem'),
    "fx_pl_wide": ('region', 'nation', 'supplier', 'part', 'lineitem'),
    "fx_manifest": ('documents',),
    "fx_text": ('customer', 'orders'),
    "fx_decisions": ('customer',),
}

#: Month columns of a yearly sheet and the month within the year.
PL_MONTHS = {f"m{m:02d}": f"{m:02d}" for m in range(1, 13)}
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table. Its schema is inferred once per process; later reads need no job for it."""
    path = f"{sf_dir}/{name}.parquet"
    if name not in _SCHEMAS:
        _SCHEMAS[name] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[name]).parquet(path)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a lazy DataFrame."""
    for source in READS[name]:
        table(spark, sf_dir, source).createOrReplaceTempView(source)
    return spark.sql(VIEWS[name])


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_visits")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_claims")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master in id order, which stands for its file order."""
    return fixture(spark, sf_dir, "fx_patients").withColumn("row_no", F.col("patient_id"))


def deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_deposits")


def pl_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_pl_wide")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder lists a name once: repeated names are one file, last modified and largest size."""
    rows = fixture(spark, sf_dir, "fx_manifest")
    return rows.groupBy("file_name", "prefix").agg(F.max("modified").alias("modified"), F.max("size").alias("size"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_decisions")
