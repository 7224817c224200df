"""The six dirty extracts, derived from the test tables in SQL that both engines run.

Only the way to write "twice per row" differs between the engines, hence the ``{copies_*}`` marks.
Table names are in braces: Spark binds them to DataFrames, the oracle to its registered views.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_COPIES = {
    "spark": "lateral view explode(array({values})) t as v",
    "duckdb": "cross join unnest([{values}]) t(v)",
}


def _lineage(file: str, system: str) -> str:
    return (
        f"timestamp '2026-01-01 00:00:00' as _ingested_at, '{file}' as _source_file, "
        f"'{system}' as _source_system, 'b1' as _batch_id"
    )


_RAW = {
    "raw_customers": f"""
select case when c_custkey % 401 = 7 then '' else concat(' ', cast(c_custkey as string)) end as cst_id,
       concat('aw', lpad(cast(c_custkey as string), 8, '0')) as cst_key,
       case when v = 1 and c_custkey % 50 = 0 then ''
            else concat(' First', cast(c_custkey % 97 as string)) end as cst_firstname,
       case when c_custkey % 23 = 0 then '' else concat('Last', cast(c_custkey % 89 as string), ' ') end as cst_lastname,
       case c_custkey % 5 when 0 then 'M' when 1 then 's' when 2 then 'Single' when 3 then '' else 'X' end
         as cst_marital_status,
       case c_custkey % 4 when 0 then 'm' when 1 then 'Female' when 2 then '' else 'F ' end as cst_gndr,
       case when c_custkey % 211 = 0 then 'not a date' else concat('2010-10-0', cast(v as string)) end as cst_create_date,
       {_lineage("cust_info.csv", "crm")}
from {{customer}} {{copies_2}}
where v = 1 or c_custkey % 50 = 0""",
    "raw_attr": f"""
select concat('NASAW', lpad(cast(c_custkey as string), 8, '0')) as cid,
       case when c_custkey % 19 = 0 then '' else concat(cast(1925 + c_custkey % 85 as string), '-',
            lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-', lpad(cast(1 + c_custkey % 28 as string), 2, '0')) end
         as bdate,
       case c_custkey % 5 when 0 then 'Male' when 1 then 'F' when 2 then '' when 3 then ' M ' else 'Female' end as gen,
       {_lineage("CUST_AZ12.csv", "erp")}
from {{customer}}""",
    "raw_geo": f"""
select concat('AW-', lpad(cast(c_custkey as string), 8, '0')) as cid,
       case c_custkey % 7 when 0 then 'US' when 1 then 'USA ' when 2 then 'DE' when 3 then ''
            when 4 then 'Australia' when 5 then 'gb' else 'ZZ' end as cntry,
       {_lineage("LOC_A101.csv", "erp")}
from {{customer}}""",
    "raw_cat": f"""
select concat('CA_T', cast(k as string)) as id, concat('Cat  ', cast(k % 3 as string)) as cat,
       concat(' Sub ', cast(k as string)) as subcat,
       case k % 4 when 0 then 'Yes' when 1 then 'n' when 2 then '' else 'No' end as maintenance,
       {_lineage("PX_CAT_G1V2.csv", "erp")}
from (select p_partkey % 6 as k from {{part}} group by p_partkey % 6) c""",
    "raw_products": f"""
select cast(p_partkey * 3 + v as string) as prd_id,
       case when p_partkey % 499 = 3 then 'BAD' else concat('CA-T', cast(p_partkey % 7 as string), '-BK-',
            lpad(cast(p_partkey as string), 6, '0')) end as prd_key,
       concat('HL ', replace(p_name, ' ', ' - '), '- ', cast(p_size as string)) as prd_nm,
       case when p_partkey % 97 = 0 then '' else cast(cast(p_size * 10 + v as decimal(12,2)) as string) end as prd_cost,
       case p_partkey % 5 when 0 then 'R ' when 1 then 'M ' when 2 then 'S ' when 3 then 'T ' else '' end as prd_line,
       concat(cast(1993 + v as string), '-07-01') as prd_start_dt,
       case when v = 1 + p_partkey % 3 then '' when p_partkey % 2 = 0 then concat(cast(1990 + v as string), '-12-28')
            else concat(cast(1994 + v as string), '-06-30') end as prd_end_dt,
       {_lineage("prd_info.csv", "crm")}
from {{part}} {{copies_3}}
where v <= 1 + p_partkey % 3""",
    "raw_sales": f"""
select concat('so', cast(g.l_orderkey as string)) as sls_ord_num,
       concat('BK-', lpad(cast(g.l_partkey as string), 6, '0')) as sls_prd_key,
       cast(o_custkey as string) as sls_cust_id,
       case when g.l_orderkey % 800 = 3 then '0' when g.l_orderkey % 900 = 5 then '5489'
            else replace(substr(cast(cast(o_orderdate as date) as string), 1, 10), '-', '') end as sls_order_dt,
       replace(substr(cast(cast(o_orderdate as date) + interval 7 day as string), 1, 10), '-', '') as sls_ship_dt,
       case when g.l_partkey % 500 = 11 then '19900101'
            else replace(substr(cast(cast(o_orderdate as date) + interval 12 day as string), 1, 10), '-', '') end
         as sls_due_dt,
       case when g.l_partkey % 600 = 13 then '' else cast(cast(q * cast(p_retailprice as decimal(18,2))
            - (case when g.l_partkey % 10 = 0 then 1 else 0 end) as decimal(18,2)) as string) end as sls_sales,
       case when g.l_orderkey % 700 = 9 then '-1' else cast(q as string) end as sls_quantity,
       cast(cast(p_retailprice as decimal(18,2)) as string) as sls_price,
       {_lineage("sales_details.csv", "crm")}
from (select l_orderkey, l_partkey, cast(sum(l_quantity) as int) as q from {{lineitem}} group by l_orderkey, l_partkey) g
join {{orders}} on g.l_orderkey = o_orderkey join {{part}} on g.l_partkey = p_partkey""",
}
RAW_NAMES = tuple(_RAW)


def _with_copies(sql: str, dialect: str) -> str:
    form = _COPIES[dialect]
    return sql.replace("{copies_2}", form.format(values="1, 2")).replace(
        "{copies_3}", form.format(values="1, 2, 3")
    )


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def raw_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = _with_copies(_RAW[name], "spark")
    tables = {t: read_table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", sql))}
    if name == "raw_sales":
        # Grouped by order and part, then joined by order: dealt by order, the lines take one exchange for both.
        lines = tables["lineitem"].select("l_orderkey", "l_partkey", "l_quantity")
        tables["lineitem"] = lines.repartition("l_orderkey")
    return spark.sql(sql, **tables)


def raw_oracle(name: str) -> str:
    sql = _with_copies(_RAW[name], "duckdb")
    return re.sub(r"\{(\w+)\}", r"\1", sql).strip()


class DerivedExtracts:
    """The six extracts under the names the warehouse uses."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._frame = lambda name: raw_frame(spark, sf_dir, name)

    @cached_property
    def customers(self) -> DataFrame:
        return self._frame("raw_customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._frame("raw_products")

    @cached_property
    def sales(self) -> DataFrame:
        return self._frame("raw_sales")

    @cached_property
    def attributes(self) -> DataFrame:
        return self._frame("raw_attr")

    @cached_property
    def geography(self) -> DataFrame:
        return self._frame("raw_geo")

    @cached_property
    def categories(self) -> DataFrame:
        return self._frame("raw_cat")
