"""Silver: typed, cleaned and deduplicated frames out of the six raw extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import labels, text, typed
from silverlode.functions.calendar import days_between
from silverlode.functions.measures import line_measures
from silverlode.operators.dedup import completeness, dedup_latest
from silverlode.operators.reject import keep_valid, rejected, split_valid

LINEAGE = {
    "_ingested_at": "bronze_ingested_at",
    "_source_file": "bronze_source_file",
    "_batch_id": "bronze_batch_id",
}
BRONZE_COLUMNS = tuple(LINEAGE.values())


def _typed(raw: DataFrame, columns: dict[str, Column]) -> DataFrame:
    carried = [F.col(old).alias(new) for old, new in LINEAGE.items()]
    return raw.select(*[c.alias(name) for name, c in columns.items()], *carried)


def _newest_load() -> list[Column]:
    return [F.desc_nulls_last("bronze_ingested_at"), F.desc_nulls_last("bronze_batch_id")]


def _date_or_earliest(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(typed.EARLIEST)).desc()


def stg_customers(raw: DataFrame) -> DataFrame:
    """One row per customer id: newest version, then the fullest record, then the newest load."""
    customers = _typed(
        raw,
        {
            "customer_id": typed.to_int("cst_id"),
            "customer_key": text.upper_code("cst_key"),
            "customer_first_name": text.blank_to_null("cst_firstname"),
            "customer_last_name": text.blank_to_null("cst_lastname"),
            "marital_code": text.upper_code("cst_marital_status"),
            "gender_code": text.upper_code("cst_gndr"),
            "customer_created_date": typed.iso_date("cst_create_date"),
        },
    ).filter(F.col("customer_id").isNotNull())
    filled = completeness(
        {"customer_first_name": 8, "customer_last_name": 4, "gender_code": 2, "marital_code": 1}
    )
    latest = dedup_latest(
        customers,
        ["customer_id"],
        [_date_or_earliest("customer_created_date"), filled.desc(), *_newest_load()],
    )
    return latest.select(
        "customer_id",
        "customer_key",
        "customer_first_name",
        "customer_last_name",
        text.full_name("customer_first_name", "customer_last_name").alias("customer_name"),
        labels.marital_status("marital_code").alias("marital_status"),
        labels.gender("gender_code").alias("gender"),
        "customer_created_date",
        *BRONZE_COLUMNS,
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """One row per product version; keys too short to hold category and sales key are dropped.

    An end date that is missing or lies before the start leaves the version open.
    """
    versions = _typed(
        raw,
        {
            "product_version_id": typed.to_int("prd_id"),
            "product_key_qualified": text.upper_code("prd_key"),
            "product_name": text.clean_name("prd_nm"),
            "product_cost": typed.to_money("prd_cost", 12, 2),
            "line_code": text.upper_code("prd_line"),
            "start_date": typed.iso_date("prd_start_dt"),
            "closed_on": typed.iso_date("prd_end_dt"),
        },
    ).filter(F.length("product_key_qualified") > 6)
    # Closed only when both dates are known to be in order or the start is unknown.
    backwards = F.coalesce(F.col("closed_on") < F.col("start_date"), F.lit(False))
    end_date = F.when(~backwards, F.col("closed_on"))
    return versions.select(
        "product_version_id",
        "product_key_qualified",
        *[c.alias(n) for n, c in text.split_qualified_key("product_key_qualified").items()],
        "product_name",
        "product_cost",
        labels.product_line("line_code").alias("product_line"),
        "start_date",
        end_date.alias("end_date"),
        F.coalesce(end_date, typed.open_end()).alias("effective_end_date"),
        end_date.isNull().alias("is_current_version"),
        *BRONZE_COLUMNS,
    )


def typed_sales(raw: DataFrame) -> DataFrame:
    """Sales lines with safe types, before any row is rejected.

    The rules below look at every typed column several times, and Spark writes a filter's columns out
    as the expressions behind them: each date would be parsed again for every mention. ``inline`` of a
    one-row array computes each value once, and filters stay above it.
    """
    values = {
        "order_number": text.upper_code("sls_ord_num"),
        "product_key": text.upper_code("sls_prd_key"),
        "customer_id": typed.to_int("sls_cust_id"),
        "order_date": typed.compact_date("sls_order_dt"),
        "ship_date": typed.compact_date("sls_ship_dt"),
        "due_date": typed.compact_date("sls_due_dt"),
        "sales_amount": typed.to_money("sls_sales"),
        "quantity": typed.to_int("sls_quantity"),
        "unit_price": typed.to_money("sls_price"),
    }
    once = F.inline(F.array(F.struct(*[c.alias(n) for n, c in values.items()])))
    return raw.select(once, *[F.col(old).alias(new) for old, new in LINEAGE.items()])


def sales_rules() -> dict[str, Column]:
    """What a sales line must satisfy to enter silver, by reason name."""
    c = F.col
    keys = {f"missing_{k}": c(k).isNotNull() for k in ("order_number", "product_key", "customer_id")}
    dates = {f"bad_{d}": c(d).isNotNull() for d in ("order_date", "ship_date", "due_date")}
    amounts = {f"bad_{m}": c(m) > 0 for m in ("sales_amount", "quantity", "unit_price")}
    # Order of dates is judged only where both dates exist, so a bad date is one reason, not two.
    sequence = {
        "ship_before_order": F.coalesce(c("ship_date") >= c("order_date"), F.lit(True)),
        "due_before_ship": F.coalesce(c("due_date") >= c("ship_date"), F.lit(True)),
    }
    return keys | dates | amounts | sequence


def sales_measures() -> dict[str, Column]:
    """What ``stg_sales`` derives from the columns of a valid line, by name."""
    return {
        "days_to_ship": days_between("order_date", "ship_date"),
        "days_to_due": days_between("order_date", "due_date"),
        "days_in_transit": days_between("ship_date", "due_date"),
        **line_measures("sales_amount", "quantity", "unit_price"),
    }


def with_sales_measures(sales: DataFrame) -> DataFrame:
    return sales.select(
        *[c for c in sales.columns if c not in BRONZE_COLUMNS],
        *[c.alias(n) for n, c in sales_measures().items()],
        *BRONZE_COLUMNS,
    )


def valid_sales(raw: DataFrame) -> DataFrame:
    """Valid order lines."""
    return keep_valid(typed_sales(raw), sales_rules())


def stg_sales(raw: DataFrame) -> DataFrame:
    """Valid order lines with latencies and price measures."""
    return with_sales_measures(valid_sales(raw))


def rejected_sales(raw: DataFrame) -> DataFrame:
    """The other lines, each with all its reasons."""
    return rejected(typed_sales(raw), sales_rules())


def split_sales(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid, rejects = split_valid(typed_sales(raw), sales_rules())
    return with_sales_measures(valid), rejects


def stg_attributes(raw: DataFrame) -> DataFrame:
    """ERP birth date and gender, one row per ERP customer id."""
    attributes = _typed(
        raw,
        {
            "erp_customer_id": text.upper_code("CID"),
            # The system prefix is upper case in the extract; only that form is a prefix.
            "customer_key": text.upper_code(text.drop_prefix(F.trim("CID"), "NAS")),
            "birth_date": typed.iso_date("BDATE"),
            "gender_code": text.upper_code("GEN"),
        },
    ).filter(F.col("erp_customer_id").isNotNull() & F.col("customer_key").isNotNull())
    latest = dedup_latest(
        attributes,
        ["erp_customer_id"],
        [
            _date_or_earliest("birth_date"),
            F.col("gender_code").isNotNull().desc(),
            *_newest_load(),
        ],
    )
    return latest.select(
        "erp_customer_id",
        "customer_key",
        "birth_date",
        labels.gender("gender_code").alias("gender"),
        *BRONZE_COLUMNS,
    )


def stg_geography(raw: DataFrame) -> DataFrame:
    """ERP country, one row per ERP customer id; a filled country beats a blank one."""
    places = _typed(
        raw,
        {
            "erp_customer_id": text.upper_code("CID"),
            "customer_key": text.upper_code(text.drop_dashes(F.trim("CID"))),
            "country_text": text.blank_to_null("CNTRY"),
        },
    ).filter(F.col("erp_customer_id").isNotNull() & F.col("customer_key").isNotNull())
    latest = dedup_latest(
        places, ["erp_customer_id"], [F.asc_nulls_last("country_text"), *_newest_load()]
    )
    return latest.select(
        "erp_customer_id", "customer_key", labels.country("country_text").alias("country")
    )


def stg_categories(raw: DataFrame) -> DataFrame:
    """Product hierarchy with the maintenance flag."""
    code = text.upper_code("MAINTENANCE")
    categories = raw.select(
        text.upper_code("ID").alias("category_id"),
        text.squeeze_spaces("CAT").alias("category_name"),
        text.squeeze_spaces("SUBCAT").alias("subcategory_name"),
        F.lower(F.coalesce(code, F.lit("no"))).alias("maintenance_code"),
        labels.maintenance_flag(code).alias("requires_maintenance"),
    ).filter(F.col("category_id").isNotNull())
    return categories.withColumn(
        "category_label", F.concat("category_id", F.lit(" | "), "category_name")
    )
