"""The six raw extracts: where their files lie and which columns they must have."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RESCUED = "_rescued_data"


@dataclass(frozen=True)
class SourceSpec:
    """One extract. Every column is a string: typing is the silver layer's business."""

    table: str
    system: str
    pattern: str  # relative to the landing folder, may hold wild cards
    columns: tuple[str, ...]
    #: Quoted fields may hold line breaks. Such a file is read by one task, so only where it must be.
    multi_line: bool = False

    @property
    def schema(self) -> T.StructType:
        return string_schema(self.columns)

    def path(self, landing: str) -> str:
        return f"{landing.rstrip('/')}/{self.pattern}"


def string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Table, system, file pattern and header of each extract.
SOURCES = (
    SourceSpec(
        "crm_cust_info",
        "crm",
        "source_crm/cust_info*.csv",
        ("cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr", "cst_create_date"),
    ),
    SourceSpec(
        "crm_prd_info",
        "crm",
        "source_crm/prd_info*.csv",
        ("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"),
    ),
    SourceSpec(
        "crm_sales_details",
        "crm",
        "source_crm/sales_details*.csv",
        (
            "sls_ord_num",
            "sls_prd_key",
            "sls_cust_id",
            "sls_order_dt",
            "sls_ship_dt",
            "sls_due_dt",
            "sls_sales",
            "sls_quantity",
            "sls_price",
        ),
    ),
    SourceSpec("erp_cust_az12", "erp", "source_erp/CUST_AZ12*.csv", ("CID", "BDATE", "GEN")),
    SourceSpec("erp_loc_a101", "erp", "source_erp/LOC_A101*.csv", ("CID", "CNTRY")),
    SourceSpec(
        "erp_px_cat_g1v2", "erp", "source_erp/PX_CAT_G1V2*.csv", ("ID", "CAT", "SUBCAT", "MAINTENANCE")
    ),
)


def sources(system: str | None = None) -> list[SourceSpec]:
    """All specs, or those of one system."""
    chosen = [s for s in SOURCES if system in (None, s.system)]
    if not chosen:
        raise ValueError(f"no source of system {system!r}")
    return chosen
