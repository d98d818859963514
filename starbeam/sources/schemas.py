"""Explicit schemas and column roles of the six raw inputs and the silver tables.

Bronze keeps every raw field as text (the layer stores input as it arrived);
silver converts with try_* functions, so a bad value becomes null instead of
failing the read.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _text(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# File names, column names and their aliases of the source system.
# Raw inputs: file stem, table name and header columns.
RAW_SCHEMAS = {
    "raw_cust_info": _text("cst_id", "cst_key", "cst_firstname", "cst_lastname",
                           "cst_marital_status", "cst_gndr", "cst_create_date"),
    "raw_prd_info": _text("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line",
                          "prd_start_dt", "prd_end_dt"),
    "raw_sales_details": _text("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt",
                               "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity", "sls_price"),
    "raw_cust_az12": _text("cid", "bdate", "gen"),
    "raw_loc_a101": _text("cid", "cntry"),
    "raw_px_cat_g1v2": _text("id", "cat", "subcat", "maintenance"),
}

# Default relative paths of the raw files under a data root.
RAW_FILES = {
    "raw_cust_info": "source_crm/cust_info.csv",
    "raw_prd_info": "source_crm/prd_info.csv",
    "raw_sales_details": "source_crm/sales_details.csv",
    "raw_cust_az12": "source_erp/CUST_AZ12.csv",
    "raw_loc_a101": "source_erp/LOC_A101.csv",
    "raw_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}

# Column roles: role -> accepted column names (first present wins). Replaces
# discovery by substring; a missing required role is an error.
ROLES = {
    "customer_gender": ("cst_gndr", "gender"),
    "customer_marital": ("cst_marital_status", "marital_status"),
    "customer_id": ("cst_id", "customer_id"),
    "product_cost": ("prd_cost", "cost", "price"),
    "product_key": ("prd_key", "product_key"),
    "product_end": ("prd_end_dt", "end_date"),
    "product_start": ("prd_start_dt", "start_date"),
    "sales_order_date": ("sls_order_dt", "order_date"),
    "sales_ship_date": ("sls_ship_dt", "ship_date"),
    "sales_due_date": ("sls_due_dt", "due_date"),
    "sales_order": ("sls_ord_num", "order_number"),
    "sales_product": ("sls_prd_key", "product_key"),
    "sales_customer": ("sls_cust_id", "customer_id"),
    "sales_quantity": ("sls_quantity", "quantity"),
    "sales_price": ("sls_price", "price"),
    "sales_total": ("sls_sales", "sales"),
    "erp_birthdate": ("bdate", "birthdate", "birth_date"),
    "erp_gender": ("gen",),
    "erp_customer": ("cid",),
    "location_customer": ("cid", "id"),
    "location_country": ("cntry", "country"),
    "category_id": ("id", "cat_id"),
    "category_text": ("cat", "subcat", "category", "subcategory", "maintenance"),
}


# Roles of each raw table: their columns take the first name of the role in silver.
TABLE_ROLES = {
    "raw_cust_info": ("customer_id", "customer_gender", "customer_marital"),
    "raw_prd_info": ("product_cost", "product_key", "product_start", "product_end"),
    "raw_sales_details": ("sales_order", "sales_product", "sales_customer", "sales_order_date", "sales_ship_date",
                          "sales_due_date", "sales_quantity", "sales_price", "sales_total"),
    "raw_cust_az12": ("erp_customer", "erp_birthdate", "erp_gender"),
    "raw_loc_a101": ("location_customer", "location_country"),
    "raw_px_cat_g1v2": ("category_id",),
}


def canonical_names(columns, table: str, overrides: dict | None = None) -> dict[str, str]:
    """Present column -> canonical name, for the roles of a raw table."""
    out = {}
    for role in TABLE_ROLES[table]:
        found, canonical = resolve(columns, role, overrides=overrides), ROLES[role][0]
        if found is not None and found != canonical and canonical not in columns:
            out[found] = canonical
    return out


def resolve(columns, role: str, required: bool = False, overrides: dict | None = None) -> str | None:
    """The column that plays ``role`` in ``columns``."""
    names = (overrides or {}).get(role) or ROLES[role]
    if isinstance(names, str):
        names = (names,)
    present = {c: c for c in columns}
    for name in names:
        if name in present:
            return name
    if required:
        raise KeyError(f"no column for role {role!r} among {list(columns)}")
    return None


def resolve_all(columns, role: str) -> list[str]:
    """Every present column of a multi-column role (e.g. the text fields to fill)."""
    return [c for c in ROLES[role] if c in set(columns)]
