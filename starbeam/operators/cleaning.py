"""Silver cleaning (bronze -> silver): CLN1-CLN16.

Each rule is a column expression or a one-step DataFrame transform; the six table
cleaners compose them. A rule runs only when its column role is present in the
table (CLN16); roles accept both the names the source system writes and the names
later layers use, so no rule is skipped because of a naming difference.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbeam import config
from starbeam.functions import dates, numeric, text
from starbeam.functions.numeric import AMOUNT, PRICE, QUANTITY
from starbeam.sources.csv_source import BAD_ROW
from starbeam.sources.schemas import ROLES, canonical_names, resolve, resolve_all

# ---------------------------------------------------------------- generic rules


def _each(df: DataFrame, roles, rule) -> DataFrame:
    """CLN16: ``rule`` on every present column of the roles, aliases beside the first name included; without one
    the table is unchanged."""
    cols = [c for role in roles for c in resolve_all(df.columns, role)]
    return df.withColumns({c: rule(c) for c in cols}) if cols else df


def normalise_headers(df: DataFrame) -> DataFrame:
    """CLN1: every column name lower-cased and stripped."""
    return df.toDF(*[c.lower().strip() for c in df.columns])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """CLN2: drop rows equal in every column (nulls compare equal). Partial
    de-duplication runs before the shuffle."""
    return df.dropDuplicates()


def recode_gender(df: DataFrame, role: str = "customer_gender") -> DataFrame:
    """CLN3 / CLN13: M / F (and the words) to Male / Female; N/A, NAS -> null."""
    return _each(df, [role], lambda c: text.recode(c, config.GENDER_CODES, config.GENDER_NULL_CODES))


def recode_marital(df: DataFrame) -> DataFrame:
    """CLN4: S / M (and the words) to Single / Married."""
    return _each(df, ["customer_marital"], lambda c: text.recode(c, config.MARITAL_CODES))


def coerce_integer_key(df: DataFrame, role: str = "customer_id") -> DataFrame:
    """CLN5: the key as BIGINT ('11000.0' -> 11000); anything else -> null."""
    return _each(df, [role], numeric.try_integer)


def coerce_decimal_or_zero(df: DataFrame, columns, kind: str = PRICE) -> DataFrame:
    """CLN6: text to the exact DECIMAL ``kind`` (4 places by default; fractions stay);
    unparseable or missing -> 0."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: F.coalesce(text.strip(c).try_cast(kind), F.lit(0).cast(kind)) for c in present})


def split_compound_product_key(df: DataFrame) -> DataFrame:
    """CLN7: ``CO-RF-FR-R92B-58`` -> ``cat_id`` ``CO_RF`` (first two segments joined
    by ``_``, the category table's form) and ``prd_key`` ``FR-R92B-58`` (the rest)."""
    c = resolve(df.columns, "product_key")
    if c is None:
        return df
    parts = text.split_segments(c, "-")
    return df.withColumns({
        "cat_id": text.join_segments(parts, 0, 2, "_"),
        c: text.join_segments(parts, 2, None, "-"),
    })


def _date_rule(forms: dict | None):
    """How CLN8 reads a column: in its voted form where one is given (``date_order``), else ISO and month-first."""
    return lambda c: dates.parse_in_form(c, forms[c]) if forms and c in forms else dates.parse_date(c)


def coerce_dates(df: DataFrame, roles, forms: dict | None = None) -> DataFrame:
    """CLN8: free-form date text -> DATE; invalid -> null. ``forms`` has the date form of columns (``date_order.vote``)."""
    return _each(df, roles, _date_rule(forms))


def parse_compact_dates(df: DataFrame, roles) -> DataFrame:
    """CLN9: yyyymmdd (number or text) -> DATE; ``0`` or an impossible day -> null."""
    return _each(df, roles, dates.parse_yyyymmdd)


def add_sales_amount(df: DataFrame) -> DataFrame:
    """CLN10: sales_amount = quantity x price (the stated line total is not used). A
    product too large for the type is null and counted by DQ9 and DQ10; it ends no job."""
    q, p = resolve(df.columns, "sales_quantity"), resolve(df.columns, "sales_price")
    if q is None or p is None:
        return df
    return df.withColumn("sales_amount", (F.col(q) * F.col(p)).try_cast(AMOUNT))


def sales_key_columns(df: DataFrame) -> list[str]:
    return [c for c in (resolve(df.columns, r) for r in ("sales_order", "sales_product", "sales_customer"))
            if c is not None]


def drop_null_keys(df: DataFrame) -> DataFrame:
    """CLN11: drop sales rows missing an order, product or customer key."""
    keys = sales_key_columns(df)
    return df.na.drop("any", subset=keys) if keys else df


def null_future_dates(df: DataFrame, as_of: dt.date) -> DataFrame:
    """CLN12: a birth date after ``as_of`` becomes null."""
    return _each(df, ["erp_birthdate"], lambda c: dates.not_after(c, as_of))


def standardise_country(df: DataFrame) -> DataFrame:
    """CLN14: strip; country codes to names; missing or blank -> Unknown."""
    def named(c: str) -> Column:
        stripped = text.strip(c)
        known = text.lookup(stripped, config.COUNTRY_CODES, default=stripped)
        return F.when(stripped.isNull() | (stripped == ""), F.lit(config.UNKNOWN_TEXT)).otherwise(known)

    return _each(df, ["location_country"], named)


def fill_missing_text(df: DataFrame) -> DataFrame:
    """CLN15: category text fields: missing -> Unknown, then stripped."""
    return _each(df, ["category_text"], lambda c: text.fill_text(c, config.UNKNOWN_TEXT))


# ---------------------------------------------------------------- table cleaners


def base_clean(df: DataFrame, watch=None) -> DataFrame:
    """CLN1 + CLN2, the first two steps of every table cleaner (the bronze mark of
    malformed rows stays in bronze). ``watch`` is an Observation and the measures it takes
    of the rows as they are now, before any value is parsed."""
    out = drop_exact_duplicates(normalise_headers(df).drop(BAD_ROW))
    return out.observe(watch[0], *watch[1]) if watch else out


def _money(c: str, kind: str = PRICE) -> Column:
    return text.strip(c).try_cast(kind)


def _quantity(c: str) -> Column:
    return _money(c, QUANTITY)


#: By raw table: rule, role of the column, how the rule reads it, what becomes of a value that it cannot read.
READS = {
    "raw_cust_info": (("CLN5", "customer_id", numeric.try_integer, "null"),),
    "raw_prd_info": (("CLN6", "product_cost", _money, "zero"), ("CLN8", "product_start", dates.parse_date, "null"), ("CLN8", "product_end", dates.parse_date, "null")),
    "raw_sales_details": (
        ("CLN9", "sales_order_date", dates.parse_yyyymmdd, "null"), ("CLN9", "sales_ship_date", dates.parse_yyyymmdd, "null"),
        ("CLN9", "sales_due_date", dates.parse_yyyymmdd, "null"), ("CLN6", "sales_quantity", _quantity, "zero"), ("CLN6", "sales_price", _money, "zero"),
        ("CLN6", "sales_total", _money, "zero"), ("CLN5", "sales_customer", numeric.try_integer, "null")),
    "raw_cust_az12": (("CLN8", "erp_birthdate", dates.parse_date, "null"),),
}


def date_columns(name: str, columns) -> list[str]:
    """The free-form date columns (CLN8) of a raw table."""
    return [c for rule, role, _, _ in READS.get(name, ()) if rule == "CLN8" for c in resolve_all(columns, role)]


def loss_measures(name: str, columns: list[str], as_of: dt.date, forms: dict | None = None) -> dict[str, Column]:
    """Counts of the values of a de-duplicated raw table that cleaning cannot keep, one measure a rule, column and kind:
    ``missing`` (null or blank), ``null`` and ``zero`` (present, but unreadable and replaced), ``short`` keys, ``overflow``, ``future``."""
    out, date_of = {}, _date_rule(forms)
    for rule, role, read, instead in READS.get(name, ()):
        read = date_of if rule == "CLN8" else read
        for c in resolve_all(columns, role):
            present = F.coalesce(text.strip(F.col(c).cast("string")) != "", F.lit(False))
            out[f"{rule}_{c}_missing"] = F.count_if(~present)
            out[f"{rule}_{c}_{instead}"] = F.count_if(present & read(c).isNull())
    if name == "raw_prd_info" and (key := resolve(columns, "product_key")):
        out[f"CLN7_{key}_short"] = F.count_if(F.size(text.split_segments(key, "-")) < 3)
    if name == "raw_sales_details":
        q, p = resolve(columns, "sales_quantity"), resolve(columns, "sales_price")
        if q and p:
            amount = F.coalesce(_quantity(q), F.lit(0).cast(QUANTITY)) * F.coalesce(_money(p), F.lit(0).cast(PRICE))
            out["CLN10_sales_amount_overflow"] = F.count_if(amount.try_cast(AMOUNT).isNull())
    if name == "raw_cust_az12" and (c := resolve(columns, "erp_birthdate")):
        out[f"CLN12_{c}_future"] = F.count_if(date_of(c) > F.lit(as_of))
    return out


def clean_cust_info(df: DataFrame, as_of: dt.date | None = None, watch=None) -> DataFrame:
    out = base_clean(df, watch)
    out = recode_gender(out, "customer_gender")
    out = recode_marital(out)
    return coerce_integer_key(out, "customer_id")


def clean_prd_info(df: DataFrame, as_of: dt.date | None = None, watch=None, forms=None) -> DataFrame:
    out = base_clean(df, watch)
    out = coerce_decimal_or_zero(out, ROLES["product_cost"])
    out = split_compound_product_key(out)
    if "prd_id" in out.columns:
        out = out.withColumn("prd_id", numeric.try_integer("prd_id"))
    return coerce_dates(out, ("product_start", "product_end"), forms)


def clean_sales_details(df: DataFrame, as_of: dt.date | None = None, observation=None, watch=None) -> DataFrame:
    """Sales cleaner. With a ``pyspark.sql.Observation`` it also records, during
    whatever action runs the result, the rows after de-duplication and the rows
    dropped for a missing key (no extra pass over the data)."""
    out = base_clean(df, watch)
    out = parse_compact_dates(out, ("sales_order_date", "sales_ship_date", "sales_due_date"))
    out = coerce_decimal_or_zero(out, ROLES["sales_quantity"], QUANTITY)
    out = coerce_decimal_or_zero(out, ROLES["sales_price"] + ROLES["sales_total"])
    out = add_sales_amount(out)
    out = coerce_integer_key(out, "sales_customer")
    # always true, and not moved by the optimiser: without it the filters of later steps run before the rows are
    # exchanged, with all parsing in them written out again, and readers with different filters share no exchange
    out = out.where(F.spark_partition_id() >= 0)
    if observation is not None:
        missing = F.lit(False)
        for k in sales_key_columns(out):
            missing = missing | F.col(k).isNull()
        out = out.observe(observation, F.count(F.lit(1)).alias("rows_deduped"),
                          F.count_if(missing).alias("rows_null_key"))
    return drop_null_keys(out)


def clean_cust_az12(df: DataFrame, as_of: dt.date, watch=None, forms=None) -> DataFrame:
    out = base_clean(df, watch)
    out = coerce_dates(out, ("erp_birthdate",), forms)
    out = null_future_dates(out, as_of)
    return recode_gender(out, "erp_gender")


def clean_loc_a101(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return standardise_country(base_clean(df))


def clean_px_cat_g1v2(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return fill_missing_text(base_clean(df))


CLEANERS = {
    "raw_cust_info": ("clean_cust_info", clean_cust_info),
    "raw_prd_info": ("clean_prd_info", clean_prd_info),
    "raw_sales_details": ("clean_sales_details", clean_sales_details),
    "raw_cust_az12": ("clean_cust_az12", clean_cust_az12),
    "raw_loc_a101": ("clean_loc_a101", clean_loc_a101),
    "raw_px_cat_g1v2": ("clean_px_cat_g1v2", clean_px_cat_g1v2),
}


def canonical(name: str, df: DataFrame, overrides: dict | None = None) -> DataFrame:
    """CLN16 / DIM12: headers normalised and every role's column under its canonical name."""
    df = normalise_headers(df)
    return df.withColumnsRenamed(canonical_names(df.columns, name, overrides))


def clean(name: str, df: DataFrame, as_of: dt.date, overrides: dict | None = None, losses=None, forms: dict | None = None, **options) -> tuple[str, DataFrame]:
    """(silver name, cleaned table). ``losses`` is an Observation that gets the ``loss_measures``
    of the table during whatever action runs the result (no extra pass over the data). ``forms`` has the date form
    of columns by vote; columns without one are read ISO and month-first."""
    target, fn = CLEANERS[name]
    frame = canonical(name, df, overrides)
    if forms and date_columns(name, frame.columns):
        options["forms"] = forms
    if losses is not None and (measures := loss_measures(name, frame.columns, as_of, forms)):
        options["watch"] = (losses, [c.alias(m) for m, c in measures.items()])
    return target, fn(frame, as_of, **options)
