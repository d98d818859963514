"""Labelling helpers: right-closed bins, segments, cost ranges, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starbeam import config
from starbeam.config import Params


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def right_closed_bins(c: Column | str, bins: Sequence[tuple], default: str) -> Column:
    """Label by right-closed bins ``(lo, hi]``; outside every bin (or null) -> ``default``."""
    c = _col(c)
    out = None
    for lo, hi, label in bins:
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def age_group(age: Column | str) -> Column:
    return right_closed_bins(age, config.AGE_BINS, config.UNKNOWN_TEXT)


def customer_segment(lifespan: Column | str, sales: Column | str, p: Params) -> Column:
    """Ordered tests: long-lived and high spend, long-lived, else new."""
    lifespan, sales = _col(lifespan), _col(sales)
    vip, regular, new = config.CUSTOMER_SEGMENTS
    long_lived = lifespan >= F.lit(p.segment_months)
    return (F.when(long_lived & (sales > F.lit(p.vip_sales)), F.lit(vip))
            .when(long_lived, F.lit(regular))
            .otherwise(F.lit(new)))


def product_segment(sales: Column | str, p: Params) -> Column:
    sales = _col(sales)
    high, mid, low = config.PRODUCT_SEGMENTS
    return (F.when(sales > F.lit(p.product_high_sales), F.lit(high))
            .when(sales >= F.lit(p.product_mid_sales), F.lit(mid))
            .otherwise(F.lit(low)))


def cost_range_labels(bounds: Sequence) -> tuple[str, str, str, str]:
    b0, b1, b2 = bounds
    return (f"Below {b0}", f"{b0}-{b1}", f"{b1}-{b2}", f"Above {b2}")


def cost_range(cost: Column | str, bounds: Sequence) -> Column:
    """Overlapping inclusive ranges, first match wins; missing cost falls to the last."""
    cost = _col(cost)
    b0, b1, b2 = bounds
    below, low, mid, above = cost_range_labels(bounds)
    return (F.when(cost < F.lit(b0), F.lit(below))
            .when(cost.between(F.lit(b0), F.lit(b1)), F.lit(low))
            .when(cost.between(F.lit(b1), F.lit(b2)), F.lit(mid))
            .otherwise(F.lit(above)))


def three_way(a: Column, b: Column, labels: Sequence[str], null_label: str | None = "__last__") -> Column:
    """``a > b`` -> labels[0], ``a < b`` -> labels[1], otherwise labels[2].

    With ``null_label=None`` the third label needs ``a == b`` and a null comparison
    gives null.
    """
    gt, lt, eq = labels
    out = F.when(a > b, F.lit(gt)).when(a < b, F.lit(lt))
    if null_label is None:
        return out.when(a == b, F.lit(eq))
    return out.otherwise(F.lit(eq))
