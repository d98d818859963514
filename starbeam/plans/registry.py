"""Named queries over a test-data directory: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starbeam.config import FIXTURE, Params
from starbeam.operators import reports
from starbeam.operators.collation import collated_star
from starbeam.plans import analytics, oracle
from starbeam.session import apply_required_conf
from starbeam.sources import testdata

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_star(fn, p: Params) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_required_conf(spark)
        star = testdata.star(spark, sf_dir)
        return fn(collated_star(star, p.collation) if p.collation else star, p)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def star_queries(p: Params = FIXTURE) -> dict[str, QueryFn]:
    out = {name: _on_star(fn, p) for name, fn in analytics.QUERIES.items()}
    out["rp1_report_customers"] = _on_star(reports.report_customers, p)
    out["rp2_report_products"] = _on_star(reports.report_products, p)
    return out


def all_queries(p: Params = FIXTURE) -> dict[str, QueryFn]:
    from starbeam.plans import layer_queries

    out = star_queries(p)
    out.update(layer_queries.queries(p))
    return out


def all_oracle_sql(p: Params = FIXTURE) -> dict[str, str]:
    from starbeam.plans import layer_queries

    out = oracle.analytic_sql(p)
    out.update(layer_queries.oracle_sql(p))
    return out
