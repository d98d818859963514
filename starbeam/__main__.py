"""Command line: the layered warehouse run.

    python -m starbeam --source csv --root DATASETS --out WAREHOUSE [--with-reports | --with-analytics | --full]
    python -m starbeam --source testdata --sf-dir /root/testdata/sf0.01 --out WAREHOUSE --full

Prints the audit (one line per written table), the seconds per layer and the total;
exits non-zero when a layer fails. ``--extracts DIR`` also writes the CSV extracts. ``--restart`` takes
the tables whose inputs, parameters and code have not changed as they stand under ``--out``.

    python -m starbeam --out WAREHOUSE --no-build --sql "SELECT cat, SUM(sales_amount) FROM fact_sales ..."

runs SQL text over a built warehouse (views fact_sales, dim_customers, dim_products,
dim_date, report_customers, report_products) and shows the first rows.
"""

from __future__ import annotations

import argparse
import sys
import time
from dataclasses import replace

from starbeam.config import DEFAULT, FIXTURE
from starbeam.plans import warehouse
from starbeam.session import ensure_checkpoint_dir


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="starbeam")
    ap.add_argument("--source", choices=("csv", "testdata"), default="csv")
    ap.add_argument("--root", help="folder holding source_crm/ and source_erp/ (csv source)")
    ap.add_argument("--sf-dir", help="test-data folder (testdata source)")
    ap.add_argument("--out", required=True, help="warehouse folder (shared storage on a cluster)")
    ap.add_argument("--with-reports", action="store_true")
    ap.add_argument("--with-analytics", action="store_true")
    ap.add_argument("--full", action="store_true")
    ap.add_argument("--extracts", help="folder for the CSV extracts")
    ap.add_argument("--restart", action="store_true", help="leave tables alone that would come out the same")
    ap.add_argument("--collation", help="collation of the gold layer's text, such as UNICODE_CI_AI (default: bytes)")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--no-build", action="store_true", help="use the tables already under --out")
    ap.add_argument("--sql", help="SQL text to run over the warehouse views")
    ap.add_argument("--show", type=int, default=50, help="rows of the --sql result to show")
    ap.add_argument("--sql-out", help="folder for the whole --sql result (Parquet); without it the first rows are shown")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("starbeam-warehouse").config("spark.ui.enabled", "false")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    from starbeam.session import apply_required_conf

    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)

    if args.no_build:
        return _run_sql(spark, args) if args.sql else 0

    missing, paths = None, {}
    if args.source == "csv":
        from starbeam.sources.csv_source import load_sources

        load = load_sources(spark, args.root)
        raw, missing, paths, params = load.tables, load.missing, load.paths, DEFAULT
        for name, path in load.missing.items():
            print(f"missing source {name}: {path}")
    else:
        from starbeam.sources import raw_adapter

        raw, params = raw_adapter.raw_tables(spark, args.sf_dir), FIXTURE

    params = replace(params, collation=args.collation)
    t0 = time.time()
    res = warehouse.run(spark, raw, args.out, params, with_reports=args.with_reports,
                        with_analytics=args.with_analytics, full=args.full, missing_sources=missing, restart=args.restart, source_files=paths)
    for layer, table, rows_in, rows, removed, cols, secs, error, reused in res.audit:
        if error:
            print(f"{layer:10s} {table:32s} FAILED {error}")
            continue
        cleaned = f" in={rows_in:,d} removed={removed:,d}" if rows_in is not None else ""
        print(f"{layer:10s} {table:32s} rows={rows:>12,d} cols={cols:3d} {secs:8.2f}s{cleaned}{' as it stood' if reused else ''}")
    for layer, secs in res.layer_seconds.items():
        print(f"layer {layer:10s} {secs:8.2f}s")
    print(f"total {time.time() - t0:.2f}s {'OK' if res.ok else 'FAILED at ' + str(res.failed_layer)}")
    for error in res.errors:
        print(error)
    if args.extracts and res.ok:
        for name, path in warehouse.publish_extracts(res, args.extracts).items():
            print(f"extract {name}: {path}")
    if args.sql and res.ok:
        _run_sql(spark, args)
    return 0 if res.ok else 1


def _run_sql(spark, args) -> int:
    import os

    from starbeam.plans.table_store import read_table

    gold = {}
    for name in ("dim_customers", "dim_products", "dim_date", "fact_sales", "report_customers", "report_products"):
        path = os.path.join(args.out, "gold", name)
        if os.path.exists(path) or "://" in path:
            gold[name] = read_table(spark, path)
    reports = {k: gold.pop(k) for k in ("report_customers", "report_products") if k in gold}
    warehouse.register_views(warehouse.star_from_gold(gold, args.collation), reports)
    result = spark.sql(args.sql)
    if args.sql_out:
        result.write.mode("overwrite").parquet(args.sql_out)
    else:
        result.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
