"""Command line: ``python -m cartwheel <command> ...`` (or through spark-submit).

Commands:
  analytics  --orders P --products P --out DIR [--n 10] [--show]
             or --sf-dir DIR (warehouse tables) instead of --orders/--products
  generate   --out DIR --customers N --products N --orders N [--seed S] [--format F]
  formats    --table P --out DIR        (format benchmark + savings and best-of reports)
  timed      --sf-dir DIR [--n 10]      (timed load + analyses, with step totals)

The session comes from the environment (spark-submit, or an existing
session); ``--local N`` starts a local[N] session instead.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    if args.local:
        from cartwheel.session import local_session
        return local_session(cores=args.local)
    return SparkSession.builder.appName("cartwheel").getOrCreate()


def _analytics(spark, args) -> None:
    from cartwheel.plans.batch_run import run_analytics
    from cartwheel.sources.io import read_table
    from cartwheel.sources.tables import load_parquet, sales_inputs
    if args.sf_dir:
        orders, products = sales_inputs(spark, args.sf_dir)
    else:
        orders, products = load_parquet(spark, args.orders), load_parquet(spark, args.products)
    paths = run_analytics(orders, products, args.out, n=args.n)
    for name, path in paths.items():
        print(f"{name}: {path}")
        if args.show:
            read_table(spark, path).show(100, truncate=False)


def _generate(spark, args) -> None:
    from cartwheel.plans.format_benchmark import generate_dataset
    generate_dataset(spark, args.out, args.customers, args.products, args.orders,
                     seed=args.seed, fmt=args.format).show(truncate=False)


def _formats(spark, args) -> None:
    from cartwheel.operators.reports import best_per_metric, savings_vs_baseline
    from cartwheel.plans.format_benchmark import benchmark_formats
    from cartwheel.sources.tables import load_parquet
    metrics = benchmark_formats(load_parquet(spark, args.table), args.out)
    metrics.orderBy("ordinal").show(truncate=False)
    savings_vs_baseline(metrics).orderBy("ordinal").show(truncate=False)
    best_per_metric(metrics).show(truncate=False)


def _timed(spark, args) -> None:
    from cartwheel.operators.reports import step_totals
    from cartwheel.plans.batch_run import timed_analytics
    from cartwheel.sources.tables import load_table, sales_inputs
    tables = {t: load_table(spark, args.sf_dir, t) for t in ("customer", "part", "orders",
                                                            "lineitem")}
    orders, products = sales_inputs(spark, args.sf_dir)
    timings = timed_analytics(tables, orders, products, n=args.n)
    timings.show(truncate=False)
    loads = [f"Load {t}" for t in tables]
    analyses = ["Top Customers", "Category Sales", "Monthly Trends"]
    for label, steps in (("load total", loads), ("analysis total", analyses),
                         ("overall total", None)):
        print(label)
        step_totals(timings, steps).show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cartwheel")
    parser.add_argument("--local", type=int, default=0, help="start a local[N] session")
    sub = parser.add_subparsers(dest="command", required=True)
    a = sub.add_parser("analytics")
    a.add_argument("--orders")
    a.add_argument("--products")
    a.add_argument("--sf-dir")
    a.add_argument("--out", required=True)
    a.add_argument("--n", type=int, default=10)
    a.add_argument("--show", action="store_true")
    g = sub.add_parser("generate")
    g.add_argument("--out", required=True)
    g.add_argument("--customers", type=int, required=True)
    g.add_argument("--products", type=int, required=True)
    g.add_argument("--orders", type=int, required=True)
    g.add_argument("--seed", type=int, default=0)
    g.add_argument("--format", default="parquet")
    f = sub.add_parser("formats")
    f.add_argument("--table", required=True)
    f.add_argument("--out", required=True)
    t = sub.add_parser("timed")
    t.add_argument("--sf-dir", required=True)
    t.add_argument("--n", type=int, default=10)
    args = parser.parse_args(argv)
    if args.command == "analytics" and not args.sf_dir and not (args.orders and args.products):
        parser.error("analytics needs --sf-dir or both --orders and --products")
    spark = _session(args)
    {"analytics": _analytics, "generate": _generate, "formats": _formats,
     "timed": _timed}[args.command](
        spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
