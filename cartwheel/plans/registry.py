"""Registered queries over the warehouse tables, with their SQL oracles.

Each entry of :data:`QUERIES` takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the whole tables in ``sf_dir``.  :data:`ORACLE_SQL` holds, for
the same key, an independent ANSI-SQL statement over the raw tables (views
``lineitem``, ``orders``, ``part``, ``customer``, ...) that must give the same
multiset of rows with the same column names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.random import draw_sql, uniform_sql
from cartwheel.operators import generate, sales
from cartwheel.sources.tables import load_table, sales_inputs

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn
    return wrap


# ---------------------------------------------------------------- SQL pieces
# Exact line revenue: quantities and prices of the tables have two decimals at most.
_REV_SQL = "CAST(quantity AS DECIMAL(18,2)) * CAST(price AS DECIMAL(18,2))"

_LINES_SQL = """
lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
         l_quantity AS quantity
  FROM lineitem
)"""

_ORDERS_SQL = """
ord AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
         l_quantity AS quantity,
         o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_PRODUCTS_SQL = """
products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS price FROM part
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ---------------------------------------------------------------- sales


@register("line_revenue", _with(_LINES_SQL, _PRODUCTS_SQL) + f"""
SELECT l.product_id, l.order_id, l.quantity, p.price,
       CAST({_REV_SQL} AS DOUBLE) AS line_revenue
FROM lines l JOIN products p ON l.product_id = p.product_id
""")
def q_line_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir, with_header=False)
    return sales.line_revenue(orders, products)


@register("top_customers_by_revenue", _with(_ORDERS_SQL, _PRODUCTS_SQL) + f"""
, priced AS (
  SELECT o.*, p.price, {_REV_SQL} AS rev
  FROM ord o JOIN products p ON o.product_id = p.product_id
)
SELECT customer_id,
       CAST(SUM(rev) AS DOUBLE) AS total_revenue,
       COUNT(order_id) AS order_count,
       CAST(SUM(rev) AS DOUBLE) / NULLIF(COUNT(order_id), 0) AS avg_order_value
FROM priced
GROUP BY customer_id
ORDER BY total_revenue DESC NULLS LAST, customer_id ASC NULLS FIRST
LIMIT 10
""")
def q_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir)
    return sales.top_customers_by_revenue(orders, products, n=10)


@register("sales_by_category", _with(_LINES_SQL, _PRODUCTS_SQL) + f"""
, priced AS (
  SELECT l.*, p.price, p.category, {_REV_SQL} AS rev
  FROM lines l JOIN products p ON l.product_id = p.product_id
)
SELECT category,
       CAST(SUM(rev) AS DOUBLE) AS total_revenue,
       SUM(quantity) AS total_units_sold,
       CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT(price), 0) AS avg_price,
       COUNT(order_id) AS order_count
FROM priced
GROUP BY category
""")
def q_sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir, with_header=False)
    return sales.sales_by_category(orders, products)


@register("monthly_trends", _with(_ORDERS_SQL, _PRODUCTS_SQL) + f"""
, priced AS (
  SELECT o.*, p.price, {_REV_SQL} AS rev
  FROM ord o JOIN products p ON o.product_id = p.product_id
), monthly AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS year_month,
         CAST(SUM(rev) AS DOUBLE) AS total_revenue
  FROM priced GROUP BY 1
), lagged AS (
  SELECT year_month, total_revenue,
         LAG(total_revenue) OVER (ORDER BY year_month ASC NULLS FIRST) AS prev_month_revenue
  FROM monthly
)
SELECT year_month, total_revenue, prev_month_revenue,
       (total_revenue - prev_month_revenue) / NULLIF(prev_month_revenue, 0) * 100
         AS growth_percentage
FROM lagged
""")
def q_monthly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir)
    return sales.monthly_trends(orders, products)


@register("top_customers_fractional", """
SELECT o_custkey AS customer_id, CAST(SUM(rev) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count,
       CAST(SUM(rev) AS DOUBLE) / COUNT(*) AS avg_order_value
FROM (SELECT o_custkey, CAST(l_quantity / 4 AS DECIMAL(18,2)) * CAST(p_retailprice / 8 AS DECIMAL(18,5)) AS rev
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
GROUP BY o_custkey
""")
def q_top_customers_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers' revenue with quarter units and eighth prices: nothing is whole."""
    orders, products = sales_inputs(spark, sf_dir)
    return sales.top_customers_by_revenue(
        orders.withColumn("quantity", F.col("quantity") / 4),
        products.withColumn("price", F.col("price") / 8), n=None)


# Left joins over orphans: the products whose key is no multiple of this are
# moved out of range, so most lines have no product and many customers none at all.
KEPT_PARTS = 50

_ORPHANS_SQL = f"""
, stock AS (SELECT CASE WHEN product_id % {KEPT_PARTS} = 0 THEN product_id ELSE -product_id - 1 END AS product_id,
                  category, price FROM products)"""


def _orphan_inputs(spark: SparkSession, sf_dir: str):
    orders, products = sales_inputs(spark, sf_dir)
    moved = F.when(F.col("product_id") % KEPT_PARTS == 0, F.col("product_id")) \
             .otherwise(-F.col("product_id") - 1)
    return orders, products.withColumn("product_id", moved)


@register("customer_revenue_left_orphans", _with(_ORDERS_SQL, _PRODUCTS_SQL) + _ORPHANS_SQL + f"""
SELECT customer_id, CAST(SUM({_REV_SQL}) AS DOUBLE) AS total_revenue
FROM ord o LEFT JOIN stock p ON o.product_id = p.product_id GROUP BY customer_id
""")
def q_customer_revenue_left_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer; NULL where no line has a product."""
    return sales.customer_revenue_left(*_orphan_inputs(spark, sf_dir), n=None)


@register("customer_revenue_left_zero_orphans", _with(_ORDERS_SQL, _PRODUCTS_SQL) + _ORPHANS_SQL + f"""
SELECT customer_id, COALESCE(CAST(SUM({_REV_SQL}) AS DOUBLE), 0.0) AS revenue
FROM ord o LEFT JOIN stock p ON o.product_id = p.product_id
WHERE customer_id IS NOT NULL GROUP BY customer_id
""")
def q_customer_revenue_left_zero_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer; 0.0 where no line has a product."""
    return sales.customer_revenue_left_zero(*_orphan_inputs(spark, sf_dir), n=None)


@register("customer_revenue_left", _with(_ORDERS_SQL, _PRODUCTS_SQL) + f"""
, priced AS (
  SELECT o.*, p.price, {_REV_SQL} AS rev
  FROM ord o LEFT JOIN products p ON o.product_id = p.product_id
)
SELECT customer_id, CAST(SUM(rev) AS DOUBLE) AS total_revenue
FROM priced
GROUP BY customer_id
ORDER BY total_revenue DESC NULLS LAST, customer_id ASC NULLS FIRST
LIMIT 10
""")
def q_customer_revenue_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir)
    return sales.customer_revenue_left(orders, products, n=10)


@register("customer_revenue_left_zero", _with(_ORDERS_SQL, _PRODUCTS_SQL) + f"""
, priced AS (
  SELECT o.*, p.price, {_REV_SQL} AS rev
  FROM ord o LEFT JOIN products p ON o.product_id = p.product_id
)
SELECT customer_id, COALESCE(CAST(SUM(rev) AS DOUBLE), 0.0) AS revenue
FROM priced
WHERE customer_id IS NOT NULL
GROUP BY customer_id
ORDER BY revenue DESC, customer_id ASC
LIMIT 10
""")
def q_customer_revenue_left_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir)
    return sales.customer_revenue_left_zero(orders, products, n=10)


@register("sum_by_category", _with(_LINES_SQL, _PRODUCTS_SQL) + """
SELECT p.category, SUM(l.quantity) AS total_amount
FROM lines l JOIN products p ON l.product_id = p.product_id
GROUP BY p.category
""")
def q_sum_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = sales_inputs(spark, sf_dir, with_header=False)
    return sales.sum_by_product_key(orders, products, "category", "quantity", "total_amount")


# ---------------------------------------------------------------- datasets

_SUMMARY_TABLES = ("customer", "part", "orders", "lineitem")


@register("dataset_summary", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, COUNT(*) AS record_count FROM {t}" for t in _SUMMARY_TABLES))
def q_dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.reports import dataset_summary
    return dataset_summary({t: load_table(spark, sf_dir, t) for t in _SUMMARY_TABLES})


# The given tables' files, found by the row counts that their footers hold.
@register("stored_sizes", "\nUNION ALL\n".join(f"""
SELECT '{t}' AS dataset, COUNT(*) AS files, CAST(SUM(size) AS BIGINT) AS size_bytes,
       printf('%.2f MB', SUM(size) / 1048576) AS size_mb
FROM read_blob('/root/testdata/sf*/{t}.parquet')
WHERE filename IN (SELECT file_name FROM parquet_file_metadata('/root/testdata/sf*/{t}.parquet')
                   WHERE num_rows = (SELECT COUNT(*) FROM {t}))""" for t in _SUMMARY_TABLES))
def q_stored_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import reduce

    from cartwheel.sources.io import stored_size
    from cartwheel.sources.tables import table_path
    sizes = [stored_size(spark, table_path(sf_dir, t)).select(F.lit(t).alias("dataset"), "*") for t in _SUMMARY_TABLES]
    return reduce(DataFrame.unionByName, sizes)


# ---------------------------------------------------------------- literal rows

RETURN_FLAGS = [("A", "accepted"), ("N", "none"), ("R", "returned")]


@register("lines_by_return_label", f"""
SELECT label, COUNT(*) AS line_count
FROM lineitem JOIN (VALUES {", ".join(map(str, RETURN_FLAGS))}) f(flag, label) ON l_returnflag = flag
GROUP BY label
""")
def q_lines_by_return_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal rows joined to a table: the label of each return flag."""
    labels = spark.createDataFrame(RETURN_FLAGS, "flag string, label string")
    lines = load_table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return lines.join(labels, F.col("l_returnflag") == F.col("flag")).groupBy("label") \
                .agg(F.sum("n").alias("line_count"))


# ---------------------------------------------------------------- co-located layout


@register("customers_on_buckets", _with(_ORDERS_SQL, _PRODUCTS_SQL) + f"""
SELECT customer_id, CAST(SUM({_REV_SQL}) AS DOUBLE) AS total_revenue, COUNT(order_id) AS order_count,
       CAST(SUM({_REV_SQL}) AS DOUBLE) / NULLIF(COUNT(order_id), 0) AS avg_order_value
FROM ord o JOIN products p ON o.product_id = p.product_id GROUP BY customer_id
""")
def q_customers_on_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.sources.layout import customers_on_buckets
    return customers_on_buckets(spark, sf_dir, buckets=8)


# ---------------------------------------------------------------- storage formats


def _roundtrip_query(fmt: str, table: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from cartwheel.session import scratch_path
        from cartwheel.sources.io import roundtrip
        source = load_table(spark, sf_dir, table)
        return roundtrip(source, scratch_path(spark, f"roundtrip-{table}-{fmt}"), fmt)
    run.__name__ = f"q_roundtrip_{fmt}_{table}"
    return run


for _fmt in ("parquet", "csv", "orc"):
    register(f"roundtrip_{_fmt}", "SELECT * FROM events")(_roundtrip_query(_fmt, "events"))
    register(f"roundtrip_{_fmt}_customer", "SELECT * FROM customer")(
        _roundtrip_query(_fmt, "customer"))


# ---------------------------------------------------------------- end-to-end run


@register("analytics_run", _with(_ORDERS_SQL, _PRODUCTS_SQL) + f"""
, priced AS (
  SELECT o.*, p.category, {_REV_SQL} AS rev
  FROM ord o JOIN products p ON o.product_id = p.product_id
), top AS (
  SELECT CAST(customer_id AS VARCHAR) AS key, CAST(SUM(rev) AS DOUBLE) AS total_revenue
  FROM priced GROUP BY customer_id
  ORDER BY total_revenue DESC NULLS LAST, customer_id ASC NULLS FIRST LIMIT 10
)
SELECT 'top_customers' AS dataset, key, total_revenue FROM top
UNION ALL
SELECT 'category_sales', category, CAST(SUM(rev) AS DOUBLE) FROM priced GROUP BY category
UNION ALL
SELECT 'monthly_trends', CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR),
       CAST(SUM(rev) AS DOUBLE)
FROM priced GROUP BY 2
""")
def q_analytics_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the three analyses, then read back every written row.

    Columns: dataset, key (customer id, category or month as text),
    total_revenue -- the common columns of the three written datasets.
    """
    keys = {"top_customers": "customer_id", "category_sales": "category",
            "monthly_trends": "year_month"}
    written = _written_analyses(spark, sf_dir)
    parts = [written[name].select(F.lit(name).alias("dataset"),
                                  F.col(key).cast("string").alias("key"), "total_revenue")
             for name, key in keys.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _written_analyses(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Run the analyses into a scratch folder, deleted when the application ends."""
    from cartwheel.plans.batch_run import run_analytics
    from cartwheel.session import scratch_path
    from cartwheel.sources.io import read_table
    orders, products = sales_inputs(spark, sf_dir)
    paths = run_analytics(orders, products, scratch_path(spark, "analytics-run"))
    return {name: read_table(spark, path) for name, path in paths.items()}


# Each dataset that the run writes, with all its columns, against the SQL of its own query.
for _name, _query in (("top_customers", "top_customers_by_revenue"), ("category_sales", "sales_by_category"),
                      ("monthly_trends", "monthly_trends")):
    register(f"analytics_run_{_name}", ORACLE_SQL[_query])(
        lambda spark, sf_dir, _name=_name: _written_analyses(spark, sf_dir)[_name])


# ---------------------------------------------------------------- metric reports
# Metric tables derived from lineitem, one row per line number (the "format"
# label).  The source columns have two decimals; means are exact integer
# sums of hundredths (floor(x * 100 + 0.5), plain double arithmetic, no
# per-row decimal) divided by 100 and by the count, the same IEEE steps in
# both engines, so both produce the same doubles whatever the summing order.


def _mean(c: str):
    hundredths = F.floor(F.col(c) * F.lit(100.0) + F.lit(0.5))
    return F.try_divide(F.sum(hundredths).cast("double") / F.lit(100.0), F.count(c))


def _mean_sql(c: str) -> str:
    return (f"CAST(SUM(CAST(FLOOR({c} * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT))"
            f" AS DOUBLE) / CAST(100 AS DOUBLE) / NULLIF(COUNT({c}), 0)")


def phase_metrics(lineitem: DataFrame) -> DataFrame:
    return (lineitem.groupBy("l_linenumber")
            .agg(_mean("l_discount").alias("write_cpu_s"),
                 _mean("l_tax").alias("read_cpu_s"),
                 _mean("l_quantity").alias("write_peak_mb"),
                 (_mean("l_extendedprice") / F.lit(1000.0)).alias("read_peak_mb"),
                 (F.count(F.lit(1)).cast("double") / F.lit(1000.0)).alias("file_size_mb"))
            .select(F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("format"),
                    F.col("l_linenumber").cast("bigint").alias("ordinal"),
                    "write_cpu_s", "read_cpu_s", "write_peak_mb", "read_peak_mb",
                    "file_size_mb"))


def format_metrics(lineitem: DataFrame) -> DataFrame:
    from cartwheel.operators.reports import energy_and_peak
    return (energy_and_peak(phase_metrics(lineitem))
            .withColumn("write_time_s", F.col("write_cpu_s"))
            .withColumn("read_time_s", F.col("read_cpu_s")))


_PHASES_SQL = f"""
phases AS (
  SELECT 'L' || CAST(l_linenumber AS VARCHAR) AS format,
         CAST(l_linenumber AS BIGINT) AS ordinal,
         {_mean_sql('l_discount')} AS write_cpu_s,
         {_mean_sql('l_tax')} AS read_cpu_s,
         {_mean_sql('l_quantity')} AS write_peak_mb,
         {_mean_sql('l_extendedprice')} / 1000.0 AS read_peak_mb,
         CAST(COUNT(*) AS DOUBLE) / 1000.0 AS file_size_mb
  FROM lineitem GROUP BY l_linenumber
)"""

_METRICS_SQL = _PHASES_SQL + """,
metrics AS (
  SELECT *, write_cpu_s + read_cpu_s AS cpu_time_s,
         GREATEST(write_peak_mb, read_peak_mb) AS peak_memory_mb,
         (write_cpu_s + read_cpu_s) * CAST(65 AS DOUBLE) / CAST(3600 AS DOUBLE) AS energy_wh,
         write_cpu_s AS write_time_s, read_cpu_s AS read_time_s
  FROM phases
)"""


@register("energy_and_peak", "WITH" + _METRICS_SQL + """
SELECT format, ordinal, write_cpu_s, read_cpu_s, write_peak_mb, read_peak_mb, file_size_mb,
       cpu_time_s, peak_memory_mb, energy_wh
FROM metrics
""")
def q_energy_and_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.reports import energy_and_peak
    return energy_and_peak(phase_metrics(load_table(spark, sf_dir, "lineitem")))


def _savings_sql(metric: str, name: str) -> str:
    return (f"ROUND_EVEN((b.{metric} - m.{metric}) / NULLIF(b.{metric}, 0) * 100, 2)"
            f' AS "{name}"')


@register("savings_vs_baseline", "WITH" + _METRICS_SQL + """,
base AS (SELECT * FROM metrics WHERE format = 'L1' ORDER BY ordinal LIMIT 1)
SELECT m.*, """ + ",\n       ".join(_savings_sql(metric, name) for name, metric in (
    ("size_savings_%", "file_size_mb"), ("write_time_savings_%", "write_time_s"),
    ("read_time_savings_%", "read_time_s"), ("energy_savings_%", "energy_wh"))) + """
FROM metrics m LEFT JOIN base b ON TRUE
WHERE m.format <> 'L1'
""")
def q_savings_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.reports import savings_vs_baseline
    return savings_vs_baseline(format_metrics(load_table(spark, sf_dir, "lineitem")), baseline="L1")


@register("best_per_metric", "WITH" + _METRICS_SQL + """,
stacked AS (
  SELECT 'Fastest Write' AS title, 'write_time_s' AS metric, format, ordinal,
         write_time_s AS value FROM metrics
  UNION ALL SELECT 'Fastest Read', 'read_time_s', format, ordinal, read_time_s FROM metrics
  UNION ALL SELECT 'Smallest File', 'file_size_mb', format, ordinal, file_size_mb FROM metrics
  UNION ALL SELECT 'Lowest Energy', 'energy_wh', format, ordinal, energy_wh FROM metrics
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY title, metric ORDER BY value, ordinal, format) AS rn
  FROM stacked WHERE value IS NOT NULL AND NOT isnan(value)
)
SELECT title, metric, format, value FROM ranked WHERE rn = 1
""")
def q_best_per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.reports import best_per_metric
    return best_per_metric(format_metrics(load_table(spark, sf_dir, "lineitem")))


# Engine timings derived from lineitem: step = return flag, engine = line
# status, seconds = number of lines (integral, so sums are exact in any order).
def engine_timings(lineitem: DataFrame) -> DataFrame:
    return (lineitem.groupBy(F.col("l_returnflag").alias("step"),
                             F.col("l_linestatus").alias("engine"))
            .agg(F.count(F.lit(1)).cast("double").alias("seconds")))


_TIMINGS_SQL = """
timings AS (
  SELECT l_returnflag AS step, l_linestatus AS engine, CAST(COUNT(*) AS DOUBLE) AS seconds
  FROM lineitem GROUP BY 1, 2
)"""


@register("timing_compare", "WITH" + _TIMINGS_SQL + """,
wide AS (
  SELECT step, SUM(CASE WHEN engine = 'F' THEN seconds END) AS "F_s",
         SUM(CASE WHEN engine = 'O' THEN seconds END) AS "O_s"
  FROM timings GROUP BY step
)
SELECT step, "F_s", "O_s",
       CASE WHEN "F_s" IS NULL OR "O_s" IS NULL THEN NULL
            WHEN "F_s" < "O_s" THEN 'F' ELSE 'O' END AS faster
FROM wide
""")
def q_timing_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.reports import timing_compare
    return timing_compare(engine_timings(load_table(spark, sf_dir, "lineitem")), "F", "O")


@register("timing_totals", "WITH" + _TIMINGS_SQL + """
SELECT engine, SUM(seconds) AS total_seconds FROM timings GROUP BY engine
""")
def q_timing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.reports import step_totals
    return step_totals(engine_timings(load_table(spark, sf_dir, "lineitem")))


# ---------------------------------------------------------------- generators
# Draws are integer arithmetic that SQL can follow (cartwheel.functions.random), so the
# oracles compute every generated row.  The ``*_check`` queries reduce a table to
# invariants that must hold whatever the draws are (row counts, exactly-once
# draws, no orphan keys, value ranges).


def _pick_sql(key: str, seed: int, salt: str, values: list[str]) -> str:
    options = ", ".join(f"'{v}'" for v in values)
    return f"([{options}])[CAST({draw_sql(key, seed, salt)} % {len(values)} AS INT) + 1]"


def _range_sql(key: str, seed: int, salt: str, low: float, high: float) -> str:
    return f"(CAST({low} AS DOUBLE) + {uniform_sql(key, seed, salt)} * CAST({high - low} AS DOUBLE))"


def _days_sql(key: str, seed: int, salt: str, days: int) -> str:
    return f"DATE '{generate.DEFAULT_AS_OF}' - CAST({draw_sql(key, seed, salt)} % {days + 1} AS INTEGER)"


_GEN_CUSTOMERS_SQL = f"""
SELECT customer_id, first || ' ' || last AS name,
       lower(first) || '.' || lower(last) || customer_id || '@example.com' AS email,
       greatest(least(CAST(trunc(35 + 12 * sqrt(CAST(-2 AS DOUBLE) * ln(u1)) * cos(CAST({2 * math.pi!r} AS DOUBLE) * u2)) AS BIGINT),
                      95), 18) AS age, city, country, registration_date
FROM (SELECT customer_id, {_pick_sql('customer_id', 0, 'first', generate.FIRST_NAMES)} AS first,
             {_pick_sql('customer_id', 0, 'last', generate.LAST_NAMES)} AS last,
             {uniform_sql('customer_id', 0, 'age:bm1')} AS u1, {uniform_sql('customer_id', 0, 'age:bm2')} AS u2,
             {_pick_sql('customer_id', 0, 'city', generate.CITIES)} AS city,
             {_pick_sql('customer_id', 0, 'country', generate.COUNTRIES)} AS country,
             {_days_sql('customer_id', 0, 'registered', 1825)} AS registration_date
      FROM (SELECT c_custkey AS customer_id FROM customer))"""

_GEN_PRODUCTS_SQL = f"""
SELECT product_id, {_pick_sql('product_id', 0, 'adjective', generate.ADJECTIVES)} || ' '
           || {_pick_sql('product_id', 0, 'noun', generate.NOUNS)} AS name,
       {_pick_sql('product_id', 0, 'category', generate.CATEGORIES)} AS category,
       ROUND_EVEN({_range_sql('product_id', 0, 'price', 10.0, 500.0)}, 2) AS price,
       CAST({draw_sql('product_id', 0, 'stock')} % 1001 AS BIGINT) AS stock,
       ROUND_EVEN({_range_sql('product_id', 0, 'rating', 1.0, 5.0)}, 1) AS rating
FROM (SELECT p_partkey AS product_id FROM part)"""

# Owners of the orders' points on the line of the customers' Pareto weights.
_SAMPLE_SQL = f"""
WITH weights AS (
  SELECT customer_id, {draw_sql('customer_id', 0, 'chunk')} % 4096 AS chunk,
         CAST(floor(10000 * pow({uniform_sql('customer_id', 0, 'pareto')}, CAST({-1 / 1.16!r} AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT c_custkey AS customer_id FROM customer)
), line AS (
  SELECT customer_id, w, CAST(SUM(w) OVER (ORDER BY chunk, customer_id) AS BIGINT) AS hi FROM weights
), total AS (SELECT CAST(SUM(w) AS BIGINT) AS t FROM weights
), points AS (
  SELECT order_id, least(CAST(floor({uniform_sql('order_id', 0, 'weighted-draw')} * t) AS BIGINT), t - 1) AS p
  FROM (SELECT o_orderkey AS order_id FROM orders), total
), owners AS (SELECT order_id, customer_id FROM points JOIN line ON hi - w <= p AND p < hi)"""

_GEN_ORDERS_SQL = _SAMPLE_SQL + f""",
positions AS (
  SELECT p_partkey AS product_id, p_partkey - (SELECT MIN(p_partkey) FROM part) AS pos FROM part  -- keys have no gaps
), n AS (SELECT COUNT(*) AS n FROM part
), drawn AS (
  SELECT order_id, customer_id,
         least(CAST(floor({uniform_sql('order_id', 1, 'weighted-draw')} * n) AS BIGINT), n - 1) AS pos
  FROM owners, n
)
SELECT order_id, customer_id, product_id, CAST({draw_sql('order_id', 0, 'quantity')} % 10 + 1 AS BIGINT) AS quantity,
       {_days_sql('order_id', 0, 'ordered', 730)} AS order_date
FROM drawn JOIN positions USING (pos)"""

_GEN_FORMAT_SQL = f"""
SELECT id, {_pick_sql('id', 42, 'name', generate.FORMAT_TABLE_NAMES)} AS name,
       'user' || (id - 1) || '@example.com' AS email, {_range_sql('id', 42, 'amount', 10.0, 10000.0)} AS amount,
       TIMESTAMP '2025-01-01 12:00:00' - to_days(CAST({draw_sql('id', 42, 'days')} % 365 AS INTEGER)) AS date,
       {_pick_sql('id', 42, 'category', generate.FORMAT_TABLE_CATEGORIES)} AS category
FROM (SELECT event_id + 1 AS id FROM events)"""


def _customer_ids(spark, sf_dir):
    return load_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))


def _product_ids(spark, sf_dir):
    return load_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"))


def _order_ids(spark, sf_dir):
    return load_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))


@register("generate_customers", _GEN_CUSTOMERS_SQL)
def q_generate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.generate import customers_from_ids
    return customers_from_ids(_customer_ids(spark, sf_dir))


@register("generate_products", _GEN_PRODUCTS_SQL)
def q_generate_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.generate import products_from_ids
    return products_from_ids(_product_ids(spark, sf_dir))


@register("uniform_sparse", f"""
WITH positions AS (
  SELECT product_id, row_number() OVER (ORDER BY {draw_sql('product_id', 0, 'chunk')} % 4096, product_id) - 1 AS pos
  FROM (SELECT p_partkey * 3 + 1 AS product_id FROM part)
), n AS (SELECT COUNT(*) AS n FROM part
), drawn AS (
  SELECT o_orderkey AS order_id,
         least(CAST(floor({uniform_sql('o_orderkey', 5, 'weighted-draw')} * n) AS BIGINT), n - 1) AS pos
  FROM orders, n
)
SELECT order_id, product_id FROM drawn JOIN positions USING (pos)
""")
def q_uniform_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform draw of a product for each order, from keys with gaps."""
    from cartwheel.operators.sampling import uniform_sample
    sparse = _product_ids(spark, sf_dir).select((F.col("product_id") * 3 + 1).alias("product_id"))
    return uniform_sample(_order_ids(spark, sf_dir), "order_id", sparse, "product_id", seed=5, unique_keys=True)


@register("generate_orders", _GEN_ORDERS_SQL)
def q_generate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.generate import orders_from_ids
    # c_custkey and p_partkey are the tables' primary keys
    return orders_from_ids(_order_ids(spark, sf_dir), _customer_ids(spark, sf_dir),
                           _product_ids(spark, sf_dir), unique_keys=True)


@register("generate_format_table", _GEN_FORMAT_SQL)
def q_generate_format_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.generate import format_table_from_ids
    ids = load_table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("id"))
    # without a zone, as the tables' own timestamps
    return format_table_from_ids(ids).withColumn("date", F.col("date").cast("timestamp_ntz"))


@register("weighted_sample", _SAMPLE_SQL + " SELECT order_id, customer_id FROM owners")
def q_weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.sampling import pareto_weights, weighted_sample
    return weighted_sample(_order_ids(spark, sf_dir), "order_id",
                           pareto_weights(_customer_ids(spark, sf_dir), "customer_id"),
                           "customer_id", unique_keys=True)  # c_custkey is the primary key


@register("weighted_owner", """
WITH w AS (SELECT c_custkey AS customer_id, c_acctbal AS x FROM customer WHERE c_acctbal > 0),
bits AS (SELECT 61 - ceil(log2(count(*) * max(x))) AS e FROM w),
whole AS (SELECT customer_id, greatest(CAST(floor(x * power(CAST(2 AS DOUBLE), e)) AS BIGINT), 1) AS n FROM w, bits),
line AS (SELECT customer_id, n, CAST(SUM(n) OVER (ORDER BY customer_id % 64, customer_id) AS BIGINT) AS hi FROM whole),
points AS (SELECT o_orderkey AS order_id, CAST(floor((o_orderkey * 48271 % 100003) / CAST(100003 AS DOUBLE)
               * (SELECT CAST(SUM(n) AS BIGINT) FROM whole)) AS BIGINT) AS p FROM orders)
SELECT order_id, customer_id FROM points JOIN line ON hi - n <= p AND p < hi
""")
def q_weighted_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner of a point of each order on the line of the customers' real-valued balances."""
    from cartwheel.operators.sampling import weighted_sample
    customers = load_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("weight"))
    return weighted_sample(_order_ids(spark, sf_dir), "order_id", customers, "customer_id", chunks=64,
                           draw=(F.col("order_id") * 48271 % 100003) / F.lit(100003.0),
                           spread=F.col("customer_id"), unique_keys=True).select("order_id", "customer_id")


@register("weighted_sample_check", """
SELECT CAST(COUNT(*) AS BIGINT) AS draws,
       CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) AS distinct_draws,
       CAST(0 AS BIGINT) AS orphan_draws
FROM orders
""")
def q_weighted_sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = q_weighted_sample(spark, sf_dir)
    known = _customer_ids(spark, sf_dir).withColumn("_known", F.lit(1))
    # customer keys are unique, so the left join keeps one row per draw
    return (sample.join(known, "customer_id", "left")
            .agg(F.count(F.lit(1)).alias("draws"),
                 F.count_distinct("order_id").alias("distinct_draws"),
                 F.count_if(F.col("_known").isNull()).alias("orphan_draws")))


@register("generate_orders_check", """
SELECT CAST(COUNT(*) AS BIGINT) AS order_rows,
       CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) AS distinct_orders,
       CAST(COUNT(*) AS BIGINT) AS known_customers,
       CAST(COUNT(*) AS BIGINT) AS known_products,
       CAST(COUNT(*) AS BIGINT) AS in_range
FROM orders
""")
def q_generate_orders_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.generate import DEFAULT_AS_OF
    gen = q_generate_orders(spark, sf_dir)
    known_c = _customer_ids(spark, sf_dir).withColumn("_known_c", F.lit(1))
    known_p = _product_ids(spark, sf_dir).withColumn("_known_p", F.lit(1))
    window_start = F.date_sub(F.lit(DEFAULT_AS_OF), 730)
    in_range = (F.col("quantity").between(1, 10)
                & F.col("order_date").between(window_start, F.lit(DEFAULT_AS_OF)))
    # keys are unique in customer and part: the left joins keep one row per order
    return (gen.join(known_c, "customer_id", "left").join(known_p, "product_id", "left")
            .agg(F.count(F.lit(1)).alias("order_rows"),
                 F.count_distinct("order_id").alias("distinct_orders"),
                 F.count("_known_c").alias("known_customers"),
                 F.count("_known_p").alias("known_products"),
                 F.count_if(in_range).alias("in_range")))


@register("generate_customers_check", """
SELECT CAST(COUNT(*) AS BIGINT) AS customer_rows,
       CAST(COUNT(DISTINCT c_custkey) AS BIGINT) AS distinct_customers,
       CAST(COUNT(*) AS BIGINT) AS in_range
FROM customer
""")
def q_generate_customers_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.operators.generate import DEFAULT_AS_OF
    gen = q_generate_customers(spark, sf_dir)
    in_range = (F.col("age").between(18, 95)
                & F.col("registration_date").between(F.date_sub(F.lit(DEFAULT_AS_OF), 1825),
                                                     F.lit(DEFAULT_AS_OF)))
    return gen.agg(F.count(F.lit(1)).alias("customer_rows"),
                   F.count_distinct("customer_id").alias("distinct_customers"),
                   F.count_if(in_range).alias("in_range"))


@register("generate_products_check", """
SELECT CAST(COUNT(*) AS BIGINT) AS product_rows,
       CAST(COUNT(DISTINCT p_partkey) AS BIGINT) AS distinct_products,
       CAST(5 AS BIGINT) AS categories,
       CAST(COUNT(*) AS BIGINT) AS in_range
FROM part
""")
def q_generate_products_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    gen = q_generate_products(spark, sf_dir)
    in_range = (F.col("price").between(10, 500) & F.col("stock").between(0, 1000)
                & F.col("rating").between(1, 5)
                & (F.bround("price", 2) == F.col("price")))
    return gen.agg(F.count(F.lit(1)).alias("product_rows"),
                   F.count_distinct("product_id").alias("distinct_products"),
                   F.count_distinct("category").alias("categories"),
                   F.count_if(in_range).alias("in_range"))


# ---------------------------------------------------------------- format benchmark
# Timings are wall clock, so only the row count is checked (no oracle).


@register("format_benchmark")
def q_format_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.plans.format_benchmark import benchmark_formats
    from cartwheel.session import scratch_path
    return benchmark_formats(load_table(spark, sf_dir, "events"),
                             scratch_path(spark, "format-benchmark"))


# A format that cannot be written is dropped by the benchmark and marked here.
@register("format_fidelity", """
SELECT 'CSV' AS format, CAST(0 AS BIGINT) AS ordinal, COUNT(*) AS rows_back,
       CAST(0 AS BIGINT) AS rows_differing, FALSE AS failed FROM events
UNION ALL SELECT 'xlsx', 1, NULL, NULL, TRUE
UNION ALL SELECT 'Parquet', 2, COUNT(*), 0, FALSE FROM events
UNION ALL SELECT 'ORC', 3, COUNT(*), 0, FALSE FROM events
""")
def q_format_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartwheel.plans.format_benchmark import format_fidelity
    from cartwheel.session import scratch_path
    return format_fidelity(load_table(spark, sf_dir, "events"), scratch_path(spark, "format-fidelity"),
                           ("csv", "xlsx", "parquet", "orc"))


@register("format_benchmark_measured", """
SELECT * FROM (VALUES ('CSV', CAST(0 AS BIGINT)), ('Parquet', 2), ('ORC', 3)) t(format, ordinal)
""")
def q_format_benchmark_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The formats that the benchmark measures of four asked for, one of which fails."""
    from cartwheel.plans.format_benchmark import benchmark_formats
    from cartwheel.session import scratch_path
    found = benchmark_formats(load_table(spark, sf_dir, "customer"), scratch_path(spark, "format-benchmark"),
                              ("csv", "xlsx", "parquet", "orc"))
    return found.where("file_size_mb > 0 AND write_time_s > 0 AND read_time_s > 0") \
                .select("format", F.col("ordinal").cast("bigint").alias("ordinal"))


@register("generate_format_table_check", """
SELECT CAST(COUNT(*) AS BIGINT) AS format_rows,
       CAST(COUNT(DISTINCT event_id) AS BIGINT) AS distinct_ids,
       CAST(8 AS BIGINT) AS names,
       CAST(5 AS BIGINT) AS categories,
       CAST(COUNT(*) AS BIGINT) AS in_range
FROM events
""")
def q_generate_format_table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime as dt
    gen = q_generate_format_table(spark, sf_dir)
    as_of = dt.datetime(2025, 1, 1, 12, 0, 0)
    in_range = (F.col("amount").between(10.0, 10000.0) & (F.col("amount") < 10000.0)
                & F.col("date").between(F.lit(as_of - dt.timedelta(days=364)), F.lit(as_of))
                & (F.col("email") == F.concat(F.lit("user"), (F.col("id") - 1).cast("string"),
                                              F.lit("@example.com"))))
    return gen.agg(F.count(F.lit(1)).alias("format_rows"),
                   F.count_distinct("id").alias("distinct_ids"),
                   F.count_distinct("name").alias("names"),
                   F.count_distinct("category").alias("categories"),
                   F.count_if(in_range).alias("in_range"))
