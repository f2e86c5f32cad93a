"""Reports over metric tables and dataset inventories.

All operators take metric *tables* (DataFrames) and return DataFrames; where
the numbers come from (clocks, allocators, CPU counters) is the caller's
business.  Metric tables hold one row per format or step, so their size is
bounded by the number of formats, not by the data volume.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.money import energy_wh, savings_percentage
from cartwheel.sources.io import format_file_size

# The savings columns the file-format report derives, and the
# metric each one is computed from.
SAVINGS_COLUMNS = (
    ("size_savings_%", "file_size_mb"),
    ("write_time_savings_%", "write_time_s"),
    ("read_time_savings_%", "read_time_s"),
    ("energy_savings_%", "energy_wh"),
)

# The "best of" lines of the file-format report, in report order.
BEST_OF_METRICS = (
    ("Fastest Write", "write_time_s"),
    ("Fastest Read", "read_time_s"),
    ("Smallest File", "file_size_mb"),
    ("Lowest Energy", "energy_wh"),
)


def dataset_summary(tables: dict[str, DataFrame],
                    paths: dict[str, str] | None = None) -> DataFrame:
    """One row per dataset: (dataset, record_count[, size_mb]).

    Each count is a global aggregate (parquet answers it from footers when no
    column is read); the union runs them as one job.  With ``paths``, the
    stored size of each dataset's files is added as ``'x.xx MB'`` (or
    ``'Unknown'``), read from file metadata only.
    """
    if not tables:
        raise ValueError("no datasets")
    rows = []
    for name, df in tables.items():
        row = (df.agg(F.count(F.lit(1)).alias("record_count"))
               .select(F.lit(name).alias("dataset"), "record_count"))
        if paths is not None:
            size = format_file_size(df.sparkSession, paths[name]) if name in paths else "Unknown"
            row = row.withColumn("size_mb", F.lit(size))
        rows.append(row)
    return reduce(DataFrame.unionAll, rows)


def energy_and_peak(phases: DataFrame, tdp_watts: float = 65.0) -> DataFrame:
    """Derive cpu_time_s, peak_memory_mb and energy_wh from per-phase metrics.

    cpu time is write + read; peak memory is the larger of the two phases;
    energy is cpu time at ``tdp_watts`` in watt-hours.
    """
    cpu = F.col("write_cpu_s") + F.col("read_cpu_s")
    return (phases
            .withColumn("cpu_time_s", cpu)
            .withColumn("peak_memory_mb", F.greatest("write_peak_mb", "read_peak_mb"))
            .withColumn("energy_wh", energy_wh(cpu, tdp_watts)))


def savings_vs_baseline(metrics: DataFrame, baseline: str = "CSV",
                        include_baseline: bool = False,
                        label_col: str = "format", order_col: str = "ordinal") -> DataFrame:
    """Percentage savings of every format against the baseline format.

    Adds the four ``*_savings_%`` columns, rounded half-to-even to 2 places.
    The baseline is the first row (lowest ``order_col``) with that label,
    read as one struct-valued scalar subquery (no join is planned).  When
    the baseline is missing or its metric is 0 the savings are NULL.
    """
    base = (metrics.where(F.col(label_col) == F.lit(baseline))
            .agg(F.min_by(F.struct(*[m for _, m in SAVINGS_COLUMNS]), order_col))
            .scalar())
    out = metrics
    for name, metric in SAVINGS_COLUMNS:
        out = out.withColumn(name, savings_percentage(base.getField(metric), metric))
    if not include_baseline:
        out = out.where(~F.col(label_col).eqNullSafe(F.lit(baseline)))
    return out


def best_per_metric(metrics: DataFrame, label_col: str = "format",
                    order_col: str = "ordinal",
                    metrics_spec: tuple[tuple[str, str], ...] = BEST_OF_METRICS) -> DataFrame:
    """For each metric, the row holding its smallest value.

    Columns: title, metric, format, value.  NULL and NaN values are skipped (a
    metric without others keeps its row, with NULL format and value);
    equal minima go to the row that comes first in ``order_col``.  One pass:
    the metric columns are unpivoted, then a single grouped ``min`` of
    (value, order, label) per metric.
    """
    names = [m for _, m in metrics_spec]
    titles = F.create_map(*[F.lit(x) for pair in metrics_spec for x in (pair[1], pair[0])])
    stacked = (metrics
               .select(F.col(label_col).alias("_label"), F.col(order_col).alias("_ord"),
                       *[F.col(m).cast("double").alias(m) for m in names])
               .unpivot(["_label", "_ord"], names, "metric", "_value"))
    valid = F.when(F.col("_value").isNotNull() & ~F.isnan("_value"),
                   F.struct("_value", "_ord", "_label"))
    best = stacked.groupBy("metric").agg(F.min(valid).alias("_best"))
    return best.select(titles[F.col("metric")].alias("title"), "metric",
                       F.col("_best._label").alias(label_col),
                       F.col("_best._value").alias("value"))


def timing_compare(timings: DataFrame, engine_a: str, engine_b: str,
                   label_a: str | None = None, label_b: str | None = None) -> DataFrame:
    """Per step, the two engines' seconds side by side and the faster one.

    ``timings`` is long: (step, engine, seconds).  The winner is ``label_a``
    only when engine a is strictly faster, so a tie goes to engine b.  A step
    missing for either engine has no winner.  Columns: step,
    ``<engine_a>_s``, ``<engine_b>_s``, faster.
    """
    label_a = label_a or engine_a
    label_b = label_b or engine_b
    a_col, b_col = f"{engine_a}_s", f"{engine_b}_s"
    wide = (timings.groupBy("step")
            .pivot("engine", [engine_a, engine_b])
            .agg(F.sum("seconds"))
            .withColumnRenamed(engine_a, a_col)
            .withColumnRenamed(engine_b, b_col))
    a, b = F.col(a_col), F.col(b_col)
    faster = (F.when(a.isNull() | b.isNull(), F.lit(None).cast("string"))
              .when(a < b, F.lit(label_a))
              .otherwise(F.lit(label_b)))
    return wide.withColumn("faster", faster)


def step_totals(timings: DataFrame, steps: list[str] | None = None) -> DataFrame:
    """Sum of step times per engine: (engine, total_seconds).

    ``steps`` restricts the sum to the named steps, e.g. the load steps for a
    load total and the analysis steps for an analysis total.
    """
    if steps is not None:
        timings = timings.where(F.col("step").isin(list(steps)))
    return timings.groupBy("engine").agg(F.sum("seconds").alias("total_seconds"))
