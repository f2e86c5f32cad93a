"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import shared_path
from cartwheel.sources.tables import table_path

# A word is a run of characters outside space and U+0009..U+000D.  On UTF-8
# bytes this is what ``bytes.split()`` yields, and ``bytes.lower()`` changes
# A-Z alone, so Python-side operators work on bytes.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a table of the data folder; its files are listed at each call."""
    return spark.read.parquet(table_path(sf_dir, name))


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a table in the shared checkpoint folder and read it back.

    The lineage is cut: the files survive the loss of an executor, and the
    planner sees their true size (a checkpointed frame keeps the estimate of the
    plan it came from, which multiplies from join to join in a loop).  The folder
    is deleted when the application ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, "staged")
    df.write.parquet(path, compression=compression)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns, *names: str) -> list[str]:
    """Column names derived from ``names`` that clash with none of ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def raw_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text column; null becomes empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit("")).cast("binary")


def running_sum(values: Column, block: int = 256) -> Column:
    """Inclusive running sums of an array<bigint> column, inside the row.

    Two levels: sums within blocks of ``block`` and offsets of the blocks, so
    an array of m values costs about m * (block + m / block**2) additions.
    """
    n = F.size(values)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(block))) \
              .otherwise(F.array().cast("array<int>"))
    add = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    blocks = F.transform(starts, lambda s: F.slice(values, s, block))
    sums = F.transform(blocks, add)
    offsets = F.transform(sums, lambda _, i: add(F.slice(sums, F.lit(1), i)))
    within = F.transform(F.arrays_zip(blocks.alias("b"), offsets.alias("o")), lambda z: F.transform(
        z["b"], lambda _, i: z["o"] + add(F.slice(z["b"], F.lit(1), i + 1))))
    return F.flatten(within)


def once(array: str, result: Column) -> Column:
    """``result``, which names the column ``array`` inside a function over another array.

    A column that is named a single time is merged into the expression that names it, and would
    be evaluated for each element.  This names it twice.
    """
    return F.when(F.size(array) >= 0, result)


def with_running_sums(df: DataFrame, names: dict[str, str], block: int = 256) -> DataFrame:
    """``df`` with inclusive running sums of array<bigint> columns, inside the row.

    Two levels: sums within blocks of ``block`` and offsets of the blocks, so an array of m values
    costs about m * (block + m / block**2) additions.  ``names`` maps arrays to their sums.
    """
    add = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    steps = [fresh([*df.columns, *names.values()], *[f"{x}_{n}" for n in names]) for x in ("blocks", "sums", "offsets")]
    blocks, sums, offsets = steps
    put = lambda columns: df.select("*", *[e.alias(n) for n, e in columns.items()])
    starts = lambda n: F.when(F.size(n) > 0, F.sequence(F.lit(1), F.greatest(F.size(n), F.lit(1)), F.lit(block)))
    cut = lambda n: F.transform(starts(n), lambda s: F.slice(F.col(n), s, block))
    before = lambda s: F.transform(s, lambda _, i: add(F.slice(F.col(s), F.lit(1), i)))
    within = lambda b, o: once(o, F.flatten(F.transform(b, lambda values, i: F.transform(
        values, lambda _, j: F.get(F.col(o), i) + add(F.slice(values, F.lit(1), j + 1))))))
    df = put({b: F.coalesce(cut(n), F.array().cast("array<array<bigint>>")) for b, n in zip(blocks, names)})
    df = put({s: F.transform(b, add) for s, b in zip(sums, blocks)})
    df = put({o: before(s) for o, s in zip(offsets, sums)})
    df = put({out: within(b, o) for out, b, o in zip(names.values(), blocks, offsets)})
    return df.drop(*blocks, *sums, *offsets)
