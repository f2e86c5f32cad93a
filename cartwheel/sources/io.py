"""Table sinks and scans per storage format, format round trips, stored size.

Formats: Parquet and ORC (columnar) and CSV (row text).  Text reads always
pass the declared schema (no inference).  CSV timestamps are written and read
with explicit microsecond patterns: Spark's default CSV patterns keep
milliseconds only, which silently changes most timestamps on a round trip.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.money import megabytes_label

FORMATS = ("parquet", "csv", "orc")

# How CSV writes NULL, and the escapes of text.  Every text keeps to its
# line, so a file can be cut at any line and read by many tasks.  A backslash is doubled,
# so no text looks like NULL; blanks get a mark in front, as blank lines are not read.
NULL_MARK = "\\N"
LINE_ESCAPES = (("\n", "\\n"), ("\r", "\\r"))
BLANK_MARK = "\\e"

# CSV layout and timestamp patterns with microseconds.
CSV_OPTIONS = {
    "header": "true",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # NULL and the empty string are told apart, and a row of NULLs is no blank line
    "nullValue": NULL_MARK,
}
CSV_FILE_RECORDS = 10_000_000  # rows of a file at most
CSV_READ_OPTIONS = {**CSV_OPTIONS, "emptyValue": ""}

_CSV_TYPES = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType)


def _check_format(fmt: str) -> str:
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {FORMATS}")
    return fmt


def _to_line(text: Column) -> Column:
    """Text without line breaks, undone by :func:`_from_line`."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, escape in LINE_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escape))
    return F.when(text.rlike(r"^[\x00-\x20]+$"), F.concat(F.lit(BLANK_MARK), out)).otherwise(out)


def _from_line(text: Column) -> Column:
    """Pairs of backslashes are cut out first, as what follows one is no escape."""
    def piece(x: Column) -> Column:
        x = F.replace(x, F.lit(BLANK_MARK), F.lit(""))
        for plain, escape in LINE_ESCAPES:
            x = F.replace(x, F.lit(escape), F.lit(plain))
        return x

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")
    return F.when(F.contains(text, F.lit("\\")), whole).otherwise(text)


def _text_columns(df: DataFrame, change) -> DataFrame:
    return df.select([change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                      else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write ``df`` to ``path`` in ``fmt``: one file per task, no index column."""
    fmt = _check_format(fmt)
    if fmt == "csv":
        bad = [f.name for f in df.schema.fields if not isinstance(f.dataType, _CSV_TYPES)]
        if bad:
            raise ValueError(f"CSV cannot hold nested columns {bad}")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        df = _text_columns(df, _to_line)
        writer = df.write.mode(mode).format(fmt).options(**CSV_OPTIONS) \
                   .option("maxRecordsPerFile", CSV_FILE_RECORDS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by :func:`write_table`.  CSV requires a schema."""
    fmt = _check_format(fmt)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV reads need a declared schema")
        reader = reader.options(**CSV_READ_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if fmt == "csv":
        df = _text_columns(df, _from_line)
    return df


def roundtrip(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """Write ``df`` in ``fmt`` to ``path`` and return the table read back.

    The write is an action (it runs when this is called); the returned frame
    is a lazy scan of the written files, so it can be compared with ``df``.
    """
    write_table(df, path, fmt)
    return read_table(df.sparkSession, path, fmt, schema=df.schema)


def stored_size(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Stored size of a file or directory of files.

    Columns: files, size_bytes, size_mb (``'x.xx MB'``).  Only file metadata
    is read (the ``content`` column is never selected).  ``glob`` restricts
    the files counted, e.g. ``'part-*'`` to skip commit markers.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("length")
    return (files.agg(F.count(F.lit(1)).alias("files"),
                      F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
            .withColumn("size_mb", megabytes_label("size_bytes")))


def format_file_size(spark: SparkSession, path: str, glob: str | None = "part-*") -> str:
    """Stored size of ``path`` as ``'x.xx MB'``, or ``'Unknown'`` if there is no such path."""
    try:
        return stored_size(spark, path, glob=glob).first()["size_mb"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return "Unknown"
