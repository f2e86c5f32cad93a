"""Money and ratio expressions (built-in Column expressions only).

Revenue is exact and nothing is rounded away.  A line's value is held in one
of three parts: whole cents (64-bit, where quantity is whole and the price is
whole cents), a decimal with 14 places (where both are decimals of 6 and 8
places at most), or the double product (anything else, non-finite values
included, which then behave as doubles do).  Parts are summed apart and
converted to double once, after the sum, so the first two do not depend on row
order or partition layout.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_DECIMAL = "decimal(18,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_price(price: str | Column) -> Column:
    """A price as an exact two-decimal value (half-up to the cent)."""
    return _col(price).cast(PRICE_DECIMAL)


def price_cents(price: str | Column) -> Column:
    """A price in whole cents (bigint): the exact two-decimal price times 100.

    Computed on the product side of a join (one row per product), so the
    decimal work is paid per product, not per order line.
    """
    return (exact_price(price) * F.lit(100)).cast("bigint")


def line_cents(quantity: str | Column, cents: str | Column) -> Column:
    """quantity * price in cents: a 64-bit integer multiply per line.

    Overflow (beyond 9.2e18 cents on one line) raises under ANSI mode.
    """
    return _col(quantity).cast("bigint") * _col(cents)


# Sums of cents run as two 64-bit sums, of c // SPLIT and of the remainder,
# instead of one decimal sum: long buffers stay on Spark's fast aggregation
# path, and the pair is exact with no overflow below ~9e12 lines per group.
SPLIT = 1_000_000


def sum_cents(cents: str | Column, name: str) -> list[Column]:
    """Aggregate columns ``{name}_hi`` and ``{name}_lo`` for an exact cent sum.

    ``hi`` may be rounded either way (it comes from a double division); the
    remainder is computed from it exactly in 64-bit integers, so
    ``hi * SPLIT + lo`` is always exactly the line value.
    """
    c = _col(cents)
    hi = F.floor(c / F.lit(float(SPLIT))).cast("bigint")
    lo = c - hi * F.lit(SPLIT).cast("bigint")
    return [F.sum(hi).alias(f"{name}_hi"), F.sum(lo).alias(f"{name}_lo")]


def summed_cents(name: str) -> Column:
    """The exact total of a :func:`sum_cents` pair, as decimal(38,0)."""
    hi = F.col(f"{name}_hi").cast("decimal(38,0)")
    lo = F.col(f"{name}_lo").cast("decimal(38,0)")
    return (hi * F.lit(SPLIT) + lo).cast("decimal(38,0)")


def cents_to_money(total_cents: str | Column) -> Column:
    """An exact cent total -> double, rounded once (decimal division by 100)."""
    return (_col(total_cents).cast("decimal(38,0)") / F.lit(100)).cast("double")


def line_cents_to_money(cents: str | Column) -> Column:
    """One line's cents -> double.

    Exact below 2^53 cents (9e13 currency units per line), so it equals the
    decimal conversion without a per-row decimal division.
    """
    return _col(cents).cast("double") / F.lit(100.0)


# Largest whole quantity and price in cents whose product surely fits 64 bits;
# larger ones take the decimal part.
MAX_QUANTITY, MAX_CENTS = 1_000_000, 1_000_000_000_000
QUANTITY_DECIMAL, EXACT_DECIMAL = "decimal(17,6)", "decimal(20,8)"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, _INTEGRAL)


def _exact_decimal(c: Column, kind: str) -> Column:
    """``c`` as a decimal, NULL unless the decimal is equal to it."""
    d = c.try_cast(kind)
    return F.when(d.cast("double") == c.cast("double"), d)


def whole_quantity(quantity: str | Column, dtype: T.DataType) -> Column:
    """The quantity as bigint where it is whole and at most MAX_QUANTITY, else NULL."""
    q = _col(quantity)
    fits = F.abs(q.cast("double")) <= MAX_QUANTITY
    whole = fits if is_integral(dtype) else fits & (q == F.floor(q.cast("double")))
    return F.when(whole, q.cast("bigint"))


def exact_cents(price: str | Column) -> Column:
    """The price in cents (bigint) where it is whole cents and at most MAX_CENTS, else NULL."""
    d = _col(price).try_cast(PRICE_DECIMAL)
    cents = (d * F.lit(100)).try_cast("bigint")
    same = d.cast("double") == _col(price).cast("double")
    return F.when(same & (F.abs(cents) <= MAX_CENTS), cents)


def exact_price_decimal(price: str | Column) -> Column:
    """The price with up to 8 decimals, NULL unless that is exact."""
    return _exact_decimal(_col(price), EXACT_DECIMAL)


def with_line_parts(df: DataFrame, quantity: str, price: str, cents: str, decimal: str,
                    parts: dict[str, str]) -> DataFrame:
    """``df`` with parts c, d, f of quantity * price; exactly one is set unless a factor is NULL.

    Each part is a column that the next ones name: as one expression they would hold
    the first part a dozen times.
    """
    c, d, f = (parts[k] for k in "cdf")
    whole = f"{c}_whole"
    df = df.withColumn(whole, whole_quantity(quantity, df.schema[quantity].dataType))
    df = df.withColumn(c, F.col(whole) * F.col(cents)).drop(whole)
    df = df.withColumn(d, F.when(F.col(c).isNull(), _exact_decimal(F.col(quantity), QUANTITY_DECIMAL) * F.col(decimal)))
    return df.withColumn(f, F.when(F.col(c).isNull() & F.col(d).isNull(),
                                   F.col(quantity).cast("double") * F.col(price).cast("double")))


def sum_parts(parts: dict[str, str | Column], name: str) -> list[Column]:
    """Aggregate columns of a value in parts: exact sums of c and d, a double sum of f."""
    return [*sum_cents(parts["c"], name), F.sum(_col(parts["d"])).alias(f"{name}_d"),
            F.sum(_col(parts["f"])).alias(f"{name}_f")]


def summed_parts(name: str) -> Column:
    """The total of :func:`sum_parts` as double, rounded once; NULL without values."""
    c, d, f = summed_cents(name), F.col(f"{name}_d"), F.col(f"{name}_f")
    zero = F.lit(Decimal(0))
    exact = (F.coalesce(c.try_cast("decimal(20,0)"), zero) * F.lit(Decimal("0.01"))
             + F.coalesce(d.try_cast("decimal(34,14)"), zero)).cast("double")
    fits = (c.isNull() | c.try_cast("decimal(20,0)").isNotNull()) \
        & (d.isNull() | d.try_cast("decimal(34,14)").isNotNull())
    wide = F.coalesce(cents_to_money(c), F.lit(0.0)) + F.coalesce(d.cast("double"), F.lit(0.0))
    return F.when(d.isNull() & f.isNull(), cents_to_money(c)).otherwise(
        F.when(fits, exact).otherwise(wide) + F.coalesce(f, F.lit(0.0)))


# Sums taken below a join: a product's units are summed first and multiplied once.
UNITS_DECIMAL, MILLION = "decimal(28,6)", 1_000_000


def with_unit_parts(df: DataFrame, quantity: str, name: str) -> DataFrame:
    """``df`` with a quantity in parts: whole units (bigint), decimals and doubles."""
    w, d, f = (f"{name}_{k}" for k in "wdf")
    df = df.withColumn(w, whole_quantity(quantity, df.schema[quantity].dataType))
    df = df.withColumn(d, F.when(F.col(w).isNull(), _exact_decimal(F.col(quantity), QUANTITY_DECIMAL)))
    return df.withColumn(f, F.when(F.col(w).isNull() & F.col(d).isNull(), F.col(quantity).cast("double")))


def unit_sums(name: str) -> list[Column]:
    """Aggregate columns of the parts of :func:`with_unit_parts`, under their names."""
    return [F.sum(f"{name}_{k}").alias(f"{name}_{k}") for k in "wdf"]


def unit_parts(name: str) -> dict[str, Column]:
    """Parts c, d, f of the units of :func:`unit_sums`, as :func:`sum_parts` takes them."""
    return {"c": F.col(f"{name}_w") * 100, "d": F.col(f"{name}_d"), "f": F.col(f"{name}_f")}


def with_product_parts(df: DataFrame, price: str, cents: str, decimal: str,
                       products: dict[str, dict[str, str]]) -> DataFrame:
    """``df`` with parts c, d, f of sums of units times the row's price.

    ``products`` maps the name of the units, ``{name}_w`` and, unless there are whole units only,
    ``{name}_d`` and ``{name}_f`` (see :func:`unit_sums`), to the names of the parts.  Equal to the
    sum of the products of the lines in c and d.  What does not fit 38 digits (or is no decimal) is
    multiplied as doubles.

    c is a 64-bit product.  For d, units of 28 digits (6 of them places) are multiplied in millions
    and the rest apart, as one product with a price of 20 digits would be rounded.
    """
    zero, col = F.lit(Decimal(0)).cast(UNITS_DECIMAL), F.col
    wide = lambda c: F.coalesce(c.try_cast(UNITS_DECIMAL), zero)
    part = lambda n, k: col(f"{n}_{k}") if f"{n}_{k}" in df.columns else F.lit(None).cast("double")
    each = lambda make: {k: v for n, parts in products.items() for k, v in make(n, parts).items()}
    some = lambda n: col(f"{n}_left").isNotNull() | part(n, "d").isNotNull()

    def exact(n: str) -> Column:
        m = col(f"{n}_millions")
        rest = (col(f"{n}_units") - m * MILLION).try_cast("decimal(13,6)")
        high = (m * col(decimal)).try_cast("decimal(30,8)") * F.lit(MILLION).cast("decimal(7,0)")
        return (high.try_cast("decimal(37,14)") + rest * col(decimal)).try_cast("decimal(38,14)")  # 38 digits

    def doubles(n: str, parts: dict[str, str]) -> Column:
        left = F.when(col(parts["d"]).isNull() & some(n), F.coalesce(col(f"{n}_left").cast("double"), F.lit(0.0))
                      + F.coalesce(part(n, "d").cast("double"), F.lit(0.0)))
        return F.coalesce(left + part(n, "f"), left, part(n, "f")) * col(price).cast("double")

    # each step is a column that the next ones name
    out = df.withColumns(each(lambda n, parts: {parts["c"]: F.when(
        F.abs(col(f"{n}_w").cast("double")) * F.abs(col(cents)) < 9e18, col(f"{n}_w") * col(cents))}))
    out = out.withColumns(each(lambda n, parts: {f"{n}_left": F.when(col(parts["c"]).isNull(), col(f"{n}_w"))}))
    out = out.withColumns(each(lambda n, parts: {f"{n}_units": F.when(
        some(n), (wide(col(f"{n}_left")) + wide(part(n, "d"))).try_cast(UNITS_DECIMAL))}))
    out = out.withColumns(each(lambda n, parts: {f"{n}_millions": F.floor(
        col(f"{n}_units") / MILLION).try_cast("decimal(17,0)")}))
    out = out.withColumns(each(lambda n, parts: {parts["d"]: exact(n)}))
    return out.withColumns(each(lambda n, parts: {parts["f"]: doubles(n, parts)}))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, NULL when the denominator is NULL or zero.

    Spark 4 runs with ANSI mode on, where ``x / 0`` raises; ``try_divide``
    keeps the non-ANSI result (NULL) the analytics were written against.
    """
    return F.try_divide(_col(numerator), _col(denominator))


def growth_percentage(current: str | Column, previous: str | Column) -> Column:
    """(current - previous) / previous * 100; NULL when previous is NULL or 0."""
    return ratio(_col(current) - _col(previous), _col(previous)) * F.lit(100)


def round_half_even(x: str | Column, digits: int = 2) -> Column:
    """Round half-to-even like NumPy: a negative value rounding to zero stays -0.0.

    ``bround`` works on decimals, which have no negative zero.
    """
    x = _col(x)
    r = F.bround(x, digits)
    return F.when((r == F.lit(0.0)) & (x < F.lit(0.0)), F.lit(-0.0)).otherwise(r)


def savings_percentage(baseline: str | Column, value: str | Column, digits: int = 2) -> Column:
    """(baseline - value) / baseline * 100, rounded half-to-even."""
    return round_half_even(ratio(_col(baseline) - _col(value), _col(baseline)) * F.lit(100),
                           digits)


def energy_wh(cpu_seconds: str | Column, tdp_watts: float = 65.0) -> Column:
    """Energy estimate: CPU seconds at a fixed power draw, in watt-hours."""
    return _col(cpu_seconds) * F.lit(float(tdp_watts)) / F.lit(3600.0)


def megabytes_label(num_bytes: str | Column) -> Column:
    """Bytes as a ``'x.xx MB'`` label (MB = 1024 * 1024 bytes)."""
    return F.format_string("%.2f MB", _col(num_bytes) / F.lit(1024.0 * 1024.0))
