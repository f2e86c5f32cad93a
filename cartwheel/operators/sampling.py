"""Weighted sampling with replacement as a Spark job.

Each draw picks one item with probability proportional to the item's weight.
Everything is keyed by hashes, so the result does not depend on the
partition layout and a recomputed partition reproduces its first run.

Plan (no driver collect, no global sort, no nested-loop join, no pairwise comparison):

1. Integer weights (real ones are scaled by one power of two).  Items are dealt
   to ``chunks`` hash chunks, in one shuffle that two readers share: the chunk
   totals (at most ``chunks`` rows, a proven size bound, so broadcast), which
   are prefix-summed into the chunks' places on the weight line ``[0, T)``, and
   a window that gives every item its interval ``[lo, hi)`` within its chunk.
2. Each draw is a hashed integer point ``d`` in ``[0, T)``; the owner is the
   item with ``lo <= d < hi``.  Intervals partition the line, so every draw
   has exactly one owner.
3. Lookup by merging.  A chunk's stretch of the line is cut into parts of equal
   width, so many that no part is wider than a ``ranges``-th of the line; a part
   has at most a chunk's items and about a ``ranges``-th of the draws, however
   heavy an item is.  Item starts and points are merged in each part, and a
   window carries the last start forward.  An item that reaches into further
   parts starts anew in each: at most ``ranges`` + ``chunks`` rows more in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.money import is_integral
from cartwheel.functions.random import hashed_long, hashed_pareto, hashed_uniform, integer_key



def _draw_key(df: DataFrame, key: str) -> Column:
    return integer_key(key, is_integral(df.schema[key].dataType))


def pareto_weights(items: DataFrame, key: str, alpha: float = 1.16, seed: int = 0,
                   scale: int = 10_000) -> DataFrame:
    """Attach integer weights ``floor(scale * pareto(alpha))`` (minimum ``scale``).

    Classical Pareto with minimum 1 (the ``pareto(alpha) + 1`` of NumPy);
    integer weights keep the interval ends exact.
    """
    w = F.floor(F.lit(float(scale)) * hashed_pareto(_draw_key(items, key), seed, "pareto", alpha)).cast("bigint")
    return items.select(key, w.alias("weight"))


def positive_weights(items: DataFrame, key: str, weight: str = "weight",
                     unique_keys: bool = False) -> DataFrame:
    """(key, _w): one row per item key with its total integer weight.

    Real weights are scaled by one power of two, the largest that keeps their
    sum within 62 bits, and take at least 1: proportions keep 60 bits, and no
    positive weight is lost.  NULL, NaN, infinite or non-positive weights can
    never be drawn and are dropped.  A key
    listed several times is merged into one item with the summed weight --
    the same draw probability -- so keys are unique afterwards and the hash
    chunks stay balanced even if one key fills a third of the input.  The
    merge is a partial aggregate before its shuffle.  ``unique_keys=True``
    (a primary-key column) skips the merge and its shuffle.
    """
    if is_integral(items.schema[weight].dataType):
        w = items.select(F.col(key), F.col(weight).cast("bigint").alias("_w")).where("_w > 0")
    else:
        real = items.select(F.col(key), F.col(weight).cast("double").alias("_x")) \
                    .where((F.col("_x") > 0) & (F.col("_x") < float("inf")))
        bits = real.agg(F.lit(61) - F.ceil(F.log2(F.count(F.lit(1)) * F.max("_x")))).scalar()
        scaled = F.floor(F.col("_x") * F.pow(F.lit(2.0), bits)).cast("bigint")
        w = real.select(key, F.greatest(scaled, F.lit(1).cast("bigint")).alias("_w"))
    return w if unique_keys else w.groupBy(key).agg(F.sum("_w").alias("_w"))


MAX_CHUNKS = 1 << 16  # bounds the broadcast table of chunk offsets


def weight_intervals(weights: DataFrame, key: str, chunks: int = 4096,
                     spread: Column | None = None) -> DataFrame:
    """Give every item of :func:`positive_weights` its interval [lo, hi) of [0, T).

    Columns: ``key``, lo, hi.  The order along the line is (chunk, key); a
    chunk is ``spread`` (a hash of the key unless given) modulo ``chunks``.
    """
    if not 0 < chunks <= MAX_CHUNKS:
        raise ValueError(f"chunks must be 1 to {MAX_CHUNKS}")
    w, offsets = _chunked(weights, key, chunks, spread)
    # ``offsets`` has at most ``chunks`` rows: broadcasting it is size-bounded.
    return _intervals(w, key).join(F.broadcast(offsets.select("_chunk", "_offset")), "_chunk") \
        .select(key, (F.col("_offset") + F.col("_from")).alias("lo"), (F.col("_offset") + F.col("_upto")).alias("hi"))


def _chunked(weights: DataFrame, key: str, chunks: int, spread: Column | None) -> tuple[DataFrame, DataFrame]:
    """Items dealt by chunk, and (_chunk, _total, _offset, _line) of the chunks: two readers of one shuffle.

    ``_line`` is the length of the whole line, the same in every row.
    """
    if not 0 < chunks <= MAX_CHUNKS:
        raise ValueError(f"chunks must be 1 to {MAX_CHUNKS}")
    spread = hashed_long(_draw_key(weights, key), 0, "chunk") if spread is None else spread
    w = weights.withColumn("_chunk", F.pmod(spread, F.lit(int(chunks)))).repartition("_chunk")
    # the key is counted so that both readers ask the shuffle for the same columns
    totals = w.groupBy("_chunk").agg(F.sum("_w").alias("_total"), F.count(F.struct(key)).alias("_items"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return w, totals.where("_items > 0").select(
        "_chunk", "_total", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
        F.sum("_total").over(Window.partitionBy()).alias("_line"))


def _intervals(w: DataFrame, key: str) -> DataFrame:
    """Every item's place [_from, _upto) within its chunk, in the order of the keys."""
    upto = (Window.partitionBy("_chunk").orderBy(key)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return w.withColumn("_upto", F.sum("_w").over(upto)).withColumn("_from", F.col("_upto") - F.col("_w"))


def weighted_sample(draws: DataFrame, draw_key: str, items: DataFrame, item_key: str,
                    weight: str = "weight", seed: int = 0, ranges: int = 4096,
                    chunks: int = 4096, unique_keys: bool = False,
                    draw: Column | None = None, spread: Column | None = None) -> DataFrame:
    """For every row of ``draws``, pick one item with probability ∝ its weight.

    The draw is a hash of ``draw_key``, uniform on (0, 1), unless ``draw`` gives
    another column of [0, 1); ``spread`` is that of :func:`weight_intervals`.
    Returns every column of ``draws`` plus ``item_key``, one row per draw.
    ``draw_key`` must be unique (it seeds the draw) and ``item_key`` must not
    already be a column of ``draws``.  Pass ``unique_keys=True`` only when
    ``item_key`` is a primary key of ``items``.  With no positive-weight item
    there is nothing to draw and the result is empty.  ``ranges`` is to grow with
    the draws (some millions a range), ``chunks`` with the items.
    """
    _check_names(draws, draw_key, item_key)
    weights = positive_weights(items, item_key, weight, unique_keys)
    w, offsets = _chunked(weights, item_key, chunks, spread)
    parts = F.greatest(F.ceil(F.col("_total") * float(ranges) / F.col("_line")), F.lit(1))
    places = offsets.withColumn("_width", F.ceil(F.col("_total") / parts).cast("bigint"))
    div = lambda a, b: F.call_function("div", a, b)  # noqa: E731 - whole numbers: exact at any length of the line
    part_of = lambda at: div(at, F.col("_width"))
    # items: their starts, anew in each part that they reach into
    ends = _intervals(w, item_key).join(F.broadcast(places.select("_chunk", "_width")), "_chunk")
    starts = ends.withColumn("_part", F.explode(F.sequence(part_of(F.col("_from")), part_of(F.col("_upto") - 1)))) \
        .select("_chunk", "_part", F.greatest(F.col("_from"), F.col("_part") * F.col("_width")).alias("_at"),
                F.struct(item_key).alias("_item"))
    # draws: the chunk of a point by a directory of equal stretches of the line, at most 3 * chunks rows
    stretch = F.greatest(F.ceil(F.col("_line") / (2.0 * chunks)).cast("bigint"), F.lit(1))
    first, last = (div(x, stretch) for x in (F.col("_offset"), F.col("_offset") + F.col("_total") - 1))
    directory = places.withColumn("_stretch", F.explode(F.sequence(first, last)))
    u = hashed_uniform(_draw_key(draws, draw_key), seed, "weighted-draw") if draw is None else draw
    line = offsets.agg(F.max("_line")).scalar()  # named once: each naming is planned anew
    points = draws.withColumn("_line", line) \
        .withColumn("_point", F.least(F.floor(u * F.col("_line")).cast("bigint"), F.col("_line") - 1)) \
        .withColumn("_stretch", div(F.col("_point"), stretch)) \
        .join(F.broadcast(directory.drop("_line")), "_stretch") \
        .where((F.col("_offset") <= F.col("_point")) & (F.col("_point") < F.col("_offset") + F.col("_total"))) \
        .withColumn("_at", F.col("_point") - F.col("_offset")).withColumn("_part", part_of(F.col("_at")))
    events = points.select("_chunk", "_part", "_at", F.lit(None).cast(starts.schema["_item"].dataType).alias("_item"),
                           F.struct(*draws.columns).alias("_draw")) \
                   .unionByName(starts, allowMissingColumns=True)
    # at equal places the start comes before the points
    order = Window.partitionBy("_chunk", "_part").orderBy("_at", F.col("_draw").isNotNull()) \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.withColumn("_owner", F.last("_item", ignorenulls=True).over(order)) \
                 .where(F.col("_draw").isNotNull()).select("_draw.*", f"_owner.{item_key}")


def _check_names(draws: DataFrame, draw_key: str, item_key: str) -> None:
    if draw_key == item_key or item_key in draws.columns:
        raise ValueError(f"{item_key!r} clashes with the columns of the draws")


def uniform_sample(draws: DataFrame, draw_key: str, items: DataFrame, item_key: str,
                   seed: int = 0, chunks: int = 4096, unique_keys: bool = False) -> DataFrame:
    """Uniform draw with replacement from the rows of ``items``.

    Every row is equally likely, so a key listed k times is k times as
    likely (its weight is its number of rows).  With ``unique_keys=True`` (a
    primary-key column) every item has weight 1 and a draw is a hashed
    position 0..N-1.  Whether the keys are whole numbers without gaps is seen
    from their least, greatest and count (one aggregate job over the key
    column); then the position is the key's distance from the least, and the
    draws are neither joined nor shuffled.  Otherwise the prefix sums give each
    item its position, matched by a plain equi-join.
    """
    if not unique_keys:
        ones = items.select(item_key, F.lit(1).cast("bigint").alias("_ones"))
        return weighted_sample(draws, draw_key, ones, item_key, weight="_ones", seed=seed,
                               chunks=chunks)
    _check_names(draws, draw_key, item_key)
    ones = items.select(F.col(item_key), F.lit(1).cast("bigint").alias("_w"))
    u = hashed_uniform(_draw_key(draws, draw_key), seed, "weighted-draw")
    if is_integral(items.schema[item_key].dataType):
        rows, n, least, greatest = items.agg(F.count(F.lit(1)), F.count(item_key), F.min(item_key),
                                             F.max(item_key)).first()
        if rows == n and n and greatest - least + 1 == n:
            position = F.least(F.floor(u * n).cast("bigint"), F.lit(n - 1))
            return draws.withColumn(item_key, (position + least).cast(items.schema[item_key].dataType))
    n_items = ones.agg(F.count(F.lit(1))).scalar()
    pts = draws.withColumn("_pos", F.least(F.floor(u * n_items).cast("bigint"), n_items - 1))
    positions = weight_intervals(ones, item_key, chunks).select(item_key, F.col("lo").alias("_pos"))
    return pts.join(positions, "_pos").select(*draws.columns, item_key)
