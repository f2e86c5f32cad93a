"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target in words: its share by weight of the whole mix, at
most ``max_repeat`` times its size, the excess reshared by weight.  Over the
training run, time 0 to 1, a source is drawn at the rate of its weight schedule
(piecewise linear).  The integral of the schedule, scaled to the target, is the
cumulative demand of the source; the documents of a source, in a hashed order
and repeated for a second epoch where the target needs it, lie one after another
on that demand, and each copy's training position is the time at which the
demand reaches its middle.  Sorting the copies of all sources by position, range by
range, gives the mix; a copy's place is its number in that order.

Running sums are taken in two levels, over ``16 ** bucket_digits`` buckets of
the hashed order within each source and inside each bucket, so that a source
with a third of all documents is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm._common import WORD, fresh, staged

# knots (time, weight) of a schedule; one per source, repeating
FLAT = ((0.0, 1.0), (1.0, 1.0))


def n_words(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _schedule(knots: tuple[tuple[float, float], ...]) -> Column:
    """Literal array of segments: t, weight, slope, and the share of demand before."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole = sum(areas)
    if whole <= 0 or any(w < 0 for _, w in knots) or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])):
        raise ValueError("a schedule needs rising times and a positive integral")
    before, rows = 0.0, []
    for (a, b), area in zip(zip(knots, knots[1:]), areas):
        rows.append(F.struct(F.lit(float(a[0])).alias("t"), F.lit(float(a[1])).alias("w"),
                             F.lit((b[1] - a[1]) / (b[0] - a[0])).alias("slope"),
                             F.lit(before / whole).alias("before"), F.lit(whole).alias("whole"),
                             F.lit(float(b[0])).alias("end")))
        before += area
    return F.array(*rows)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float,
                   max_repeat: float) -> DataFrame:
    """(source, source_size) -> + rank, weight, target.  One row per source.

    Sources are ranked by code point, null last, and take the weights in turn.
    Targets share ``share`` times all words by weight; none exceeds
    ``max_repeat`` times its source.  Filling in the order of cap over weight
    gives in one pass what resharing the excess again and again ends at.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(table, (F.col("rank") % len(weights) + 1).cast("int"))) \
                   .withColumn("cap", max_repeat * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.partitionBy(F.lit(0))
    filled = ranked.withColumn("level", F.try_divide(
        share * F.sum("source_size").over(every)
        - F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))))
    capped = F.col("cap") <= F.col("level") * F.col("weight")
    # the level of the first source below its cap holds for all after it
    first = F.struct((F.col("cap") / F.col("weight")).alias("at"), "rank", "level")
    final = F.min(F.when(~capped, first)).over(every)["level"]
    return filled.select("source", "source_size", "rank", "weight",
                         F.when(capped, F.col("cap")).otherwise(final * F.col("weight")).alias("target"))


def _position(offset: Column, target: Column, segments: Column) -> Column:
    """Time at which a source's cumulative demand reaches ``offset`` words."""
    q = offset / target
    seg = F.element_at(F.filter(segments, lambda s: s["before"] <= q), -1)
    area = (q - seg["before"]) * seg["whole"]
    root = F.sqrt(F.greatest(seg["w"] * seg["w"] + 2 * seg["slope"] * area, F.lit(0.0)))
    return F.least(seg["t"] + F.coalesce(F.try_divide(2 * area, seg["w"] + root), F.lit(0.0)), seg["end"])


def _placed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
            text_col: str = "text", weights: tuple[float, ...] = (5.0, 2.0, 1.0),
            share: float = 1.5, max_repeat: float = 2.0,
            schedules: tuple[tuple[tuple[float, float], ...], ...] = (FLAT,),
            bucket_digits: int = 3, out: str = "mix") -> tuple[DataFrame, list[str]]:
    """Rows of ``docs`` with a struct ``out`` (size, source_size, target, positions) and key columns; their names.

    The key is the source, the bucket of the hashed order and the row's number in
    the bucket.  Rows equal in id, size and source may swap keys from run to run.
    """
    key, group, bucket, size, offset, joined, seq, of_group, of_bucket, nth = fresh(
        docs.columns + [out], "key", "group", "bucket", "size", "offset", "joined", "seq", "of_group", "of_bucket", "nth")
    # a source's name without null, so that the join and the window below share one exchange
    name = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    hashed = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    sized = docs.withColumn(key, hashed).withColumn(bucket, F.substring(key, 1, bucket_digits)) \
                .withColumn(size, n_words(F.col(text_col))).withColumn(group, name)
    totals = sized.groupBy(F.col(source_col).alias("source"), F.col(group).alias("group"),
                           F.col(bucket).alias("bucket")).agg(F.sum(size).alias("bucket_size"))
    targets = source_targets(totals.groupBy("source").agg(F.sum("bucket_size").alias("source_size")),
                             weights, share, max_repeat)
    cycle = F.array(*[_schedule(s) for s in schedules])
    named = targets.withColumn("segments", F.element_at(
        cycle, (F.col("rank") % len(schedules) + 1).cast("int"))).withColumnRenamed("source", "named")
    before = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))) \
        .join(named, F.col("source").eqNullSafe(F.col("named"))) \
        .select("group", "bucket", F.struct("before", "source_size", "target", "segments").alias("of")) \
        .select(F.col("group").alias(of_group), F.col("bucket").alias(of_bucket), F.col("of").alias(joined))
    at = sized.join(offsets, (F.col(group) == F.col(of_group)) & (F.col(bucket) == F.col(of_bucket)))
    hash_order = Window.partitionBy(group, bucket).orderBy(key, id_col, size)
    within = hash_order.rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn(offset, F.col(f"{joined}.before") + F.coalesce(F.sum(size).over(within), F.lit(0))) \
           .withColumn(nth, F.row_number().over(hash_order))
    target, source_size = F.col(f"{joined}.target"), F.col(f"{joined}.source_size")
    epochs = F.sequence(F.lit(0), F.lit(max(0, int(-(-max_repeat // 1)) - 1)))
    middles = F.transform(epochs, lambda e: (e * source_size + F.col(offset)) + F.col(size) / 2)
    positions = F.transform(F.filter(middles, lambda m: (m < target)),
                            lambda m: _position(m, target, F.col(f"{joined}.segments")))
    return at.withColumn(seq, positions).select(
        *[F.col(f"`{c}`") for c in docs.columns if c != out], group, bucket, nth,
        F.struct(F.col(size).alias("size"), source_size.alias("source_size"), target.alias("target"),
                 F.col(seq).alias("positions")).alias(out)), [group, bucket, nth]


def in_order(copies: DataFrame, keys: list[str], place: str) -> DataFrame:
    """``copies`` numbered from 0 without gaps in the order of ``keys``, in a column ``place``.

    Rows are range-partitioned by the keys and sorted; a row's number is its number
    in its partition and the count of all partitions before (one row each, broadcast).
    The keys should be unique, so that no run of ties lies in one task.
    """
    row, part, before, found = fresh(copies.columns + [place], "row", "part", "before", "found")
    ordered = staged(copies.repartitionByRange(*keys).sortWithinPartitions(*keys)
                           .withColumn(row, F.monotonically_increasing_id()))
    # monotonically_increasing_id: the partition above 33 bits of the row's number in it
    parts = ordered.groupBy(F.shiftright(row, 33).alias(part)).count()
    every = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col(part).alias(found), F.coalesce(F.sum("count").over(every), F.lit(0)).alias(before))
    return ordered.join(F.broadcast(starts), F.shiftright(row, 33) == F.col(found)) \
        .withColumn(place, F.col(before) + F.col(row).bitwiseAND((1 << 33) - 1)).drop(row, before, found)


def plan_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", weights: tuple[float, ...] = (5.0, 2.0, 1.0),
             share: float = 1.5, max_repeat: float = 2.0,
             schedules: tuple[tuple[tuple[float, float], ...], ...] = (FLAT,),
             bucket_digits: int = 3, out: str = "mix") -> DataFrame:
    """Rows of ``docs`` with a struct ``out``: size, source_size, target, taken, positions, places.

    A copy of a document is taken if its middle lies before the source's
    target; ``positions`` has the time of each copy taken, ``places`` its number in
    the mix (from 0, over the copies of all sources sorted by position, then id) and
    ``taken`` is size times their number.  The order within a source is by MD5 of the id, then
    id and size, so reruns agree; rows equal in those are interchangeable.  A
    null or wordless text has size 0 and takes no words (its copies are placed
    like others' if its offset lies before the target).  A null source is one
    source, ranked last; a null id is an id of its own.  Empty in, empty out.

    What is sorted is narrow: each copy's key, id and position, staged in the shared folder.
    """
    placed, key = _placed(docs, id_col, source_col, text_col, weights, share, max_repeat, schedules,
                          bucket_digits, out)
    names = [f"key_{i}" for i in range(len(key))]
    copies = placed.select(*[F.col(k).alias(n) for k, n in zip(key, names)], F.col(id_col).alias("id"),
                           F.posexplode(f"{out}.positions").alias("epoch", "position"))
    numbered = in_order(copies, ["position", "id", *names, "epoch"], "place")
    *of, seq = fresh(placed.columns, *[f"of_{n}" for n in names], "copies")
    found = numbered.groupBy(*[F.col(n).alias(o) for n, o in zip(names, of)]) \
                    .agg(F.sort_array(F.collect_list(F.struct("place", "position"))).alias(seq))
    same = [F.col(k) == F.col(o) for k, o in zip(key, of)]
    taken = F.coalesce(F.size(seq), F.lit(0))
    empty = F.array().cast("array<double>"), F.array().cast("array<bigint>")
    return placed.join(found, same, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns if c != out],
        F.struct(*[F.col(f"{out}.{c}").alias(c) for c in ("size", "source_size", "target")],
                 (F.col(f"{out}.size") * taken).alias("taken"),
                 F.coalesce(F.col(f"{seq}.position"), empty[0]).alias("positions"),
                 F.coalesce(F.col(f"{seq}.place"), empty[1]).alias("places")).alias(out))


def mix(docs: DataFrame, position_col: str = "position", id_col: str = "doc_id", **how) -> DataFrame:
    """One row for each copy taken, in training order: docs' columns and the position.

    Rows are range-partitioned and sorted by (position, id).  ``position_col``
    replaces a column of that name.
    """
    plan, = fresh(docs.columns, "mix")
    placed, key = _placed(docs, id_col=id_col, out=plan, **how)
    copies = placed.withColumn(position_col, F.explode(f"{plan}.positions")).drop(plan, *key)
    return copies.orderBy(position_col, id_col)
