"""Packing documents into training sequences by cutting-stock column generation.

A document is its token ids and an end id.  It is cut every ``piece`` ids, a power
of two up to the sequence length: the longest that keeps planned padding within
``tolerance``, so that documents are cut no more than padding asks for.

1. Lengths are counted in classes (exact when short, a few ids wide when long; a
   class stands for its upper end, so that a plan by classes always fits).  The
   histogram has some 350 rows at most, whatever the corpus is.
2. The driver solves the cutting-stock linear program over that histogram: a
   pattern is a number of pieces of each class that fit one sequence.  A knapsack
   dynamic program finds the pattern of the best price under the dual values, and
   patterns are added until none is worth more than a sequence (or the dual bound
   proves the plan within ``CLOSE`` of the optimum).
3. Pattern counts are rounded down.  What is left of the histogram, and the short
   pieces, which the program leaves out, go into the patterns' gaps and then into
   new patterns, largest first.
4. Pieces are ranked within their class (in hashed buckets, so that no task ranks
   a whole class), and a pattern's uses take consecutive ranks.  A sequence's
   pieces lie gapless from 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm._common import staged
from cartwheel.llm.tokens import word_ids

CLOSE = 2e-3
BUCKET = 500_000  # pieces ranked by one window, about


def token_bytes(text: Column, tokenizer: str, end_id: int) -> Column:
    """Ids of a text and the end id, as little-endian 32-bit binary; a null text is empty."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = word_ids(tokenizer)
        for texts in batches:
            yield pa.chunked_array([*ids.of(texts, end_id)], pa.large_binary()).combine_chunks().cast(pa.binary())

    return run(text)


def class_sizes(capacity: int) -> np.ndarray:
    """Upper ends of the length classes: exact up to 64, then wider, up to a 256th of the capacity."""
    sizes, step = [], 1
    while not sizes or sizes[-1] < capacity:
        size = sizes[-1] + step if sizes else 1
        sizes.append(min(size, capacity))
        if 256 * step < capacity and size >= 64 * step:
            step *= 2
    return np.array(sizes, np.int64)


@dataclass
class Plan:
    """``uses[p]`` sequences take ``patterns[p][c]`` pieces of class c each."""

    sizes: np.ndarray
    patterns: np.ndarray
    uses: np.ndarray

    @property
    def sequences(self) -> int:
        return int(self.uses.sum())

    def rows(self) -> list[tuple[int, int, int, int, int]]:
        """(class, first rank, end rank, pieces a use, first sequence), class by class."""
        first = np.concatenate([[0], np.cumsum(self.uses)])
        out = []
        for c in range(len(self.sizes)):
            rank = 0
            for p in np.flatnonzero(self.patterns[:, c]):
                each = int(self.patterns[p, c])
                end = rank + each * int(self.uses[p])
                out.append((c, rank, end, each, int(first[p])))
                rank = end
        return out


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits (unbounded knapsack by dynamic programming)."""
    worth = prices > 1e-12
    use, price = sizes[worth], prices[worth]
    pattern = np.zeros(len(sizes), np.int64)
    if not len(use):
        return 0.0, pattern
    order = np.argsort(use, kind="stable")
    use, price, numbers = use[order], price[order], np.flatnonzero(worth)[order]
    value = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fitting = np.searchsorted(use, np.arange(capacity + 1), side="right").tolist()
    for room in range(int(use[0]), capacity + 1):
        n = fitting[room]
        gains = value[room - use[:n]] + price[:n]
        k = int(gains.argmax())
        value[room] = gains[k]
        taken[room] = k
    room = capacity
    while taken[room] >= 0:
        pattern[numbers[taken[room]]] += 1
        room -= int(use[taken[room]])
    return float(value[capacity]), pattern


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The linear program by column generation: (patterns, how often each, in fractions).

    Minimises the sequences that cover ``counts`` pieces of each size; all counts are positive.
    """
    m = len(sizes)
    scale = float(counts.sum())
    amount = counts / scale
    patterns = np.diag(capacity // sizes)
    inverse = np.diag(1.0 / (capacity // sizes))
    uses = inverse @ amount
    least = float((sizes * amount).sum()) / capacity
    for _ in range(40 * m):
        prices = np.maximum(inverse.sum(axis=0), 0)
        value, pattern = best_pattern(sizes, prices, capacity)
        # prices divided by ``value`` are a dual solution: no plan needs fewer sequences
        least = max(least, float((prices * amount).sum()) / max(value, 1e-12))
        if value <= 1 + 1e-9 or uses.sum() <= least * (1 + CLOSE):
            break
        direction = inverse @ pattern
        candidates = np.flatnonzero(direction > 1e-9)
        ratios = uses[candidates] / direction[candidates]
        leave, step = int(candidates[ratios.argmin()]), float(ratios.min())
        uses -= step * direction
        uses[leave] = step
        np.maximum(uses, 0, out=uses)
        line = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, line)
        inverse[leave] = line
        patterns[leave] = pattern
    return patterns, uses * scale


def fill(patterns: list[tuple[np.ndarray, int]], sizes: np.ndarray, counts: np.ndarray,
         capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with the pieces of ``counts`` put into their gaps, largest first, then into new ones.

    A pattern whose uses are more than a class's pieces is split into those that take one and the others.
    """
    left, out, todo = counts.copy(), [], list(patterns)
    while todo or left.any():
        if todo:
            pattern, n = todo.pop()
        else:  # a sequence of the largest class that is left
            c = int(np.flatnonzero(left)[-1])
            each = min(capacity // int(sizes[c]), int(left[c]))
            pattern, n = np.zeros(len(sizes), np.int64), int(left[c]) // each
            pattern[c] = each
            left[c] -= each * n
        room = capacity - int((sizes * pattern).sum())
        for c in range(len(sizes) - 1, -1, -1):
            each = room // int(sizes[c])
            if not left[c] or not each:
                continue
            if left[c] < n:  # the uses that this class no longer reaches
                todo.append((pattern.copy(), n - int(left[c])))
                n = int(left[c])
            each = min(each, int(left[c]) // n)
            pattern[c] += each
            left[c] -= each * n
            room -= each * int(sizes[c])
        out.append((pattern, n))
    return out


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """Patterns for a histogram over :func:`class_sizes`; every piece has a place.

    Pieces above a sixteenth of the capacity are the program's; the short ones fill the gaps.
    """
    sizes = class_sizes(capacity)
    unit = max(1, capacity // 512)
    used = np.flatnonzero((counts > 0) & (16 * sizes > capacity))
    made, left = [], counts.copy()
    if len(used):
        patterns, uses = solve(-(-sizes[used] // unit), counts[used], capacity // unit)
        for pattern, n in zip(patterns, np.floor(uses + 1e-9).astype(np.int64)):
            own = pattern > 0
            n = min(int(n), int((left[used][own] // pattern[own]).min()))
            if n:
                whole = np.zeros(len(sizes), np.int64)
                whole[used] = pattern
                left -= n * whole
                made.append((whole, n))
    made = fill(made, sizes, left, capacity)
    return Plan(sizes, np.array([p for p, _ in made], np.int64).reshape(-1, len(sizes)),
                np.array([n for _, n in made], np.int64))


def choose_cut(remainders: dict[int, int], whole: int, capacity: int, tolerance: float) -> tuple[int, Plan]:
    """The longest piece, a power of two, whose plan pads at most ``tolerance`` (else the best).

    ``remainders`` counts documents by length modulo ``capacity``; ``whole`` is how often the
    capacity lies in their lengths.  Both give the histogram of every shorter piece.
    """
    sizes = class_sizes(capacity)
    lengths = np.array(sorted(remainders), np.int64)
    amounts = np.array([remainders[n] for n in lengths.tolist()], np.int64)
    ids = whole * capacity + int((lengths * amounts).sum())
    best = None
    piece = capacity
    while piece >= min(64, capacity):
        counts = np.zeros(len(sizes), np.int64)
        np.add.at(counts, np.searchsorted(sizes, piece), int(whole * (capacity // piece) + (lengths // piece * amounts).sum()))
        rest = lengths % piece
        np.add.at(counts, np.searchsorted(sizes, rest[rest > 0]), amounts[rest > 0])
        made = plan(counts, capacity)
        if best is None or made.sequences < best[1].sequences:
            best = piece, made
        if made.sequences * capacity - ids <= max(tolerance * ids, capacity):
            break
        piece //= 2
    return best


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = 2, capacity: int = 4096, tolerance: float = 0.01) -> DataFrame:
    """One row for each piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    ``tokenizer`` is a tokenizer file whose words are lower-cased runs between white space.
    ``ids`` holds the piece's ids as little-endian 32-bit binary; the pieces of a document, by
    ``start``, are its ids and the end id, and those of a sequence, by ``offset``, lie gapless
    from 0 and fit ``capacity``, a power of two.  Null and empty texts have the end id alone.
    Null and repeated ids and repeated rows are documents of their own, told apart by ``doc_row``.
    Extra columns are ignored.  Empty in, empty out.
    """
    spark = docs.sparkSession
    stored = staged(docs.select(F.monotonically_increasing_id().alias("doc_row"), F.col(id_col).alias("id"),
                                token_bytes(F.col(text_col), tokenizer, end_id).alias("ids"))
                    .withColumn("doc_tokens", (F.octet_length("ids") / 4).cast("bigint")), compression="zstd")
    lengths = stored.groupBy((F.col("doc_tokens") % capacity).alias("rest")) \
                    .agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("doc_tokens") / capacity)).alias("whole")) \
                    .collect()  # at most ``capacity`` rows
    piece, made = choose_cut({r.rest: r.n for r in lengths}, sum(r.whole for r in lengths), capacity, tolerance)
    starts = F.sequence(F.lit(0), F.col("doc_tokens") - 1, F.lit(piece))
    tally = stored.select("doc_row", "doc_tokens", F.explode(starts).alias("start")) \
                  .transform(_classed, piece, made)  # reads no ids
    cut = F.transform(starts, lambda k: F.struct(k.alias("start"), F.substring(
        F.col("ids"), (4 * k + 1).cast("int"), F.lit(4 * piece)).alias("ids")))
    # pieces are narrow unless the caller reads ``ids``; the checksum is taken before they move
    pieces = stored.select("doc_row", "id", "doc_tokens", F.explode(cut).alias("p")) \
                   .select("doc_row", "id", "doc_tokens", "p.*") \
                   .withColumn("checksum", F.crc32("ids")).transform(_classed, piece, made)
    ranked = _ranked(pieces, tally)
    table = spark.createDataFrame(made.rows(), "class int, first bigint, end bigint, each bigint, sequence bigint")
    # at most some 350 patterns of the program and as many of the rest, over 350 classes
    at = F.broadcast(table.withColumnRenamed("class", "of_class"))
    placed = ranked.join(at, (F.col("class") == F.col("of_class")) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("end"))) \
                   .withColumn("sequence_id", F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("each")))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_row", "start")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return placed.withColumn("offset", offset).select(
        F.col("id").alias(id_col), "doc_row", "start", "length", "ids", "checksum", "doc_tokens", "sequence_id", "offset")


def _buckets(made: Plan) -> int:
    pieces = int((made.patterns.sum(axis=1) * made.uses).sum()) if made.sequences else 0
    return max(16, -(-pieces // BUCKET))


def _class_of(length: Column, sizes: np.ndarray) -> Column:
    """The number of the least class that holds a length, one arithmetic rule for each step of the sizes."""
    out, steps = None, np.diff(sizes, prepend=0)
    for first in np.flatnonzero(np.r_[True, steps[1:] != steps[:-1]]).tolist():
        step, below = int(steps[first]), int(sizes[first] - steps[first])
        of = (F.ceil((length - below) / step) + (first - 1)).cast("int")
        out = of if out is None else F.when(length > below, of).otherwise(out)
    return out


def _classed(pieces: DataFrame, piece: int, made: Plan) -> DataFrame:
    length = F.least(F.lit(piece), F.col("doc_tokens") - F.col("start"))
    return pieces.withColumn("length", length).withColumn("class", _class_of(F.col("length"), made.sizes)) \
                 .withColumn("bucket", F.pmod(F.xxhash64("doc_row", "start"), F.lit(_buckets(made))))


def _ranked(pieces: DataFrame, tally: DataFrame) -> DataFrame:
    """Ranks from 0 within each class: a window in each bucket, and the buckets' sums before it."""
    counts = tally.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("class", "bucket").orderBy("doc_row", "start")
    return pieces.withColumn("rank", F.row_number().over(inside) - 1).join(counts, ["class", "bucket"]) \
                 .withColumn("rank", F.col("rank") + F.col("before"))
