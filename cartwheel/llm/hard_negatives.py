"""Hard negatives by a secondary-sort shuffle of packed pair scores.

An anchor's positives are its best other rows of its label.  Each positive opens
a window of scores, a share of its own score, and the best rows of other labels
in the window are that positive's hard negatives.

The anchors are the stated query set.  They are taken in blocks of bounded size
(``anchor_block``), and each block meets all rows, in two scans without a shuffle
of vectors: a task first keeps each anchor's best positives, and when those of all
tasks are known, the best rows of each window.  What a task keeps of an anchor is
bounded by ``n_positives * (n_negatives + 1)``, whatever the rows or labels are.

The kept pairs are packed into keys (anchor, descending score, id), dealt by
anchor and sorted within the partitions.  An iterator streams over them: a
positive opens its window, a negative is emitted for each open window that it
lies in.  It holds the open windows of one anchor, never the anchor's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm._common import staged
from cartwheel.session import scratch_path

TILE = 512  # rows scored against a block at a time
PAIR = "anchor_row bigint, anchor_id bigint, score bigint, row bigint, id bigint"
KEY = PAIR + ", negative boolean"
RESULT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
          "positive_score bigint, negative_score bigint")


def usable_rows(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                label_col: str = "label", scale: int = 256) -> DataFrame:
    """(row, id, label, anchor, vector of floor(scale * x)); rows that cannot take part are left out."""
    doubles = F.transform(vector_col, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(doubles, lambda x: F.floor(x * scale)).alias("vector"))


class Block:
    """A block of anchors of one dimension, and the windows of their positives."""

    def __init__(self, rows: pa.Table):
        self.row = rows.column("row").to_numpy()
        self.id = rows.column("id").combine_chunks()
        self.label = rows.column("label").to_numpy()
        self.vectors = np.array(rows.column("vector").to_pylist(), np.int64).reshape(len(self.row), -1)
        self.reach = int(np.abs(self.vectors.astype(np.float64)).max(initial=0)) + 1
        self.floats = self.vectors.astype(np.float64)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by rows.  A product beyond 64 bits raises OverflowError."""
        reach = int(np.abs(vectors.astype(np.float64)).max(initial=0)) + 1
        if reach * self.reach * vectors.shape[1] < 1 << 53:
            return (self.floats @ vectors.T.astype(np.float64)).astype(np.int64)
        exact = self.vectors.astype(object) @ vectors.T.astype(object)
        return np.array([[int(x) for x in line] for line in exact], np.int64).reshape(len(self.row), -1)


class Best:
    """The best ``k`` pairs of each group: score descending, then id (nulls last), then row."""

    def __init__(self, groups: int, k: int):
        self.k, self.least = k, np.full(groups, np.iinfo(np.int64).min)
        self.kept = [np.zeros(0, np.int64) for _ in range(4)] + [np.zeros(0, bool)]

    def add(self, group, score, row, vec, missing) -> None:
        group, score, row, vec, missing = (np.concatenate(x) for x in
                                           zip(self.kept, (group, score, row, vec, missing)))
        order = np.lexsort((row, vec, missing, ~score, group))  # ~score descends without overflow
        ordered = group[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[first, len(ordered)])
        order = order[np.arange(len(ordered)) - np.repeat(first, sizes) < self.k]
        self.kept = [x[order] for x in (group, score, row, vec, missing)]
        full = first[sizes >= self.k]
        at = np.cumsum(np.minimum(sizes, self.k))[sizes >= self.k] - 1
        self.least[ordered[full]] = self.kept[1][at]


def _tiles(batches: Iterator[pa.RecordBatch], dimension: int):
    """(row, id, missing id, label, vectors) of the rows of the block's dimension."""
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.diff(lists.offsets.to_numpy())
        same = np.flatnonzero(sizes == dimension)
        for lo in range(0, len(same), TILE):
            part = batch.take(pa.array(same[lo:lo + TILE]))
            ids = part.column("id")
            yield (part.column("row").to_numpy(), ids.fill_null(0).to_numpy(),
                   ids.is_null().to_numpy(zero_copy_only=False), part.column("label").to_numpy(),
                   part.column("vector").flatten().to_numpy().reshape(len(part), dimension))


def _pairs(block: Block, anchor, score, row, vec, missing) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block.row[anchor]), block.id.take(pa.array(anchor)), pa.array(score), pa.array(row),
         pa.array(vec, mask=missing)], ["anchor_row", "anchor_id", "score", "row", "id"])


def _positives(rows: DataFrame, shared, k: int) -> DataFrame:
    """Each task's best ``k`` rows of each anchor's label."""

    def run(batches):
        block = shared.value
        best = Best(len(block.row), k)
        for row, vec, missing, label, vectors in _tiles(batches, block.vectors.shape[1]):
            score = block.scores(vectors)
            anchor, at = np.nonzero((block.label[:, None] == label) & (block.row[:, None] != row)
                                    & (score >= best.least[:, None]))
            best.add(anchor, score[anchor, at], row[at], vec[at], missing[at])
        yield _pairs(block, *best.kept)

    return rows.select("row", "id", "label", "vector").mapInArrow(run, PAIR)


def _bounds(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and highest score in the window of each positive; the products may exceed 64 bits."""
    exact, ends = positive.astype(object), np.iinfo(np.int64)
    return tuple(np.clip(x, ends.min, ends.max).astype(np.int64)
                 for x in (-(-low * exact // 100), high * exact // 100))


def _negatives(rows: DataFrame, shared, windows, k: int, low: int, high: int) -> DataFrame:
    """Each task's best ``k`` rows of other labels in each window; a pair is listed once."""

    def run(batches):
        block = shared.value
        anchors, positive = windows.value
        least, most = _bounds(positive, low, high)
        open_ = np.flatnonzero(least <= most)
        best = Best(len(positive), k)
        for row, vec, missing, label, vectors in _tiles(batches, block.vectors.shape[1]):
            score, other = block.scores(vectors), block.label[:, None] != label
            for lo in range(0, len(open_), TILE):
                w = open_[lo:lo + TILE]
                near = score[anchors[w]]
                bar = np.maximum(least[w], best.least[w])[:, None]
                window, at = np.nonzero(other[anchors[w]] & (near >= bar) & (near <= most[w][:, None]))
                best.add(w[window], near[window, at], row[at], vec[at], missing[at])
        window, *rest = best.kept
        kept = np.unique(np.stack([anchors[window], rest[1]]), axis=1, return_index=True)[1]
        yield _pairs(block, anchors[window][kept], *[x[kept] for x in rest])

    return rows.select("row", "id", "label", "vector").mapInArrow(run, PAIR)


def _stream(n_positives: int, n_negatives: int, low: int, high: int):
    """Iterator over pairs sorted by key: windows open at positives and count their negatives."""

    def run(batches):
        anchor, windows = None, []
        for batch in batches:
            out = []
            for a, a_id, score, negative, other in zip(*[batch.column(c).to_pylist() for c in (
                    "anchor_row", "anchor_id", "score", "negative", "id")]):
                if a != anchor:
                    anchor, windows = a, []
                if not negative:
                    if len(windows) < n_positives:
                        windows.append([score, other, 0])
                    continue
                for window in windows:
                    if window[2] < n_negatives and low * window[0] <= 100 * score <= high * window[0]:
                        window[2] += 1
                        out.append((a_id, window[1], window[2], other, window[0], score))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: int = 256, n_positives: int = 5, n_negatives: int = 10,
         low: int = 30, high: int = 90, anchor_block: int = 16_384) -> DataFrame:
    """Hard negatives of the rows where ``anchor`` holds: one row for each (anchor, positive, negative).

    Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    Scores are inner products of the vectors floor(scale * x).  A negative of a positive with score
    p has a score s with low * p <= 100 * s <= high * p.

    Rows with a null label or vector, or with a null or non-finite component, take no part.  Only
    vectors of equal length have a score; empty vectors score 0.  A null id takes part, comes last in
    ties and is never an anchor by a null condition.  Repeated rows are rows of their own: each
    repeats as positive, negative and anchor, and an anchor is only kept from itself.  Extra columns
    are ignored.  Empty in, empty out; anchors without positives or negatives have no rows.
    """
    spark = vectors.sparkSession
    rows = staged(usable_rows(vectors, anchor, id_col, vector_col, label_col, scale))
    sizes = rows.filter("anchor").groupBy(F.size("vector").alias("dimension")).count().collect()
    path, written = scratch_path(spark, "pairs"), False
    for dimension, count in sizes:
        blocks = -(-count // anchor_block)
        of_block = F.pmod(F.xxhash64("row"), F.lit(blocks))
        anchors = rows.filter(F.col("anchor") & (F.size("vector") == dimension))
        for b in range(blocks):
            found = anchors.filter(of_block == b).select("row", "id", "label", "vector").toArrow()
            for lo in range(0, len(found), anchor_block):  # a block above its bound is cut
                block = Block(found.slice(lo, anchor_block))
                shared = spark.sparkContext.broadcast(block)
                best = staged(_best_positives(_positives(rows, shared, n_positives), n_positives))
                # at most anchor_block * n_positives rows
                held = best.select("anchor_row", "score").toArrow()
                number = {r: i for i, r in enumerate(block.row.tolist())}
                windows = spark.sparkContext.broadcast((
                    np.array([number[r] for r in held.column(0).to_pylist()], np.int64),
                    held.column(1).to_numpy().astype(np.int64)))
                negatives = _negatives(rows, shared, windows, n_negatives, low, high)
                best.withColumn("negative", F.lit(False)).unionByName(
                    negatives.withColumn("negative", F.lit(True))).write.mode("append").parquet(path)
                written = True
                shared.destroy()
                windows.destroy()
    if not written:
        return spark.createDataFrame([], RESULT)
    keys = spark.read.schema(KEY).parquet(path)
    ordered = keys.repartition("anchor_row").sortWithinPartitions(
        "anchor_row", F.desc("score"), "negative", F.asc_nulls_last("id"), "row")
    return ordered.mapInArrow(_stream(n_positives, n_negatives, low, high), RESULT)


def _best_positives(pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of the tasks' positives, by a window over one anchor's few rows."""
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return pairs.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).drop("at")
