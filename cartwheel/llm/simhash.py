"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has bit b set if over half of its word shingles' XXH64
values have it set.  Two texts link if their fingerprints differ in at most
``max_distance`` bits; components of the links are near-duplicate groups.

Links are found by multi-index hashing.  The 64 bits are cut into m segments.
If two fingerprints differ in at most d bits, one segment differs in at most
floor(d / m) bits, so each distinct fingerprint enumerates that small Hamming
ball around each of its segments, fetches the table rows with such a segment
and verifies the whole distance.  Copies share a fingerprint and enter once.

A crowd of near copies may share segments by the thousand.  Links between
fingerprints that differ in a single bit are found first, by enumerating the 64
neighbours (at most 64 rows for each fingerprint), and their components are
known before the wider search, which then reports only pairs across components:
what it emits stays in proportion to the components, not to pairs in a crowd.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm._common import fresh, raw_bytes, staged
from cartwheel.llm.components import connected_components

BITS = 64


def fingerprint_of(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of UTF-8 text; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in
                       zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
                      dtype=np.uint64)
    set_in = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 65_536):  # bounds the unpacked bits of a very long text
        part = hashes[lo:lo + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | Column, shingle: int = 3, seed: int = 42) -> Column:
    """Fingerprint of a text column as a signed bigint (same bits); null text is empty."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle, seed) for t in texts],
                                  np.uint64).astype(np.int64))

    return run(raw_bytes(text))


def fingerprint_hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def _balls(segments: int, max_distance: int) -> list[tuple[int, int, list[int]]]:
    """(shift, width, masks) for each segment; masks are the ball around zero."""
    radius, out = max_distance // segments, []
    for s in range(segments):
        lo, hi = BITS * s // segments, BITS * (s + 1) // segments
        masks = [sum(1 << b for b in bits) for r in range(radius + 1)
                 for bits in combinations(range(hi - lo), r)]
        out.append((lo, hi - lo, masks))
    return out


def _unit_links(fps: DataFrame) -> DataFrame:
    """Pairs that differ in one bit: clear each set bit and look the result up."""
    bits = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(BITS)])
    near = F.transform(F.filter(bits, lambda m: F.col("fp").bitwiseAND(m) != 0),
                       lambda m: F.col("fp").bitwiseXOR(m))
    probes = fps.select(F.col("fp").alias("src"), F.explode(near).alias("dst"))
    return probes.join(fps.select(F.col("fp").alias("dst")), "dst").select("src", "dst")


def _wide_links(fps: DataFrame, max_distance: int, segments: int) -> DataFrame:
    """Pairs (fp, root) within ``max_distance`` bits whose roots differ."""
    balls = _balls(segments, max_distance)

    def key(shift: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))

    def entry(s: int, k: Column) -> Column:
        return F.struct(F.lit(s).alias("segment"), k.alias("key"))

    def ball(s: int, shift: int, width: int, masks: list[int]) -> Column:
        # walked towards smaller keys only: a pair is met once, from its larger key
        own = key(shift, width)
        around = F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]),
                             lambda m: own.bitwiseXOR(m))
        return F.transform(F.filter(around, lambda x: x <= own), lambda x: entry(s, x))

    table = fps.select(F.explode(F.array(*[entry(s, key(lo, w))
                                           for s, (lo, w, _) in enumerate(balls)])).alias("at"),
                       F.col("fp").alias("fp_b"), F.col("root").alias("root_b"))
    probes = fps.select(F.explode(F.flatten(F.array(*[ball(s, *of) for s, of in enumerate(balls)])))
                        .alias("at"), F.col("fp").alias("fp_a"), F.col("root").alias("root_a"))
    flat = lambda d: d.select("at.*", *[c for c in d.columns if c != "at"])
    a, b = flat(probes).alias("a"), flat(table).alias("b")
    return a.join(b, (F.col("a.segment") == F.col("b.segment")) & (F.col("a.key") == F.col("b.key"))
                  & (F.col("root_a") != F.col("root_b"))
                  & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= max_distance)) \
            .select(F.col("root_a").alias("src"), F.col("root_b").alias("dst")).distinct()


def link_fingerprints(fps: DataFrame, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """Distinct ``fp`` -> (fp, root) for those that link to another one."""
    linked = connected_components(_unit_links(fps)) if max_distance else None
    if linked is None:
        return fps.select("fp", F.col("fp").alias("root")).limit(0)
    first = staged(fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                   .select("fp", F.coalesce("root", "fp").alias("root")))
    wide = connected_components(_wide_links(first, max_distance, segments))
    wide = wide.select(F.col("node").alias("root"), F.col("root").alias("wide_root"))
    return first.join(wide, "root", "left").select("fp", F.coalesce("wide_root", "root").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_distance: int = 3, segments: int = 2,
                       seed: int = 42) -> DataFrame:
    """One row per input row: (id, fp bigint, component_id).

    ``component_id`` is the least id reachable over links.  Null or wordless
    texts have fingerprint zero and link like any other; a null id takes part
    but never names a component (null only if no member has an id).  Repeated
    rows and ids are kept.  Extra columns are ignored.  Empty in, empty out.
    """
    rows = staged(docs.select(F.col(id_col).alias("id"),
                              fingerprint(F.col(text_col), shingle, seed).alias("fp")))
    fps = staged(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = fps.join(link_fingerprints(fps.select("fp"), max_distance, segments), "fp", "left") \
               .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = staged(roots.join(named, "root").select("fp", "component_id"))
    return rows.join(of_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_distance: int = 3, segments: int = 2,
                       seed: int = 42) -> DataFrame:
    """Rows of ``docs`` with exactly one row left of each near-duplicate group.

    The row with the least id stays (ids before nulls); among rows that share
    that id, the least by a hash of all columns; equal rows count once.  Null
    and wordless texts are near-duplicates of each other.  Columns may have any
    name and any type; all are returned as they are.  Empty in, empty out.
    """
    columns = docs.columns
    fp, digest, missing, root, n, own, id_of = fresh(columns, "fp", "digest", "missing", "root", "n", "own", "id_of")
    quoted = [F.col(f"`{c}`") for c in columns]
    hashed = F.xxhash64(*[F.to_json(F.struct(c)) if _holds_map(docs.schema[name].dataType) else c
                          for c, name in zip(quoted, columns)])
    marks = docs.select(
        F.col(f"`{id_col}`").isNull().alias(missing), F.col(f"`{id_col}`").alias(id_of), hashed.alias(digest),
        fingerprint(F.col(f"`{text_col}`"), shingle, seed).alias(fp))
    marks = staged(marks.groupBy(id_of, missing, digest, fp).agg(F.count(F.lit(1)).alias(n)))
    roots = link_fingerprints(marks.select(F.col(fp).alias("fp")).distinct(), max_distance, segments)
    grouped = marks.join(roots.withColumnsRenamed({"fp": fp, "root": root}), fp, "left") \
                   .withColumn(root, F.coalesce(root, fp))
    first = grouped.groupBy(root).agg(F.min(F.struct(missing, id_of, digest, n)).alias("first")).select("first.*")
    first = staged(first.select(F.col(digest).alias(own), id_of, n))
    kept = docs.withColumn(digest, hashed)
    chosen = lambda which: kept.join(first.filter(which), (F.col(digest) == F.col(own))
                                     & F.col(f"`{id_col}`").eqNullSafe(F.col(id_of)), "left_semi")
    once = chosen(F.col(n) == 1).select(*quoted)
    again = chosen(F.col(n) > 1).dropDuplicates([digest]).select(*quoted)
    return once.unionByName(again)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)
