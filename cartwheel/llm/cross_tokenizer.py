"""Alignment of two tokenizers' tokens by merge-path partitioning, and corpus-wide link counts.

Both tokenizers spell out the bytes of a text, so their tokens' end offsets are two
ascending lists.  Merged, each distinct end closes one stretch that lies in one token
of either side: the distinct ends are the links, and the ends that both have cut the
text into groups.

The merge is divided by the merge path: cross diagonals at equal distances are searched
by bisection for the point where the merged list passes, all diagonals at once.  The
pieces between have equal work, however the tokens and documents lie, and know nothing
of each other; each emits its links and common ends.  An end that a diagonal parts from
its equal is stitched to the earlier piece, and groups are read off the common ends of
all pieces in a row.

Link counts are corpus-wide.  A block (a task's documents, up to bounds) numbers its
distinct pairs, and its documents hold numbers.  Only a block's distinct pairs are
shuffled, with how many of its documents hold each; counts return to the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm._common import staged
from cartwheel.llm.tokens import LONG, byte_alphabet, hub_tokenizer

CACHE = 200_000  # words whose ids a worker keeps, about
PIECE = 1 << 16  # ends merged by a piece
BATCH = 1 << 20  # characters aligned at a time, or one document
MAX_CELLS = 96_000_000  # bytes of the cells of a block's documents, about
# Neither tokenizer merges across one space between two characters that are no white space.
BORDER = re.compile(r"(?<=\S) (?=\S)")
ALIGNED = ("id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block bigint, "
           "cells binary, pairs array<bigint>, holders array<int>")


class Tokenizers:
    """Token ids and byte lengths of a space and a text, under a byte-level file (A) and a piece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.a = hub_tokenizer(path_a, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in byte_alphabet().items()}
        spell = lambda t: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        of_id = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = [spell(of_id.get(i, "")) for i in range(max(of_id) + 1)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # merges are numbered in the order of their ranks, so the ranks alone give the same ids, much faster
        plain = [self.bytes_a[i] for i in range(self.a.get_vocab_size(with_added_tokens=False))]
        self.ranks = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                       mergeable_ranks={x: i for i, x in enumerate(plain)})
        # an id's text with what follows it: inside a group, and at the end of the group's side
        texts = [f"{i}{mark}" for marks, n in ((",|", len(self.bytes_a)), (",;", len(self.bytes_b)))
                 for i in range(n) for mark in marks]
        self.spelled_size = np.array([len(x) for x in texts], np.int64)
        self.spelled = np.array(texts, "S").view(np.uint8).reshape(len(texts), -1)
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}

    def _encode(self, words: list[str]) -> dict:
        """Ids of each word with its space under A and B, and whether both spell it."""
        spaced = [" " + w for w in words]
        sides = self._encode_a(spaced), self.b.encode(words, num_threads=1)
        raw, packed, same = [s.encode() for s in spaced], [], np.ones(len(words), bool)
        for ids, spelling in zip(sides, (self.bytes_a, self.bytes_b)):
            flat = list(chain.from_iterable(ids))
            if b"".join(map(spelling.__getitem__, flat)) != b"".join(raw):
                same &= [b"".join(map(spelling.__getitem__, x)) == r for x, r in zip(ids, raw)]
            data, ends = np.array(flat, "<u4").tobytes(), [0, *accumulate(map(len, ids))]
            packed.append([data[4 * lo:4 * hi] for lo, hi in zip(ends, ends[1:])])
        return dict(zip(words, zip(*packed, same.tolist())))

    def _encode_a(self, spaced: list[str]) -> list[list[int]]:
        """Short words in one run of the ranks, cut at the words' ends; long ones by the file's own merges."""
        short = [s for s in spaced if len(s) <= LONG]
        flat = self.ranks.encode_ordinary("".join(short))
        ends = np.cumsum(np.fromiter((len(s.encode()) for s in short), np.int64, len(short)))
        cuts = [0, *(np.searchsorted(np.cumsum(self.size_a[flat]), ends) + 1).tolist()]
        found = map(flat.__getitem__, map(slice, cuts, cuts[1:]))
        return [next(found) if len(s) <= LONG else self.a.encode(s, add_special_tokens=False).ids for s in spaced]

    def ids(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids under A and B; none for null and empty texts and those that a side does not spell."""
        if len(self.known) > CACHE:
            self.known = {}
        words = [BORDER.split(t) if t else () for t in texts]
        new = list(set().union(*words).difference(self.known)) if words else []
        found = self._encode(new)
        long = {w: v for w, v in found.items() if len(w) > LONG}
        self.known.update((w, v) for w, v in found.items() if len(w) <= LONG)
        find = self.known.__getitem__ if not long else lambda w: long.get(w) or self.known[w]
        out = []
        for text, ws in zip(texts, words):
            a, b, same = zip(*map(find, ws)) if ws else ((), (), ())
            a, b = np.frombuffer(b"".join(a), "<u4"), np.frombuffer(b"".join(b), "<u4")
            if not all(same) and not self._spells(text, a, b):
                a = b = a[:0]
            out.append((a, b))
        return out

    def _spells(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        raw = (" " + text).encode()
        return (b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw
                and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == raw)


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first d merged elements, for each diagonal d (``a`` first on ties)."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        goes = np.zeros(len(diagonals), bool)
        goes[open_] = a[middle[open_]] <= b[(diagonals - middle - 1)[open_]]
        low, high = np.where(open_ & goes, middle + 1, low), np.where(open_ & ~goes, middle, high)
    return low


def pieces(a: np.ndarray, b: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges (a from, to, b from, to) of equal work; equal ends lie in one piece."""
    diagonals = np.append(np.arange(0, len(a) + len(b), size), len(a) + len(b))
    at_a = merge_path(a, b, diagonals)
    at_b = diagonals - at_a
    parted = np.flatnonzero((at_a > 0) & (at_b < len(b)))
    parted = parted[a[at_a[parted] - 1] == b[at_b[parted]]]
    at_b[parted] += 1  # stitched to the piece of its equal
    yield from zip(at_a[:-1].tolist(), at_a[1:].tolist(), at_b[:-1].tolist(), at_b[1:].tolist())


def overlaps(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of two ascending lists of ends with the same last end: (index in a, index in b, common end)."""
    out = [np.zeros((2, 0), np.int64)]
    common = [np.zeros(0, bool)]
    for a0, a1, b0, b1 in pieces(a, b, size):
        own_a, own_b = a[a0:a1], b[b0:b1]
        ends = np.sort(np.concatenate([own_a, own_b]), kind="stable")
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
        i, j = a0 + np.searchsorted(own_a, ends), b0 + np.searchsorted(own_b, ends)
        out.append(np.stack([i, j]))
        common.append(a[i] == b[j])
    links = np.concatenate(out, axis=1)
    return links[0], links[1], np.concatenate(common)


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers by byte planes: the high planes are nearly all zero and compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class PairNumbers:
    """Numbers of the pairs met in a block, in order of meeting, and how many documents hold each."""

    def __init__(self):
        self.keys, self.numbers, self.holders = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    def of(self, pairs: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        new = distinct[~known]
        numbers = len(self.keys) + np.arange(len(new))
        self.keys = np.insert(self.keys, at[~known], new)
        self.numbers = np.insert(self.numbers, at[~known], numbers)
        self.holders = np.concatenate([self.holders, np.zeros(len(new), np.int64)])
        return self.numbers[np.searchsorted(self.keys, distinct)][inverse]

    def hold(self, numbers: np.ndarray) -> None:
        """Each number is held by one document more."""
        self.holders += np.bincount(numbers, minlength=len(self.holders))

    def row(self, block: int) -> tuple:
        pairs = np.empty_like(self.keys)
        pairs[self.numbers] = self.keys
        return (None,) * 6 + (block, None, pairs, self.holders.astype(np.int32))


def align_texts(tools: Tokenizers, texts: list[str | None], numbers: PairNumbers) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, cells) of each text; cells are numbered pairs and how often linked."""
    ids = tools.ids(texts)
    counts = np.array([[len(a), len(b)] for a, b in ids], np.int64).reshape(-1, 2)
    a, b = (np.concatenate([x[k] for x in ids]).astype(np.int64) if ids else np.zeros(0, np.int64) for k in (0, 1))
    ends_a, ends_b = np.cumsum(tools.size_a[a]), np.cumsum(tools.size_b[b])
    i, j, common = overlaps(ends_a, ends_b)
    upto = np.cumsum(counts, axis=0)
    document = np.searchsorted(upto[:, 0], i, side="right")
    n_links = np.bincount(document, minlength=len(texts))
    n_groups = np.bincount(document[common], minlength=len(texts))
    text, starts = _spelled(tools, a, b, i[common], j[common])
    # a document's cells: its distinct pair numbers, ascending, and how often each
    cells, often = np.unique(document << 32 | numbers.of(a[i] << 32 | b[j]), return_counts=True)
    numbers.hold(cells & 0xFFFFFFFF)
    cuts = np.searchsorted(cells, np.arange(len(texts) + 1) << 32)
    cells &= 0xFFFFFFFF
    out = []
    for d, (n_a, n_b) in enumerate(counts.tolist()):
        lo, hi = int(cuts[d]), int(cuts[d + 1])
        packed = planes(np.concatenate([np.diff(cells[lo:hi], prepend=0), often[lo:hi]]))
        numbers.bytes += len(packed)
        first, last = upto[d] - counts[d], upto[d]
        groups = text[starts[first.sum()]:starts[last.sum()] - 1] if n_a else b""
        out.append((n_a, n_b, int(n_groups[d]), int(n_links[d]), groups.decode(), packed))
    return out


def _spelled(tools: Tokenizers, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray):
    """The groups as text, and where each token starts in it (groups in a row: A's tokens, then B's)."""
    code = np.empty(len(a) + len(b), np.int64)
    for ids, last, other, base in ((a, last_a, np.r_[-1, last_b], 0), (b, last_b, last_a, 2 * len(tools.bytes_a))):
        mine = 2 * ids
        mine[last] += 1
        group = np.repeat(np.arange(len(last)), np.diff(last, prepend=-1))
        code[np.arange(len(ids)) + other[group] + 1] = base + mine
    sizes = tools.spelled_size[code]
    text = tools.spelled[code][np.arange(tools.spelled.shape[1]) < sizes[:, None]].tobytes()
    return text, np.concatenate([[0], np.cumsum(sizes)])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          max_pairs: int = 2_000_000) -> DataFrame:
    """One row for each document, and rows of their blocks, for :func:`link_statistics`.

    Document rows: id, n_a, n_b, n_groups, n_links, ``groups`` (ids in order, ``a1,a2|b1;a3|b2,b3``) and
    their cells.  Rows with an array ``pairs`` are blocks, of about ``max_pairs`` distinct pairs at most.  Special strings in texts are plain text.  A
    null or empty text, or one that a tokenizer does not spell byte for byte, has no tokens: zeros and
    ``groups`` ''.  Null and repeated ids and repeated rows are documents of their own.  Extra columns
    are ignored.
    """
    kinds = [pa.int64()] * 5 + [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [f.split()[0] for f in ALIGNED.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, numbers = tokenizers(path_a, path_b), PairNumbers()
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = (batch.column(k).to_pylist() for k in (0, 1))
            lo = size = 0
            for hi, text in enumerate(texts, 1):
                size += len(text or "")
                if size < BATCH and hi < len(texts):
                    continue
                rows = align_texts(tools, texts[lo:hi], numbers)
                yield table([(i, *r[:5], block, r[5], None, None) for i, r in zip(ids[lo:hi], rows)])
                lo, size = hi, 0
                if len(numbers.keys) > max_pairs or numbers.bytes > MAX_CELLS:
                    yield table([numbers.row(block)])
                    numbers, block = PairNumbers(), block + 1
        yield table([numbers.row(block)])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ALIGNED)


def link_statistics(aligned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Document rows of :func:`align` (without ``groups``, with columns added) with n_best and count_sum.

    A pair's count is how many documents hold it linked.  ``count_sum`` adds the counts of a document's
    links, ``n_best`` are its links whose count is the highest of all pairs of their A id.
    """
    stored = staged(aligned.drop("groups"), compression="zstd")
    asked = stored.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("number", "p")) \
                  .select("block", "number", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    counted = asked.withColumn("count", F.sum("holders").over(Window.partitionBy("pair"))) \
                   .withColumn("a", F.shiftrightunsigned("pair", 32).cast("int"))
    best = counted.groupBy("a").agg(F.max("count").alias("highest"))
    # one row for each A id at most: bounded by the vocabulary
    answers = counted.join(F.broadcast(best), "a").select(
        F.col("block").alias("of_block"), "number", "count", (F.col("count") == F.col("highest")).alias("best"))
    docs = stored.filter("pairs IS NULL").drop("pairs", "holders")
    kept = [c for c in docs.columns if c not in ("block", "cells")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", n_best bigint, count_sum bigint"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number = right.column("number").to_numpy()
        count, best = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        count[number] = right.column("count").to_numpy()
        best[number] = right.column("best").to_numpy()
        sums = []
        for cells in left.column("cells"):
            steps, often = np.split(from_planes(cells.as_buffer().to_pybytes()), 2)
            at = np.cumsum(steps)
            sums.append((int((often * best[at]).sum()), int((often * count[at]).sum())))
        n_best, total = zip(*sums) if sums else ((), ())
        return left.select(kept).append_column("n_best", pa.array(n_best, pa.int64())) \
                   .append_column("count_sum", pa.array(total, pa.int64()))

    found = docs.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(run, schema)
    return found.withColumnRenamed("id", id_col)
