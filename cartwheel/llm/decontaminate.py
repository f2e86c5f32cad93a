"""Benchmark decontamination: word-pair seeds that miss no alignment, then Smith-Waterman.

The benchmark is the stated query set.  It is taken in blocks of bounded size
(``block_words``, by hash of the item), and each block meets all documents:

1. Two words of an item at most ``window`` apart are a seed.  An alignment that
   reaches the score has a least number of matched words whose next match is that
   near in item and document (``sure_starts``): any farther step costs more than
   the matches pay.  Count, over all documents, how many contain each such pair.
2. Of an item's words, the rarest (by the pairs that start there) are seeds, but
   so many that fewer than the least number are left out: every alignment that
   reaches the score holds a seed, however edited and however frequent its words.
   Where no pair is sure (a low score of a short item), single words are seeds.
3. Seeds found in a document give the places where an item may lie, as wide as
   the score allows gaps; where a bound does not rule them out, the words there
   are aligned to the item, and the best local alignment is scored.

A document needs no partner and no shuffle: memory is one batch of documents
and one block of items, and lost tasks are simply run again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import WORD, raw_bytes

MATCH, MISMATCH, GAP = 2, -1, -1
HITS = "array<struct<item_id bigint, score bigint, similarity double, start bigint, end bigint>>"


def sure_starts(size: int, need: float, window: int) -> int:
    """Least number of matched words, in a local alignment of an item of ``size`` words that
    scores ``need``, whose next matched word is at most ``window`` on in item and text.

    Of m matches, each farther step costs ``window`` or more, so there are at most
    (2 m - need) / window of those among the m - 1 steps.
    """
    few = max(1, math.ceil(need / MATCH - 1e-9))
    return max(0, min(math.ceil(m - 1 - (MATCH * m - need) / window - 1e-9) for m in (few, max(few, size))))


class Items:
    """A block of items as arrays of word numbers, and their word pairs as codes.

    Word 0 is any word that the block does not hold, and the second of a single word's code.
    """

    def __init__(self, ids: list, texts: list[bytes], n: int, window: int, min_similarity: float):
        self.window, self.vocabulary, self.ids, self.words = window, {}, [], []
        for item_id, text in zip(ids, texts):
            words = text.lower().split()
            if len(words) < n:
                continue
            self.ids.append(item_id)
            self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
                                        for w in words], np.int64))
        self.base = len(self.vocabulary) + 1
        if self.base ** 2 >= 1 << 62:
            raise ValueError("block_words is too large for word pairs of 64 bits")
        self.mark = np.zeros(self.base, bool)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        needs = [min_similarity * MATCH * len(w) for w in self.words]
        self.gaps = np.array([int(MATCH * len(w) - need) + 1 for w, need in zip(self.words, needs)], np.int64)
        grams, owner, at, self.spare = [], [], [], []  # spare: starts of the item that need not be seeds
        for k, (words, need) in enumerate(zip(self.words, needs)):
            sure = sure_starts(len(words), need, window)
            steps = range(1, window + 1) if sure else (0,)
            self.spare.append((sure or max(1, math.ceil(need / MATCH - 1e-9))) - 1)
            for d in steps:
                codes = self.codes(words, d)
                grams.append(codes)
                owner.append(np.full(len(codes), k))
                at.append(np.arange(len(codes)))
        self.singles = any((g % self.base == 0).any() for g in grams)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        self.grams, self.gram_of = np.unique(cat(grams), return_inverse=True)
        self.owner, self.at = cat(owner), cat(at)

    def codes(self, words: np.ndarray, step: int) -> np.ndarray:
        """Codes of each word with the one ``step`` on, or of single words."""
        return words[:-step] * self.base + words[step:] if step else words * self.base

    def read(self, text: bytes) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in text.lower().split()], np.int64)

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``words`` of known pairs, and the pairs' numbers."""
        places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(self.grams):
            known = words > 0
            for d in range(0 if self.singles else 1, self.window + 1):
                at = np.flatnonzero(known[:-d] & known[d:] if d else known)
                codes = words[at] * self.base + (words[at + d] if d else 0)
                near = np.searchsorted(self.grams, codes)
                near[near == len(self.grams)] = 0
                same = self.grams[near] == codes
                places.append(at[same])
                found.append(near[same])
        return np.concatenate(places), np.concatenate(found)

    def seed(self, counts: np.ndarray) -> None:
        """Keep as seeds the pairs of each item's rarest words, all but its spare ones."""
        rarity = counts[self.gram_of]
        keep = np.ones(len(self.at), bool)
        bounds = np.searchsorted(self.owner, np.arange(len(self.words) + 1))
        for k, spare in enumerate(self.spare):
            a, b = bounds[k], bounds[k + 1]
            of_start = np.bincount(self.at[a:b], rarity[a:b])
            left_out = np.zeros(len(of_start), bool)
            left_out[np.argsort(of_start, kind="stable")[len(of_start) - spare:]] = True
            keep[a:b] = ~left_out[self.at[a:b]]
        kept = np.flatnonzero(keep)
        self.grams, gram_of = np.unique(self.grams[self.gram_of[kept]], return_inverse=True)
        by_gram = np.argsort(gram_of, kind="stable")
        self.post_owner, self.post_at = self.owner[kept][by_gram], self.at[kept][by_gram]
        self.post_from = np.searchsorted(gram_of[by_gram], np.arange(len(self.grams) + 1))
        self.gram_of = self.owner = self.at = None

    def places(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, from, to): stretches of ``words`` in which a seeded item may lie."""
        pos, gram = self.hits(words)
        count = self.post_from[gram + 1] - self.post_from[gram]
        total = int(count.sum())
        if not total:
            return
        nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        post = np.repeat(self.post_from[gram], count) + nth
        owner, start = self.post_owner[post], np.repeat(pos, count) - self.post_at[post]
        order = np.lexsort((start, owner))
        owner, start = owner[order], start[order]
        sizes, slack = self.sizes[owner], self.gaps[owner]
        lo, hi = np.maximum(start - slack, 0), np.minimum(start + sizes + slack, len(words))
        new = np.ones(total, bool)  # stretches of an item that overlap are joined
        new[1:] = (owner[1:] != owner[:-1]) | (lo[1:] > hi[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], total) - 1
        yield from zip(owner[first].tolist(), lo[first].tolist(), hi[last].tolist())

    def bound(self, k: int, words: np.ndarray) -> int:
        """The most that item k can score in ``words``: its words there match, all others cost."""
        self.mark[self.words[k]] = True
        sums = np.cumsum(np.append(0, np.where(self.mark[words], MATCH, GAP)))
        self.mark[self.words[k]] = False
        return int((sums - np.minimum.accumulate(sums)).max())


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, first, past-the-last position in ``words``)."""
    steps = np.arange(len(words) + 1) * -GAP
    table = np.zeros((len(item) + 1, len(words) + 1), np.int64)
    for i, word in enumerate(item, 1):
        above = table[i - 1]
        best = np.zeros(len(words) + 1, np.int64)
        best[1:] = np.maximum(above[:-1] + np.where(words == word, MATCH, MISMATCH), above[1:] + GAP)
        np.maximum(best, 0, out=best)
        table[i] = np.maximum.accumulate(best + steps) - steps  # gaps in the item
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end = int(table[i, j]), int(j)
    while table[i, j] > 0:
        step = MATCH if words[j - 1] == item[i - 1] else MISMATCH
        if table[i, j] == table[i - 1, j - 1] + step:
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end


def find_items(items: Items, text: bytes, min_similarity: float) -> list[tuple]:
    """Each item's best alignment in the text, if similar enough."""
    words, best = items.read(text), {}
    for k, lo, hi in items.places(words):
        item = items.words[k]
        need = min_similarity * MATCH * len(item)
        for a in range(lo, hi, 20 * len(item)):  # a long stretch in parts that overlap by the longest alignment
            part = words[a:min(hi, a + 23 * len(item))]
            if items.bound(k, part) < need:
                continue
            score, first, end = align(item, part)
            if score >= need and score > best.get(k, (0,))[0]:
                best[k] = (score, a + first, a + end)
    return [(items.ids[k], s, s / (MATCH * len(items.words[k])), a, b)
            for k, (s, a, b) in sorted(best.items())]


def _blocks(benchmark: DataFrame, block_words: int, n: int, window: int, min_similarity: float, id_col: str,
            text_col: str) -> Iterator[Items]:
    items = benchmark.filter(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()) \
                     .select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).distinct()
    words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    blocks = -(-words // block_words)
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) \
                     .orderBy("id", "text").select("id", raw_bytes("text").alias("text")).collect()
        yield Items([r.id for r in block], [bytes(r.text) for r in block], n, window, min_similarity)


def _document_counts(docs: DataFrame, items, text_col: str, size: int) -> np.ndarray:
    """Documents that contain each word pair of the block, over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, block = np.zeros(size, np.int64), items.value
        for batch in batches:
            for text in batch["text"]:
                counts[np.unique(block.hits(block.read(text))[1])] += 1
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"gram": at, "n": counts[at]})

    counted = docs.select(raw_bytes(F.col(text_col)).alias("text")) \
                  .mapInPandas(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in counted.toLocalIterator():  # one row for each word pair of the block at most
        out[row.gram] = row.n
    return out


def _finder(sent, min_similarity: float):
    names = ("item_id", "score", "similarity", "start", "end")

    @F.pandas_udf(HITS)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, hit)) for hit in find_items(sent.value, t, min_similarity)]
                          for t in texts], dtype=object)

    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", n: int = 3, window: int = 2,
                   min_similarity: float = 0.5, block_words: int = 1_000_000) -> Column:
    """Column over ``docs``: array of (item_id, score, similarity, start, end).

    One entry for each item whose best alignment reaches ``min_similarity`` of
    the score of an exact copy; start and end count words of the text.  Null or
    empty texts have none.  Items with null id or text, or of fewer than ``n``
    words, match nothing; equal items count once, different texts of one id are
    items of their own.  An empty benchmark finds nothing.  Whatever the
    ``window``, no alignment that reaches the score is left out; it is how far apart
    the two words of a seed may be.  ``docs`` is read once for each block to count
    word pairs, before this returns.
    """
    spark, found = docs.sparkSession, []
    for block in _blocks(benchmark, block_words, n, window, min_similarity, item_col, item_text_col):
        counts = _document_counts(docs, spark.sparkContext.broadcast(block), text_col, len(block.grams))
        block.seed(counts)
        sent = spark.sparkContext.broadcast(block)
        found.append(_finder(sent, min_similarity)(raw_bytes(F.col(text_col))))
    return F.concat(*found) if found else F.array().cast(HITS)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """(id, item_id, score, similarity, start, end): one row per row of ``docs`` and item found."""
    hits = docs.select(F.col(id_col), F.explode(benchmark_hits(docs, benchmark, **how)).alias("hit"))
    return hits.select(id_col, "hit.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Rows of ``docs`` in which no item is found; columns unchanged."""
    return docs.filter(F.size(benchmark_hits(docs, benchmark, **how)) == 0)
