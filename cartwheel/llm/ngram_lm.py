"""N-gram language-model scores from sharded Elias-Fano tries.

The model pools counts: with context u v, the word w has

    p(w | u v) = (c(uvw) + a c(vw) + b p(w)) / (c(uv) + a c(v) + b)

(for three words; p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)) over the training
tokens and one unknown word).  It sums to one over w.  A text's log probability
is a sum over its tokens of a numerator, which needs only counts of n-grams that
end in w, less a denominator, which needs only counts of n-grams that end in the
context's last word v.  So every token goes once, with its predecessors, to the
shard of its word; there it meets all occurrences that end in this word, gives
its numerator and, as the context of the next token, the denominator.

A shard builds a trie of reversed n-grams from its training tokens (word, then
predecessors), writes its levels as Elias-Fano and quantised files, maps them,
and looks all its tokens up by successor search.  Shards have about
``shard_tokens`` training tokens whatever the corpus; frequent words are spread
over shards by their predecessor, and their counts, at most a few for each shard,
are broadcast.  What moves is packed: chunks of tokens on the way there, in
which up to ``FREQUENT`` of the commonest words of the corpus have numbers known to all
tasks (one bounded broadcast) and the others a dictionary of their own, and
sums by document on the way back.
"""

from __future__ import annotations

import pickle
import tempfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import raw_bytes, staged
from cartwheel.llm.elias_fano import Trie, build_level, open_level

START, END = 0, 1  # numbers of the marks before and after a text
MARKS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
CHUNK_TOKENS = 2_000_000
FREQUENT = 65_536  # words with numbers that all tasks know: at most so many rows on the driver
COUNTED = 500_000  # distinct words that a counting task holds before it hands them on


def is_held_out(doc_id, folds: int = 5, fold: int = 1) -> bool:
    """By CRC-32 of the id as text; a null id is empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


class Numbers(dict):
    """Words of a chunk, numbered as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 2
        return n

    def hashes(self) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        return np.concatenate([MARKS, np.array([digest(w) for w in self], np.uint64)])


def _pack(thing: dict) -> bytes:
    """Arrays of integers are cut into planes of bytes, which compress apart."""
    out = {}
    for k, v in thing.items():
        if isinstance(v, np.ndarray) and v.dtype.kind == "u" and v.itemsize > 1 and k != "rare":
            v = (v.dtype.str, np.ascontiguousarray(v.view(np.uint8).reshape(-1, v.itemsize).T))
        out[k] = v
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(out, protocol=5))


def _unpack(data: bytes) -> dict:
    out = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return {k: np.ascontiguousarray(v[1].T).view(v[0]).ravel() if isinstance(v, tuple) else v for k, v in out.items()}


class Vocabulary:
    """What all tasks know: the commonest words by falling count, and totals."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, totals: dict, shards: int):
        self.words, self.counts, self.totals, self.shards = words, counts, totals, shards
        self.order = np.argsort(words)
        self.first_rare = 2 + len(words)
        limit = max(1, totals["n"] // (4 * shards))
        self.n_spread = int(np.searchsorted(-counts, -limit, side="left"))  # below 4 for each shard
        self.spread_end = totals["texts"] > limit

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word: START, END, the commonest, or -1."""
        if not len(self.words):
            at = np.full(len(hashes), -1)
        else:
            near = self.order[np.minimum(np.searchsorted(self.words, hashes, sorter=self.order), len(self.words) - 1)]
            at = np.where(self.words[near] == hashes, near + 2, -1)
        at[hashes == MARKS[START]], at[hashes == MARKS[END]] = START, END
        return at

    def is_spread(self, codes: np.ndarray) -> np.ndarray:
        return (codes >= 2) & (codes < 2 + self.n_spread) | (codes == END) & self.spread_end


def unigram_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word hash, n) over the training tokens; the end mark is a word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[bytes, int] = {}
        ends = 0

        def flush() -> pd.DataFrame:
            words = np.concatenate([MARKS[END:], np.array([xxhash.xxh64_intdigest(w) for w in counts], np.uint64)])
            return pd.DataFrame({"word": words.astype(np.int64), "n": [ends, *counts.values()]})

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                if not is_held_out(_id(doc_id)):
                    ends += 1
                    for w in text.lower().split():
                        counts[w] = counts.get(w, 0) + 1
                    if len(counts) > COUNTED:
                        yield flush()
                        counts, ends = {}, 0
        if ends:
            yield flush()

    told = docs.select(F.col(id_col).cast("string").alias("id"), raw_bytes(F.col(text_col)).alias("text"))
    return told.mapInPandas(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _commonest(words: DataFrame, most: int) -> list:
    """Rows of the commonest words, at most ``most``: those above a count that a histogram gives."""
    step = F.floor(8 * F.log2("n"))
    told = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)  # 8 for each doubling
    sizes = np.cumsum([r["count"] for r in told])
    fit = int(np.searchsorted(sizes, most, side="right"))
    return words.filter(step >= told[fit - 1].step).collect() if fit else []


def _id(value) -> str | None:
    return None if value is None or value != value else value


def _chunks(known, order: int):
    """Tokens of all documents as packed rows (shard, chunk, data)."""

    def cut(numbers: Numbers, tokens: list[np.ndarray], ids: list, held: list[bool], chunk: int) -> Iterator[tuple]:
        about, hashes = known.value, numbers.hashes()
        codes = about.codes(hashes)
        sizes = np.array([len(t) for t in tokens])
        word = np.concatenate(tokens)
        doc = np.repeat(np.arange(len(tokens), dtype=np.uint16 if len(tokens) <= 1 << 16 else np.uint32), sizes)
        starts = np.cumsum(sizes) - sizes
        grams = [word]
        for k in range(1, order):  # the k-th predecessor
            back = np.zeros_like(word)
            back[k:] = word[:-k]
            for j in range(k):
                back[np.minimum(starts + j, starts + sizes - 1)] = START
            grams.append(back)
        key = hashes[word]
        if order > 1:
            spread = about.is_spread(codes[word])
            key[spread] ^= hashes[grams[1][spread]] * np.uint64(0x9E3779B97F4A7C15)
        shard = ((key >> np.uint64(20)) % np.uint64(about.shards)).astype(np.int32)
        del key
        by = np.lexsort((word, shard))
        edges = np.searchsorted(shard[by], np.arange(about.shards + 1))
        home = chunk % about.shards  # its row carries the ids
        for s in range(about.shards):
            at = by[edges[s]:edges[s + 1]]
            if not len(at) and s != home:
                continue
            mine = [g[at] for g in grams]
            rare = np.unique(np.concatenate([g[codes[g] < 0] for g in mine]))
            data = {"rare": hashes[rare], "doc": doc[at], "held": np.packbits(np.array(held)), "docs": len(held),
                    "ids": ids if s == home else None}
            for k, g in enumerate(mine):
                code = codes[g]
                code[code < 0] = about.first_rare + np.searchsorted(rare, g[code < 0])
                data[f"g{k}"] = code.astype(np.uint32)
            yield s, chunk, _pack(data)

    def rows(*chunk) -> Iterator[pd.DataFrame]:
        for row in cut(*chunk):
            yield pd.DataFrame([row], columns=["shard", "chunk", "data"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 24, 0
        numbers, tokens, ids, held, size = Numbers(), [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                words = text.lower().split()
                found = np.empty(len(words) + 1, np.int32)
                found[:-1] = list(map(numbers.__getitem__, words))
                found[-1] = END
                tokens.append(found)
                ids.append(_id(doc_id))
                held.append(is_held_out(ids[-1]))
                size += len(found)
                if size >= CHUNK_TOKENS:
                    yield from rows(numbers, tokens, ids, held, base + made)
                    made += 1
                    numbers, tokens, ids, held, size = Numbers(), [], [], [], 0
        if tokens:
            yield from rows(numbers, tokens, ids, held, base + made)

    return run


def _shard_trie(folder: Path, grams: list[np.ndarray], seen: np.ndarray, unigram: np.ndarray, counts: np.ndarray,
                pool: tuple[float, ...]) -> Trie:
    """Write and map the trie of distinct training n-grams, sorted, with their counts ``seen``.

    Tables of a level: "num", log10 of the numerator if the n-gram is the longest
    known, and "den", of the denominator if it is the longest known context.
    ``unigram`` is the numerator of each word by itself.
    """
    order, weights = len(grams), [*pool[1:], 1.0]  # weight of the counts of n-grams of 1, 2, ... words
    new = np.zeros(len(seen), bool)  # first of its prefix
    new[:1] = True
    parent = np.zeros(len(seen), np.int64)
    n_parents, numerator, context = 1, np.zeros(1), np.array([pool[0]])
    for k in range(order):
        new[1:] |= grams[k][1:] != grams[k][:-1]
        at = np.flatnonzero(new)
        words, of = grams[k][at].astype(np.int64), parent[at]
        total = np.add.reduceat(seen, at).astype(np.float64) if len(at) else np.zeros(0)
        num = unigram[words] if k == 0 else numerator[of] + weights[k - 1] * total
        tables, den = {"num": np.log10(num)}, context
        if k < order - 1:
            den = context[of] + weights[k] * (counts[words] if k == 0 else total)
            tables["den"] = np.log10(den)
        build_level(folder / str(k), of, words, n_parents, tables)
        parent = np.cumsum(new) - 1
        n_parents, numerator, context = len(at), num, den
    return Trie([open_level(folder / str(k)) for k in range(order)])


def _score_shard(known, order: int, pool: tuple[float, ...]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        about = known.value
        parts = [_unpack(d) for d in group["data"]]
        rare = np.unique(np.concatenate([p["rare"] for p in parts]))
        n_words = about.first_rare + len(rare)

        def numbers(p: dict, k: int) -> np.ndarray:
            own = np.searchsorted(rare, p["rare"]) + about.first_rare
            code = p.pop(f"g{k}").astype(np.int32)
            own_rare = code >= about.first_rare
            code[own_rare] = own[code[own_rare] - about.first_rare]
            return code

        grams = [np.concatenate([numbers(p, k) for p in parts]) for k in range(order)]
        held = np.concatenate([np.unpackbits(p["held"])[p["doc"]] for p in parts]).astype(bool)
        if n_words ** order < 1 << 62:
            codes = grams[0].astype(np.int64)
            for g in grams[1:]:
                codes = codes * n_words + g
            by = np.argsort(codes)
            del codes
        else:
            by = np.lexsort(grams[::-1])
        # distinct n-grams in order: each is looked up once
        new = np.zeros(len(by), bool)
        new[:1] = True
        for g in grams:
            ordered = g[by]
            new[1:] |= ordered[1:] != ordered[:-1]
        same = np.empty(len(by), np.int32)
        same[by] = np.cumsum(new) - 1
        grams = [g[by[new]] for g in grams]
        seen = np.bincount(same[~held], minlength=len(grams[0]))
        del by, new, held
        counts = np.zeros(n_words)
        np.add.at(counts, grams[0], seen)
        counts[START], counts[END], counts[2:about.first_rare] = 0, about.totals["texts"], about.counts
        base = about.totals["n"] + 0.5 * (about.totals["v"] + 1)
        c = counts[grams[0]]
        num = np.log10(pool[0] * (c + 0.5) / base)  # for words that the shard's trie lacks
        den = np.log10(pool[0] + (([*pool[1:], 1.0][0] * c) if order > 1 else 0.0 * c))
        with tempfile.TemporaryDirectory() as folder:
            trained = seen > 0
            trie = _shard_trie(Path(folder), [g[trained] for g in grams], seen[trained],
                               pool[0] * (counts + 0.5) / base, counts, pool)
            for k, (level, at) in enumerate(zip(trie.levels, trie.search([g.astype(np.int64) for g in grams]))):
                there = at >= 0
                num[there] = level.look_up("num", at[there])
                if k < order - 1:
                    den[there] = level.look_up("den", at[there])
        den[grams[0] == END] = 0.0  # nothing follows the end
        plain, gain, met = np.log10((c + 0.5) / base), num - den, (c > 0).astype(float)
        out, lo = [], 0
        for p, chunk in zip(parts, group["chunk"]):
            at = same[lo:lo + len(p["doc"])]
            lo += len(at)
            docs, local = np.unique(p["doc"], return_inverse=True)
            add = lambda x: np.bincount(local, x[at], len(docs))
            out.append((chunk, _pack({
                "at": docs, "n_tokens": np.bincount(local, minlength=len(docs)).astype(np.uint32),
                "n_known": add(met).astype(np.uint32), "base": add(plain), "score": add(gain).astype(np.float32),
                "size": p["docs"], "ids": p["ids"], "held": p["held"] if p["ids"] is not None else None})))
        return pd.DataFrame(out, columns=["chunk", "data"])

    return run


def _gather(first_context: float, train_tokens: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sums, ids, held = {}, None, None
        for data in group["data"]:
            p = _unpack(data)
            for k in ("n_tokens", "n_known", "base", "score"):
                sums.setdefault(k, np.zeros(p["size"]))[p["at"]] += p[k]
            if p["ids"] is not None:
                ids, held = p["ids"], p["held"]
        return pd.DataFrame({
            "id": pd.array(ids, dtype="string"), "held_out": np.unpackbits(held, count=len(ids)).astype(bool),
            "n_tokens": sums["n_tokens"].astype(np.int64), "n_known": sums["n_known"].astype(np.int64),
            "train_tokens": train_tokens, "base_score": sums["base"], "score": sums["score"] - first_context})

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3,
          pool: tuple[float, ...] = (5.0, 0.02), shard_tokens: int = 1_500_000,
          frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the words of the whole text and its end;
    ``base_score`` is the unigram's, ``score`` the model's.  ``pool`` has b and
    the weights of shorter n-grams, shortest first (``order - 1`` numbers).  The
    model learns from rows that are not held out (CRC-32 of the id).  A null or
    empty text has one token, its end.  A null id counts as empty text for the
    fold and stays null.  Repeated rows count and are scored each.  Extra columns
    are ignored.  Without training rows every word is unknown.  Empty in, empty out.
    """
    if len(pool) != max(order - 1, 1):
        raise ValueError("pool needs one weight for each shorter order")
    spark = docs.sparkSession
    words = staged(unigram_counts(docs, id_col, text_col))
    end = int(MARKS[END].astype(np.int64))
    n, v, texts = words.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("word") == end, F.col("n")))).first()
    totals = {"n": n or 0, "v": v, "texts": texts or 0}
    common = sorted(_commonest(words.filter(F.col("word") != end), frequent), key=lambda r: (-r.n, r.word))
    about = Vocabulary(np.array([r.word for r in common], np.int64).astype(np.uint64),
                       np.array([r.n for r in common], np.int64), totals, max(1, -(-totals["n"] // shard_tokens)))
    known = spark.sparkContext.broadcast(about)
    told = docs.select(F.col(id_col).cast("string").alias("id"), raw_bytes(F.col(text_col)).alias("text"))
    sent = told.mapInPandas(_chunks(known, order), "shard bigint, chunk bigint, data binary")
    scored = sent.groupBy("shard").applyInPandas(_score_shard(known, order, pool), "chunk bigint, data binary")
    # every text starts in the same context, with the counts of all training texts
    weights = [*pool[1:], 1.0][:order - 1] if order > 1 else []
    first = float(np.log10(pool[0] + sum(weights) * totals["texts"]))
    of = docs.schema[id_col].dataType.simpleString()
    return scored.groupBy("chunk").applyInPandas(
        _gather(first, totals["n"]), "id string, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double") \
        .select(F.col("id").cast(of).alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens",
                "base_score", "score")
