"""Token ids of whole texts by public tokenizers, at the cost of their distinct words.

A byte-pair tokenizer with a word rule never merges across a word's border, so a
text's ids are those of its words in a row.  Arrow numbers the words of some
megabytes of text, and the ids of the distinct ones are gathered by number.  A
worker keeps those it has met (``CACHE`` at most, then it starts anew).
Of the others, plain words take the vocabulary's merges alone, and all that the
tokenizer's normaliser or word rule may change goes through the tokenizer.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

CACHE = 500_000
LONG = 256  # longer words are encoded, not kept
WORD_END = "</w>"
# One sign of ASCII between a letter or digit of ASCII and white space: the word rule parts it from the word.
TAIL = r"([a-z0-9])([!-&(-/:-@\[-`{-~][\x20\x09-\x0d])"
SLICE = 1 << 22  # bytes of text at a time, or one text
STABLE = "԰"  # letters of Latin, Greek and Cyrillic lie below: every Unicode version has them alike


@lru_cache(maxsize=4)
def hub_tokenizer(path: str, plain_specials: bool = False):
    """A tokenizer file, once a process; special strings are plain text if ``plain_specials``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


def byte_alphabet() -> dict[int, str]:
    """Byte -> character of byte-level vocabularies: printable bytes stand for themselves, others follow 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Merges:
    """The merges of a byte-level vocabulary with word ends, applied to words by their ranks.

    A word's symbols are its bytes, the last one marked: byte b is written U+0100 + b, a marked one
    U+0200 + b.  Ids of merged tokens ascend in the order of the merges, or ``usable`` is false.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of, vocab = {c: b for b, c in byte_alphabet().items()}, model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab["".join(m)] for m in merges]
        self.usable = model.get("end_of_word_suffix") == WORD_END and made == sorted(made) \
            and all(vocab[c + end] < min(made, default=0) for c in byte_of for end in ("", WORD_END))
        ranks = {bytes([b]): len(vocab) + 256 + b for b in range(256)}  # never the result: every symbol has a rank
        for token, number in vocab.items() if self.usable else ():
            symbols = [byte_of.get(c) for c in token.removesuffix(WORD_END)]
            if symbols and None not in symbols:
                last = symbols.pop() + (0x200 if token.endswith(WORD_END) else 0x100)
                ranks["".join([*(chr(0x100 + b) for b in symbols), chr(last)]).encode()] = number
        self.coder = tiktoken.Encoding("words", pat_str="[Ā-ǿ]*[Ȁ-˿]", special_tokens={},
                                       mergeable_ranks=ranks) if self.usable else None
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True

    def takes(self, raw: bytes) -> bool:
        """Lower-case composed letters: the normaliser leaves them, and the word rule keeps them together."""
        word = raw.decode() if len(raw) <= LONG else ""
        return word.isalpha() and max(word) < STABLE and word == word.lower() \
            and unicodedata.is_normalized("NFC", word)

    def of(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as little-endian 32-bit bytes."""
        symbols = np.frombuffer(b"".join(words), np.uint8).astype("<u4") + 0x100
        symbols[np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) - 1] += 0x100
        ids = np.array(self.coder.encode_ordinary(symbols.tobytes().decode("utf-32-le")), "<u4")
        data, ends = ids.tobytes(), [0, *(np.flatnonzero(self.closes[ids]) + 1).tolist()]
        return [data[4 * lo:4 * hi] for lo, hi in zip(ends, ends[1:])]


class WordIds:
    """Ids of texts under a lower-casing tokenizer that drops white space, as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer, self.merges, self.known = hub_tokenizer(path), Merges(path), {}

    def _by_file(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        data, ends = np.array(list(chain.from_iterable(ids)), "<u4").tobytes(), [0, *accumulate(map(len, ids))]
        return [data[4 * lo:4 * hi] for lo, hi in zip(ends, ends[1:])]

    def _encode(self, words: list[bytes], plain: list[bool]) -> dict[bytes, bytes]:
        """Ids of the words not known yet; ``plain`` ones are surely taken by the merges."""
        known, usable = self.known, self.merges.usable
        short = [w for w, p in zip(words, plain) if p and w not in known] if usable else []
        rest = [w for w, p in zip(words, plain) if not (p and usable) and w not in known]
        takes = set(filter(self.merges.takes, rest)) if usable else set()
        short += takes
        others = [w for w in rest if w not in takes]
        ids = dict(zip(others, self._by_file([w.decode() for w in others])))
        if short:
            ids.update(zip(short, self.merges.of(short)))
        return ids

    def of(self, texts: pa.Array, end: int | None = None) -> Iterator[pa.Array]:
        """Ids of UTF-8 texts (null is empty), each followed by ``end``, as binary arrays in order."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE, side="right")))
            yield self._slice(pc.fill_null(texts.slice(lo, hi - lo), ""), end)
            lo = hi

    def _slice(self, texts: pa.Array, end: int | None) -> pa.Array:
        # a text that may hold a special string is one word, encoded as it is
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(
            pc.ascii_lower(pc.if_else(special, "", texts)), pattern=TAIL, replacement=r"\1 \2"))
        words = split.flatten().dictionary_encode()
        spelled = words.dictionary
        plain = pc.and_(pc.ascii_is_alpha(spelled), pc.less_equal(pc.binary_length(spelled), LONG))
        distinct = spelled.cast(pa.binary()).to_pylist()
        if len(self.known) > CACHE:
            self.known = {}
        ids = self._encode(distinct, plain.to_pylist())
        parts = [ids[w] if w in ids else self.known[w] for w in distinct]
        self.known.update(ids if max(map(len, ids), default=0) <= LONG
                          else ((w, v) for w, v in ids.items() if len(w) <= LONG))
        code = words.indices.to_numpy()
        ends = split.offsets.to_numpy()[1:]
        if pc.any(special).as_py():  # each such text's ids are a part of its own
            at = np.flatnonzero(special.to_numpy(zero_copy_only=False))
            own = self._by_file(texts.take(pa.array(at)).to_pylist())
            code = np.insert(code, ends[at], len(parts) + np.arange(len(at)))
            ends = ends + np.searchsorted(at, np.arange(len(texts)), side="right")
            parts += own
        if end is not None:
            code = np.insert(code, ends, len(parts))
            ends = ends + np.arange(1, len(texts) + 1)
            parts.append(end.to_bytes(4, "little"))
        flat = np.frombuffer(b"".join(parts), "<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        n = size[code]
        upto = np.cumsum(n)
        shift = (np.cumsum(size) - size)[code] - (upto - n)
        kind = np.int32 if max(len(flat), int(upto[-1]) if len(upto) else 0) < 1 << 31 else np.int64
        at = np.repeat(shift.astype(kind), n)
        at += np.arange(len(at), dtype=kind)
        out = flat[at]
        offsets = np.concatenate([[0], np.concatenate([[0], upto])[ends]]) * 4
        return pa.Array.from_buffers(pa.large_binary(), len(texts),
                                     [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
