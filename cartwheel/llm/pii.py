"""Personal data: base patterns, and a conditional random field over word shapes.

The patterns find e-mail and IP addresses, card numbers that pass Luhn and
international phone numbers.  The field is trained on a small labelled table
(``labelled_table`` or the caller's own) and decoded by Viterbi over the lines
of each batch of documents; it adds spans that the patterns cannot express
(national phone and identity numbers, spelled-out addresses, titled names).  A
span of the field is kept only if it overlaps no base span and its label beats
O by ``margin`` in log score.
"""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import raw_bytes
from cartwheel.llm.crf import Crf, shape

BASE_KINDS = ("email", "ip", "card", "phone")
FIELD_KINDS = ("crf_email", "crf_id", "crf_name", "crf_phone")
ORDER = {k: i for i, k in enumerate(BASE_KINDS + FIELD_KINDS)}

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, looked for around each @ only."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        m = _EMAIL.match(text, first) if first < at else None
        if m:
            done = m.end()
            out.append(m.span())
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind as listed."""
    out = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]], s[2]))


# The templates of the labelled table.  {kind:...} is an entity whose
# words follow; # is a digit, and the lists below fill @, first and last names.
_TEMPLATES = (
    "{crf_phone:(###) ###-####}", "{crf_phone:###-###-####}", "{crf_phone:### ### ####}", "{crf_phone:###.###.####}",
    "call {crf_phone:(###) ###-####}", "phone {crf_phone:###-###-####}", "tel {crf_phone:### ### ####}",
    "{crf_id:###-##-####}", "ssn {crf_id:###-##-####}", "number {crf_id:### ## ####}",
    "{crf_email:FIRST (at) HOST (dot) com}", "{crf_email:FIRST [at] HOST [dot] org}",
    "email {crf_email:FIRST at HOST dot com}", "contact {crf_email:FIRST at HOST dot net}",
    "Mr. {crf_name:FIRST LAST}", "Mrs. {crf_name:FIRST LAST}", "Dr. {crf_name:FIRST LAST}", "Ms. {crf_name:LAST}",
    "Mr. {crf_name:LAST}", "name: {crf_name:FIRST LAST}",
)
_NEUTRAL = (
    "version #.", "version #.#", "#.#.", "4.0.", "in ####", "####", "##", "#", "##%", "$##.##", "##:##", "####-##-##",
    "##/##/####", "AKIAX#XXX#XX##XXXX##", "password=x#xx##xx###x#x##x#", "token", "\"##x#x##xx###x#xx#####x#xx##x\"",
    "page ##", "chapter #", "+# (###) ###-####", "###.##.###.##", "xxxx.##@xxxx#.xxxx.com", "################",
    "#### #### #### ####", "####-####-####-####", "https://xxx.xxxxx.org/##/xx", "no. ##", "###", "#,###", "###,###",
    "at", "the dot", "by mail", "Xxx Xxxx", "Xxxxx. Xxx", "x|x", "%%%", "***", "|", "and###", "xxx&&&",
    "##xx##", "########", "#####", "######", "(##)", "[#]", "##.", "####.", "Xxxx", "Xxxxxx xx Xxxx",
    "Xx. Xxxxx", "Xx. Xxxxxx Xxxx xx", "Xxx. Xxxx. Xxxxx", "xx. Xxxxxxx.", "Xxxxx. Xxxxx. Xxxxx", "Xxxxxx. Xxxx xxx",
)
_FIRST = ("Ann", "John", "Maria", "Peter", "Laura", "David", "Sofia", "James", "Elena", "Mark")
_LAST = ("Smith", "Garcia", "Miller", "Brown", "Dupont", "Weber", "Lopez", "Clark", "Moreau", "Fischer")
_SYLLABLES = ("an", "be", "con", "der", "el", "fi", "ga", "ho", "in", "ka", "lo", "men", "no", "or", "pa", "re",
              "st", "th", "un", "ve", "é", "ü", "ción", "ß")


def labelled_table(rows: int = 1200, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """(words, labels) sequences made by rule: entities and look-alikes among invented words."""
    pick = random.Random(seed)

    def word() -> str:
        made = "".join(pick.choice(_SYLLABLES) for _ in range(pick.randint(1, 4)))
        made = made.capitalize() if pick.random() < 0.25 else made
        return made + (pick.choice(".,;") if pick.random() < 0.12 else "")

    def fill(pattern: str) -> str:
        pattern = pattern.replace("FIRST", pick.choice(_FIRST)).replace("LAST", pick.choice(_LAST)) \
                         .replace("HOST", word().strip(".,;").lower())
        return "".join(str(pick.randint(0, 9)) if c == "#" else c for c in pattern)

    def letters(pattern: str) -> str:
        return "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") if c == "x"
                       else pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c == "X" else c for c in fill(pattern))

    out = []
    for k in range(rows):
        words, tags = [], []

        def plain(text: str) -> None:
            words.extend(text.split())
            tags.extend(["O"] * (len(words) - len(tags)))

        plain(" ".join(word() for _ in range(pick.randint(0, 6))))
        if k % 2:
            plain(letters(pick.choice(_NEUTRAL)))
        else:
            before, kind, entity = re.fullmatch(r"(.*)\{(\w+):(.*)\}", pick.choice(_TEMPLATES)).groups()
            plain(before)
            for i, w in enumerate(fill(entity).split()):
                words.append(w)
                tags.append(("B-" if i == 0 else "I-") + kind)
            if pick.random() < 0.3:
                words[-1] += pick.choice(".,;")
        plain(" ".join(word() for _ in range(pick.randint(0, 6))))
        if words:
            out.append((words, tags))
    return out


def train(table: list[tuple[list[str], list[str]]], rounds: int = 100) -> Crf:
    kinds = sorted({t[2:] for _, tags in table for t in tags if t != "O"})
    return Crf(["O", *(f"{p}-{k}" for k in kinds for p in "BI")]).fit(table, rounds)


class Tagger:
    """Decodes texts with a fitted field; keeps the votes of words it has met.

    Words with equal shape (and equal letters, if the field knows them) share
    their votes, so there are few rows of votes however many words.
    """

    CACHE, CHUNK, BLOCK = 200_000, 100_000, 100_000

    def __init__(self, field: Crf, margin: float = 2.0):
        self.field, self.margin = field, margin
        self.number: dict[bytes, int] = {}  # word -> row of votes
        self.row: dict[tuple, int] = {}  # shape and known letters -> row of votes
        self.votes = np.zeros((256, 3, len(field.labels)))
        self.gain = np.zeros((256, 3))  # the most by which a vote favours another label over O

    def _new_row(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        lower = text.lower().rstrip(".,;:!?")
        key = (shape(text), lower if lower in self.field.known else None)
        if key not in self.row:
            n = len(self.row)
            if n == len(self.votes):
                self.votes = np.concatenate([self.votes, np.zeros_like(self.votes)])
                self.gain = np.concatenate([self.gain, np.zeros_like(self.gain)])
            self.votes[n] = self.field.word_scores(text)
            self.gain[n] = self.votes[n, :, 1:].max(axis=1) - self.votes[n, :, 0]
            self.row[key] = n
        return self.row[key]

    def _rows(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > self.CACHE or len(self.row) > self.CACHE // 2:
            self.number.clear()  # between calls only: a call's numbers stay valid until it ends
            self.row.clear()
        for w in {w for w in words if w not in self.number}:
            self.number[w] = self._new_row(w)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def lines(self, texts: list[bytes]) -> list[tuple[int, int, np.ndarray]]:
        """(text, first word, emissions) of the lines in which some word could be labelled.

        A bound on what each word's neighbourhood can gain over O leaves out the
        lines that decode to O throughout.
        """
        out, block = [], ([], [], [], [])
        for i, text in enumerate(texts):
            n = 0
            for line in text.split(b"\n"):
                found = line.split()
                if found:
                    words, starts, owner, first = block
                    starts.append(len(words))
                    owner.append(i)
                    first.append(n)
                    n += len(found)
                    words += found
                    if len(words) >= self.BLOCK:  # however long a text is, its words are taken in blocks
                        out += self._active(*block)
                        block = ([], [], [], [])
        return out + self._active(*block)

    def _active(self, words: list[bytes], starts: list[int], owner: list[int], first: list[int]) -> list:
        if not words:
            return []
        at = self._rows(words)
        bound = self.gain[at, 0]
        after, before = self.gain[at[:-1], 1], self.gain[at[1:], 2]
        within = np.ones(len(at), bool)
        within[starts] = False  # first words of lines have none before them
        bound[1:] += np.where(within[1:], after, 0)
        bound[:-1] += np.where(within[1:], before, 0)
        active = np.flatnonzero(bound + self.field.slack > 0)
        ends, out = [*starts[1:], len(words)], []
        for k in np.unique(np.searchsorted(starts, active, side="right") - 1):
            emit = self.field.emissions(self.votes[at[starts[k]:ends[k]]])
            if self.field.could_label(emit).any():
                out.append((owner[k], first[k], emit))
        return out

    def entities(self, emit: np.ndarray, tags: np.ndarray) -> list[tuple[str, int, int]]:
        """(kind, first, past-the-last word) of the runs that beat O by the margin."""
        out, labels, moves, t = [], self.field.labels, self.field.moves, 0
        while t < len(tags):
            if tags[t] == 0:
                t += 1
                continue
            end = t + 1
            while end < len(tags) and labels[tags[end]] == "I" + labels[tags[t]][1:]:
                end += 1
            path = [0] * (t > 0) + list(tags[t:end]) + [0] * (end < len(tags))
            gain = sum(emit[i, tags[i]] - emit[i, 0] for i in range(t, end)) \
                + sum(moves[a, b] - moves[0, 0] for a, b in zip(path, path[1:]))
            if gain >= self.margin and labels[tags[t]][0] == "B":
                out.append((labels[tags[t]][2:], t, end))
            t = end
        return out

    def find(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """All spans of each text, base spans first found, field spans that touch none added."""
        queue, a = [], 0
        while a < len(texts):  # texts of some CHUNK bytes at a time
            b, size = a, 0
            while b < len(texts) and size < 6 * self.CHUNK:
                size += len(texts[b])
                b += 1
            queue += [(a + i, first, emit) for i, first, emit in self.lines(texts[a:b])]
            a = b
        added: dict[int, list] = {}
        for (i, first, emit), tags in zip(queue, self.field.viterbi([q[2] for q in queue])):
            for kind, a, b in self.entities(emit, tags):
                added.setdefault(i, []).append((kind, first + a, first + b))
        out = []
        for i, raw in enumerate(texts):
            text = raw.decode("utf-8", "replace")
            spans = base_spans(text)
            if i in added:
                at = [m.span() for m in _WORD.finditer(text)]
                base = list(spans)
                for kind, a, b in added[i]:
                    start, end = at[a][0], at[b - 1][1]
                    end = start + len(text[start:end].rstrip(".,;:!?"))
                    if end > start and not any(s < end and start < e for _, s, e in base):
                        spans.append((kind, start, end))
                spans.sort(key=lambda s: (s[1], ORDER.get(s[0], len(ORDER)), s[0], s[2]))
            out.append(spans)
        return out


_TAGGERS: dict[tuple, Tagger] = {}


def _tagger(sent, margin: float) -> Tagger:
    """One tagger for each Python worker and model."""
    key = (id(sent.value), margin)
    if key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[key] = Tagger(sent.value, margin)
    return _TAGGERS[key]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or stretch of overlapping spans, becomes [KIND] of its first."""
    out, done, k = [], 0, 0
    spans = sorted(spans, key=lambda s: s[1])
    while k < len(spans):
        kind, start, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[done:start], f"[{kind.removeprefix('crf_').upper()}]"]
        done = end
    return "".join([*out, text[done:]])


DIGEST = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def _digest(spans: list[tuple[str, int, int]]) -> tuple:
    base = [s for s in spans if s[0] in BASE_KINDS]
    return (*(sum(s[0] == k for s in base) for k in BASE_KINDS),
            hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


@lru_cache(maxsize=1)
def _own_field() -> Crf:
    return train(labelled_table())


def field_from(labelled: DataFrame, max_rows: int = 20_000, rounds: int = 100) -> Crf:
    """A field trained on a labelled table: ``words`` and ``labels``, arrays of strings of equal length.

    At most ``max_rows`` rows are read, those of the least hashes.  Rows with a null, no words or arrays
    of different lengths teach nothing.
    """
    rows = labelled.where("size(words) = size(labels) AND size(words) > 0").select("words", "labels") \
                   .orderBy(F.xxhash64("words", "labels")).limit(max_rows).collect()
    return train([(list(r.words), list(r.labels)) for r in rows
                  if None not in r.words and None not in r.labels], rounds)


def find_pii(docs: DataFrame, text_col: str = "text", field: Crf | None = None,
             margin: float = 2.0) -> tuple[Column, Column]:
    """Columns over ``docs``: the digest struct, and the redacted text.

    A null text has no spans, and stays null when redacted; an empty one stays
    empty.  The field is trained on ``labelled_table()``, once a process, unless given
    (:func:`field_from` takes a labelled table); it is the only thing sent to the tasks.  Rows are independent, so repeated rows,
    ties and extra columns need no care.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field or _own_field())

    @F.pandas_udf(DIGEST)
    def digest(texts: pd.Series) -> pd.DataFrame:
        found = _tagger(sent, margin).find(list(texts))
        names = [c.split()[0] for c in DIGEST.split(", ")]
        return pd.DataFrame([_digest(s) for s in found], columns=names)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        raw = list(texts)
        found = _tagger(sent, margin).find([b"" if t is None else t for t in raw])
        return pd.Series([None if t is None else t.decode("utf-8", "replace") if not s
                          else redact(t.decode("utf-8", "replace"), s) for t, s in zip(raw, found)], dtype=object)

    return digest(raw_bytes(F.col(text_col))), cleaned(F.col(text_col).cast("binary"))


def redact_documents(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by [KIND]; other columns unchanged."""
    return docs.withColumn(text_col, find_pii(docs, text_col, **how)[1])
