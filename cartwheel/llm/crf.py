"""A linear-chain conditional random field over word shapes, in numpy.

Each word votes for its own label and, through features of its shape, for the
labels of its neighbours; a transition matrix joins labels in a row.  Weights
maximise the regularised log-likelihood of a small labelled table.  Decoding is
Viterbi over batches of sequences, one numpy step for each position.
"""

from __future__ import annotations

import re

import numpy as np

_RUNS = re.compile(r"(.)\1+")
_CASED = str.maketrans({**{chr(c): "X" for c in range(65, 91)}, **{chr(c): "x" for c in range(97, 123)},
                        **{chr(c): "d" for c in range(48, 58)}})


def shape(word: str) -> str:
    """A-Z to X, a-z and other letters to x or X by case, digits to d."""
    out = word.translate(_CASED)
    if out.isascii():
        return out
    return "".join(c if c.isascii() else "X" if c.isupper() else "x" if c.isalpha() else c for c in out)


def word_features(word: str, known: frozenset | None = None) -> dict[str, list[str]]:
    """Features of a word for its own label, the next word's and the previous word's."""
    full = shape(word)
    core = full.rstrip(".,;:!?")
    brief = _RUNS.sub(r"\1", core)
    digits = full.count("d")
    lower = word.lower().rstrip(".,;:!?")
    named = [] if known is not None and lower not in known else [f"w={lower}"]
    about = [f"b={brief}", f"n={min(digits, 20)}", f"e={full[-1:]}" if full[-1:] in ".,;:!?" else "e="]
    own = ["bias", f"s={core}", *about, f"l={min(len(core), 24)}", *named,
           *(f"c={c}" for c in set(core) - set("Xxd")), f"p={core[:1]}", f"m={'d' in core and 'x' in core}"]
    return {"own": own, "next": [f"-{x}" for x in about + named], "prev": [f"+{x}" for x in about + named]}


class Crf:
    """labels[0] must be "O".  Fitted weights: features x labels and labels x labels."""

    def __init__(self, labels: list[str]):
        self.labels, self.index = labels, {}
        self.weights = np.zeros((0, len(labels)))
        self.moves = np.zeros((len(labels), len(labels)))
        self.known: frozenset = frozenset()

    def _scores(self, features: list[str]) -> np.ndarray:
        at = [self.index[f] for f in features if f in self.index]
        return self.weights[at].sum(axis=0) if at else np.zeros(len(self.labels))

    def word_scores(self, word: str) -> np.ndarray:
        """(3, labels): votes for the word itself, the word after it, the word before it."""
        f = word_features(word, self.known)
        return np.stack([self._scores(f["own"]), self._scores(f["next"]), self._scores(f["prev"])])

    @staticmethod
    def emissions(votes: np.ndarray) -> np.ndarray:
        """(T, 3, labels) votes of a sequence's words -> (T, labels)."""
        out = votes[:, 0].copy()
        out[1:] += votes[:-1, 1]
        out[:-1] += votes[1:, 2]
        return out

    def fit(self, sequences: list[tuple[list[str], list[str]]], rounds: int = 150, rate: float = 0.15,
            ridge: float = 1e-4) -> "Crf":
        """Adam on the regularised mean log-likelihood, over all sequences at once."""
        counts: dict[str, int] = {}
        for words, _ in sequences:
            for w in set(x.lower().rstrip(".,;:!?") for x in words):
                counts[w] = counts.get(w, 0) + 1
        self.known = frozenset(w for w, n in counts.items() if n >= 15 and w.isalpha())
        rows, cols, flat = [], [], 0
        longest = max(len(w) for w, _ in sequences)
        n, k = len(sequences), len(self.labels)
        mask, gold = np.zeros((n, longest), bool), np.zeros((n, longest), np.int64)
        number = {label: i for i, label in enumerate(self.labels)}
        for s, (words, tags) in enumerate(sequences):
            feats = [word_features(w, self.known) for w in words]
            for t in range(len(words)):
                names = feats[t]["own"] + (feats[t - 1]["next"] if t else []) \
                    + (feats[t + 1]["prev"] if t + 1 < len(words) else [])
                for f in names:
                    rows.append(s * longest + t)
                    cols.append(self.index.setdefault(f, len(self.index)))
                gold[s, t], mask[s, t] = number[tags[t]], True
            flat += len(words)
        rows, cols = np.array(rows), np.array(cols)
        self.weights = np.zeros((len(self.index), k))
        target = np.zeros((n * longest, k))
        target[np.flatnonzero(mask.ravel()), gold[mask]] = 1
        pairs = np.zeros((k, k))
        both = mask[:, 1:]
        np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        state = [np.zeros_like(self.weights), np.zeros_like(self.weights),
                 np.zeros_like(self.moves), np.zeros_like(self.moves)]
        for step in range(1, rounds + 1):
            emit = np.zeros((n * longest, k))
            for c in range(k):
                emit[:, c] = np.bincount(rows, self.weights[cols, c], n * longest)
            node, edge = self._expected(emit.reshape(n, longest, k), mask)
            diff = (target - node.reshape(-1, k))[rows]
            grad_w = np.stack([np.bincount(cols, diff[:, c], len(self.index)) for c in range(k)], axis=1)
            grads = (grad_w / n - ridge * self.weights, (pairs - edge) / n - ridge * self.moves)
            for i, (param, g) in enumerate(zip((self.weights, self.moves), grads)):
                m, v = state[2 * i], state[2 * i + 1]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                param += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self

    def _expected(self, emit: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected label and label-pair counts by forward and backward sums."""
        n, longest, k = emit.shape
        lse = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(
            np.exp(x - m).sum(axis=axis))
        fore, back = np.zeros_like(emit), np.zeros_like(emit)
        fore[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = lse(fore[:, t - 1, :, None] + self.moves, 1) + emit[:, t]
            fore[:, t] = np.where(mask[:, t, None], step, fore[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = lse(self.moves + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(mask[:, t + 1, None], step, back[:, t + 1])
        total = lse(fore[:, -1], 1)
        node = np.exp(fore + back - total[:, None, None]) * mask[:, :, None]
        edge = np.zeros((k, k))
        for t in range(1, longest):
            on = mask[:, t]
            if on.any():
                edge += np.exp(fore[on, t - 1, :, None] + self.moves
                               + (emit[on, t] + back[on, t])[:, None, :] - total[on, None, None]).sum(axis=0)
        return node, edge

    @property
    def slack(self) -> float:
        """The most that the transitions around one labelled word can add over O to O."""
        return 2 * max(0.0, float(self.moves.max() - self.moves[0, 0]))

    def could_label(self, emit: np.ndarray) -> np.ndarray:
        """Positions whose best other label could pay for leaving O, transitions at their best."""
        return emit[:, 1:].max(axis=1) - emit[:, 0] + self.slack > 0

    def viterbi(self, sequences: list[np.ndarray], batch: int = 256) -> list[np.ndarray]:
        """Best label numbers of each (T, labels) emission array."""
        out: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            sizes = np.array([len(sequences[i]) for i in part])
            emit = np.zeros((len(part), sizes.max(), len(self.labels)))
            for r, i in enumerate(part):
                emit[r, :sizes[r]] = sequences[i]
            score, back = emit[:, 0].copy(), np.zeros(emit.shape, np.int8)
            for t in range(1, emit.shape[1]):
                first = int(np.searchsorted(sizes, t, side="right"))  # sequences that go on
                paths = score[first:, :, None] + self.moves
                back[first:, t] = paths.argmax(axis=1)
                score[first:] = paths.max(axis=1) + emit[first:, t]
            last = score.argmax(axis=1)
            for r, i in enumerate(part):
                tags = np.empty(sizes[r], np.int64)
                tags[-1] = last[r]
                for t in range(sizes[r] - 1, 0, -1):
                    tags[t - 1] = back[r, t, tags[t]]
                out[i] = tags
        return out
