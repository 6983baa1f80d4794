"""Quality rules: counts of a text, and a calibrated n-gram model over hashed words and characters.

The model is a logistic regression on the mean weight of hashed word n-grams
(one and two words) and of characters (three and five code points). It is fitted on a
bounded labelled sample and calibrated on rows kept out of the fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from silverair.llm.batches import map_texts
from silverair.llm.fitting import adam, labelled_sample, logistic, logit, sigmoid

BUCKET_BITS = 18
OUTSIDE = 1 << BUCKET_BITS  # bucket without weight
CHAR_ORDERS = (3, 5)
PAD = 8  # zero bytes and characters behind each text, so that no n-gram holds two texts
WINDOW = 8
MIX = np.uint64(0x9E3779B97F4A7C15)

MIN_WORDS = 20
REPEAT_PERCENT = 30
KEEP_SCORE = 0.3

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
CONTINUES = np.arange(256) >> 6 == 2  # later bytes of a code point


class Batch:
    """Texts as one byte array, and their words as numbers that are equal within a text if the words are."""

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode() for t in texts]
        self.raw = raw
        self.bytes = np.frombuffer(b"".join(r + bytes(PAD) for r in raw), np.uint8)
        self.starts = np.cumsum([0] + [len(r) + PAD for r in raw[:-1]]) if raw else np.zeros(0, int)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.codes = np.frombuffer("".join(t + "\0" * PAD for t in texts).encode("utf-32-le"), np.uint32)
        self.heads = np.cumsum([0, *(self.sizes[:-1] + PAD)]) if raw else np.zeros(0, int)
        words = [r.split() for r in raw]
        self.counts = np.array([len(w) for w in words], np.int64)
        table: dict[bytes, int] = {}
        self.words = np.array([table.setdefault(w, len(table)) for part in words for w in part], np.int64)
        self.hashes = np.array([zlib.crc32(w) for w in table], np.uint64)[self.words] if table else np.zeros(0, np.uint64)
        self.text_of_word = np.repeat(np.arange(len(raw)), self.counts)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of per-byte ``values`` for each text."""
        return np.add.reduceat(values, self.starts, dtype=np.int64) if len(self.starts) else np.zeros(0, np.int64)

    def hashed_words(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Bucket of every word and of every pair of words, and its text."""
        kinds = [(_bucket(self.hashes, 1), self.text_of_word)]
        if len(self.words) > 1:
            inside = self.text_of_word[:-1] == self.text_of_word[1:]
            pairs = (self.hashes[:-1] * MIX + self.hashes[1:])[inside]
            kinds.append((_bucket(pairs, 2), self.text_of_word[:-1][inside]))
        return kinds

    def hashed_characters(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Bucket of every character n-gram, and the number of n-grams of each text.

        N-grams run one character into the padding, which marks the end of the text.
        Those that lie further behind it get the bucket OUTSIDE.
        """
        kinds = []
        for order in CHAR_ORDERS:
            n = len(self.codes) - order + 1
            gram = np.zeros(n, np.uint64)
            for k in range(order):
                gram = gram * MIX + self.codes[k : k + n]
            counts = np.maximum(self.sizes - order + 2, 0)
            buckets = _bucket(gram, order + 10)
            behind = self.heads[:, None] + (self.sizes + PAD - 1)[:, None] - np.arange(PAD + order - 2)
            behind = behind[behind >= (self.heads + counts)[:, None]]
            buckets[behind[behind < n]] = OUTSIDE
            kinds.append((buckets, counts))
        return kinds


def _bucket(value: np.ndarray, kind: int) -> np.ndarray:
    mixed = (value ^ (value >> np.uint64(29)) ^ np.uint64(kind * 0x5851F42D4C957F2D % 2**64)) * MIX
    return ((mixed ^ (mixed >> np.uint64(32))) * MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def repeated_words(batch: Batch) -> np.ndarray:
    """Words of each text that lie in a window of eight words found twice or more in that text."""
    n = len(batch.words)
    total = np.zeros(len(batch.raw), np.int64)
    if n < WINDOW:
        return total
    rank = np.unique(batch.text_of_word * (n + 1) + batch.words, return_inverse=True)[1]
    for half in (1, 2, 4):
        # Numbers of windows of twice the length; windows over a text's end get no partner.
        rank = np.unique(rank[:-half] * (n + 1) + rank[half:], return_inverse=True)[1]
    whole = batch.text_of_word[: len(rank)] == batch.text_of_word[WINDOW - 1 :]
    twice = (np.bincount(rank[whole], minlength=rank.max() + 1)[rank] > 1) & whole
    edge = np.zeros(n + 1, np.int64)
    edge[: len(rank)] += twice
    edge[WINDOW : WINDOW + len(rank)] -= twice
    inside = np.cumsum(edge[:n]) > 0
    return np.bincount(batch.text_of_word[inside], minlength=len(batch.raw))


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in raw:
        return 0
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


@dataclass
class Model:
    """Bucket weights, intercept, and the slope and shift of the calibration."""

    weights: np.ndarray
    intercept: float
    calibration: tuple[float, float]

    def raw_scores(self, batch: Batch) -> np.ndarray:
        total = np.full(len(batch.raw), self.intercept)
        for buckets, text in batch.hashed_words():
            n = np.bincount(text, minlength=len(batch.raw))
            total += np.bincount(text, self.weights[buckets], len(batch.raw)) / np.maximum(n, 1)
        for buckets, counts in batch.hashed_characters():
            total += np.add.reduceat(self.weights[buckets], batch.heads) / np.maximum(counts, 1)
        return total

    def scores(self, batch: Batch) -> np.ndarray:
        slope, shift = self.calibration
        return sigmoid(slope * self.raw_scores(batch) + shift)


def fit(texts: list[str], labels: list[int], steps: int = 80, penalty: float = 1e-6) -> Model:
    """Fit on three quarters of the sample and calibrate on the rest; no labels give a score of a half."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
        return Model(np.zeros(OUTSIDE + 1), 0.0, (0.0, float(logit(np.array(share)))))
    held = np.arange(len(y)) % 4 == 3
    fitted = [t for t, h in zip(texts, held, strict=True) if not h]
    columns, values, ends = [], [], [0]
    for text in fitted:
        batch = Batch([text])
        kinds = [b for b, _ in batch.hashed_words()] + [b[b != OUTSIDE] for b, _ in batch.hashed_characters()]
        found = [np.unique(b, return_counts=True) for b in kinds]
        columns.append(np.concatenate([f for f, _ in found]))
        values.append(np.concatenate([n / max(1, len(b)) for b, (_, n) in zip(kinds, found, strict=True)]))
        ends.append(ends[-1] + len(columns[-1]))
    column, value = np.concatenate(columns), np.concatenate(values)
    row = np.repeat(np.arange(len(fitted), dtype=np.int32), np.diff(ends))
    target = y[~held]
    # Both classes weigh the same in the fit; the calibration brings the share back.
    balance = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean())) / len(target)

    def gradient(x: np.ndarray) -> np.ndarray:
        z = np.bincount(row, value * x[column], len(fitted)) + x[-1]
        slope = (sigmoid(z) - target) * balance
        return np.append(np.bincount(column, value * slope[row], len(x) - 1), slope.sum()) + penalty * x

    x = adam(gradient, np.zeros(OUTSIDE + 1), steps, 2.0)
    model = Model(np.append(x[:-1], 0.0), float(x[-1]), (1.0, 0.0))
    kept_out = [t for t, h in zip(texts, held, strict=True) if h]
    scores = np.concatenate([model.raw_scores(Batch([t])) for t in kept_out]) if kept_out else np.zeros(0)
    if len(scores) and 0 < y[held].mean() < 1:
        slope, shift = logistic(scores[:, None], y[held])
        model.calibration = (float(slope), float(shift))
    return model


def judge(texts: list[str], model: Model) -> list:
    """The columns of COLUMNS for ``texts``."""
    batch = Batch(texts)
    words = batch.counts
    repeats = repeated_words(batch)
    failed = (words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * words)
    score = model.scores(batch)
    space = SPACES[batch.bytes] | CONTINUES[batch.bytes]
    chars = batch.per_text(~space) - PAD
    lines = [duplicate_lines(r) for r in batch.raw]
    return [
        words, chars, batch.per_text(SYMBOLS[batch.bytes]), lines, repeats, failed, score, ~failed & (score >= KEEP_SCORE),
    ]


def fit_rules(
    docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_chars: int = 20_000, label: str = "quality"
) -> Model:
    """Fit on at most ``max_docs`` labelled texts of at most ``max_chars`` characters."""
    texts, marks = labelled_sample(docs, labels, label, max_docs=max_docs, max_chars=max_chars)
    return fit(texts, marks)


def apply_rules(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Counts, score and verdict of every whole text, with the id or the columns named in ``carry``.

    A text fails the base rules with fewer than 20 words, or if over 30 of 100
    words lie in repeated windows; else it is kept from a score of 0.3. A null or
    empty text has no words and fails. Rows are neither dropped nor merged.
    """
    return map_texts(docs, id_column, text_column, COLUMNS, lambda: lambda texts: judge(texts, model), carry)
