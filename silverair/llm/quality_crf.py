"""Line quality by a linear-chain conditional random field.

Every line is good or bad. Emissions see the features of the line and of its two
neighbours, transitions see pairs of labels. Forward-backward marginals, weighted
by line length, give the quality of a document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from silverair.llm.batches import map_texts
from silverair.llm.fitting import adam, labelled_sample, logistic, logit, sigmoid

BYTE = np.arange(256)
CLASSES = np.array(
    [
        (BYTE >= 65) & (BYTE <= 90),
        (BYTE >= 97) & (BYTE <= 122),
        (BYTE >= 48) & (BYTE <= 57),
        np.isin(BYTE, list(b"#*$%&<>@^~=+_{}[]\\/")),
        BYTE == ord("|"),
        np.isin(BYTE, list(b".,;:?'\"()-")),
        BYTE == ord("!"),
        np.isin(BYTE, list(b" \t\v\f\r")),
        BYTE >> 6 == 3,
    ]
)
CONTINUES = BYTE >> 6 == 2
OWN = len(CLASSES) + 7
WIDTH = 3 * OWN + 1


class Lines:
    """Lines of texts: features with neighbours, length in code points, and the text of each line."""

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode() + b"\n" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.flatnonzero(data == 10)
        starts = np.append(0, ends[:-1] + 1) if len(ends) else ends
        self.counts = np.array([r.count(b"\n") for r in raw], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        size = ends - starts
        classes = [np.add.reduceat(c[data], starts, dtype=np.int32) if len(starts) else starts for c in CLASSES]
        wide = np.add.reduceat(CONTINUES[data], starts, dtype=np.int32) if len(starts) else starts
        self.length = np.maximum(size - wide, 0)
        repeated = np.zeros(len(size), bool)
        at = 0
        for r in raw:
            seen: set[bytes] = set()
            for line in r.split(b"\n")[:-1]:
                repeated[at] = line in seen
                seen.add(line)
                at += 1
        length = np.maximum(self.length, 1)
        own = np.column_stack(
            [
                *(c / length for c in classes),
                np.minimum(np.log1p(self.length) / 8, 1),
                np.minimum(self.length / (classes[7] + 1) / 20, 1),
                repeated & (self.length > 0),
                self.length == 0,
                data[np.maximum(ends - 1, 0)] == ord("."),
                data[np.maximum(ends - 1, 0)] == ord("!"),
                np.ones(len(size)),
            ]
        ) if len(size) else np.zeros((0, OWN))
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[self.first] = 0
        after[self.first + self.counts - 1] = 0
        # The constant of a neighbour tells whether there is one.
        self.features = np.column_stack([own, before, after, np.ones(len(own))])


def chain_order(counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Texts by falling number of lines, and for each position the number of texts that reach it."""
    order = np.argsort(-counts, kind="stable")
    deepest = int(counts.max()) if len(counts) else 0
    reach = np.searchsorted(-counts[order], -np.arange(1, deepest + 1), side="right")
    return order, reach.tolist()


def messages(unary: np.ndarray, pairs: np.ndarray, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of each line being good.

    ``unary`` is the log odds of the line alone, ``pairs`` the 2 x 2 transition
    scores. Two labels need one number per message.
    """
    order, reach = chain_order(lines.counts)
    first, last = lines.first[order], (lines.first + lines.counts - 1)[order]
    forward, backward = unary.copy(), np.zeros_like(unary)
    for t in range(1, len(reach)):
        now = first[: reach[t]] + t
        r = forward[now - 1]
        good, bad = np.logaddexp(pairs[0, 1], r + pairs[1, 1]), np.logaddexp(pairs[0, 0], r + pairs[1, 0])
        forward[now] += good - bad
        now = last[: reach[t]] - t
        b = unary[now + 1] + backward[now + 1]
        good, bad = np.logaddexp(pairs[1, 0], b + pairs[1, 1]), np.logaddexp(pairs[0, 0], b + pairs[0, 1])
        backward[now] = good - bad
    return forward, backward


@dataclass
class Field:
    """Emission weights, transition scores, and the calibration of document scores."""

    emission: np.ndarray
    pairs: np.ndarray
    calibration: tuple[float, float]

    def marginals(self, lines: Lines) -> np.ndarray:
        """Probability of each line being good, given all lines of its text."""
        forward, backward = messages(lines.features @ self.emission, self.pairs, lines)
        return sigmoid(forward + backward)

    def quality(self, lines: Lines, good: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals; a blank line counts as one character."""
        weight = np.maximum(lines.length, 1)
        total = np.add.reduceat(weight * good, lines.first) / np.add.reduceat(weight, lines.first)
        return logit(total)

    def score(self, quality: np.ndarray) -> np.ndarray:
        slope, shift = self.calibration
        return sigmoid(slope * quality + shift)


def fit(texts: list[str], labels: list[int], steps: int = 150, penalty: float = 2e-3) -> Field:
    """Fit on three quarters of the sample, whose lines carry the label of their text, calibrate on the rest."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), (0.0, float(logit(np.array(share)))))
    held = np.arange(len(y)) % 4 == 3
    lines = Lines([t for t, h in zip(texts, held, strict=True) if not h])
    text_of_line = np.repeat(np.arange(len(lines.counts)), lines.counts)
    target = y[~held][text_of_line]
    # Every text weighs the same, and so do both classes.
    share = y[~held].mean()
    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) / (lines.counts[text_of_line] * len(lines.counts))
    inner = np.flatnonzero(text_of_line[1:] == text_of_line[:-1]) if len(text_of_line) else text_of_line

    def gradient(x: np.ndarray) -> np.ndarray:
        emission, pairs = x[:-4], x[-4:].reshape(2, 2)
        unary = lines.features @ emission
        forward, backward = messages(unary, pairs, lines)
        slope = (sigmoid(forward + backward) - target) * weight
        # Pair marginals of neighbouring lines, from the messages of both sides.
        left, right = forward[inner], unary[inner + 1] + backward[inner + 1]
        joint = np.array([[np.zeros_like(left), right], [left, left + right]]) + pairs[:, :, None]
        joint -= joint.max(axis=(0, 1))
        joint = np.exp(joint)
        joint /= joint.sum(axis=(0, 1))
        same = target[inner] == 1
        joint[1, 1] -= same
        joint[0, 0] -= ~same
        turn = (joint * weight[inner]).sum(axis=2)
        return np.concatenate([lines.features.T @ slope, turn.ravel()]) + penalty * x

    x = adam(gradient, np.zeros(WIDTH + 4), steps, 0.15)
    field = Field(x[:-4], x[-4:].reshape(2, 2), (1.0, 0.0))
    rest = Lines([t for t, h in zip(texts, held, strict=True) if h])
    if len(rest.counts) and 0 < y[held].mean() < 1:
        quality = field.quality(rest, field.marginals(rest))
        slope, shift = logistic(quality[:, None], y[held])
        field.calibration = (float(slope), float(shift))
    return field


def fit_field(
    docs: DataFrame, labels: DataFrame, max_docs: int = 4000, max_chars: int = 20_000, label: str = "quality"
) -> Field:
    """Fit on at most ``max_docs`` labelled texts of at most ``max_chars`` characters."""
    texts, marks = labelled_sample(docs, labels, label, max_docs=max_docs, max_chars=max_chars)
    return fit(texts, marks)


def line_quality(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``score`` of every whole text and ``line_good``, the probability of each line being good.

    A null or empty text is one blank line. Rows are neither dropped nor merged;
    a repeated row gives a repeated result.
    """

    def work(texts: list[str]) -> list:
        lines = Lines(texts)
        good = field.marginals(lines)
        return [field.score(field.quality(lines, good)), np.split(good.astype(np.float32), lines.first[1:])]

    return map_texts(docs, id_column, text_column, "score double, line_good array<float>", lambda: work)
