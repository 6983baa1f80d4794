"""Toxicity by compression distance.

Two zstandard dictionaries are built, one of windows typical of ordinary text and
one of windows typical of toxic text. Each window of a text is compressed with both:
what it takes fewer bytes with the toxic one is its gain. Windows are runs of
letters, lower-cased, inside a fixed frame, which a match with a dictionary takes
in. Short windows gain a byte or two by chance, so gains are counted by the length of
the window, and a logistic regression over these counts is the calibrated
threshold. Nothing else enters the score. Each distinct window is compressed once per task.

Toxic dictionary entries are windows or their beginnings, since a stem with many endings
has no typical window, and the windows that begin with such an entry: a short stem inside a
longer window saves fewer bytes than zstandard asks of a compressed block. Near copies of
a text count once, or all their windows would be typical.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from silverair.llm.batches import map_texts
from silverair.llm.fitting import labelled_sample, logistic, logit, sigmoid

WINDOW = re.compile(r"[^\W\d_]+")
FRAME = b"\n\n\n\n"
# Windows of more characters are cut into pieces of this length; none is dropped.
LONGEST = 64
# Beginnings of windows from this length on may be dictionary entries.
SHORTEST_STEM = 4
# Texts of so many windows or more are near copies if they share half of their least hashes of runs.
COPIED = 8
RUN = 3
SKETCH = 64
# Gains in bytes that are counted, apart for windows of up to so many bytes and for longer ones.
MARGINS = np.arange(2, 6)
LENGTHS = np.array([5, 7, 9])
COUNTS = len(MARGINS) * (len(LENGTHS) + 1)
# A window that gains so much is reported as toxic.
REPORTED = 3
# Entries of the table of compared windows that a task keeps. It bounds memory only.
TABLE_ENTRIES = 600_000


def windows(text: str) -> list[str]:
    found = WINDOW.findall(text.lower())
    if len(text) > LONGEST and any(len(w) > LONGEST for w in found):
        return [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


def beginnings(window: str) -> list[str]:
    return [window[:k] for k in range(SHORTEST_STEM, len(window))] + [window]


def pieces(text: str) -> Counter:
    """How many windows of a text begin with each piece."""
    found: Counter = Counter()
    for window, times in Counter(windows(text)).items():
        for piece in beginnings(window):
            found[piece] += times
    return found


def originals(texts: list[str]) -> list[str]:
    """The texts that are no near copies of an earlier one. Short texts may agree by chance and all count."""
    kept: list[str] = []
    first: dict[int, int] = {}
    for text in texts:
        found = windows(text)
        if len(found) >= COPIED:
            runs = {zlib.crc32(" ".join(found[i : i + RUN]).encode()) for i in range(len(found) - RUN + 1)}
            sketch = sorted(runs)[:SKETCH]
            shared = Counter(first[h] for h in sketch if h in first)
            if 2 * max(shared.values(), default=0) >= len(sketch):
                continue
            for h in sketch:
                first.setdefault(h, len(kept))
        kept.append(text)
    return kept


def counted(texts: list[str]) -> tuple[Counter, Counter, Counter]:
    """Texts that have a piece, that have it repeatedly, and that have a window."""
    once, repeated, whole = Counter(), Counter(), Counter()
    for text in texts:
        found = pieces(text)
        once.update(found.keys())
        repeated.update(p for p, times in found.items() if times > 1)
        whole.update(set(windows(text)))
    return once, repeated, whole


@dataclass
class Dictionaries:
    """Ordinary and toxic windows, typical ones last, and the weights of the calibration."""

    ordinary: list[str]
    toxic: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2 * COUNTS + 1))


class Comparison:
    """How many bytes fewer a window takes with the toxic dictionary."""

    def __init__(self, model: Dictionaries) -> None:
        self.ordinary, self.toxic = (_compressor(_framed(w)) for w in (model.ordinary, model.toxic))
        self.known: set[str] = set()
        # Windows that gain the least margin, and their gain and group of length.
        self.found: dict[str, tuple[int, int]] = {}

    def gain(self, window: str) -> int:
        framed = FRAME + window.encode() + FRAME
        return len(self.ordinary.compress(framed)) - len(self.toxic.compress(framed))

    def learn(self, found: set[str]) -> None:
        if len(self.known) > TABLE_ENTRIES:
            self.known.clear()
            self.found.clear()
        new = found - self.known
        self.known |= new
        for window in new:
            gain = self.gain(window)
            if gain >= MARGINS[0]:
                self.found[window] = gain, int(np.searchsorted(LENGTHS, len(window.encode())))

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts x COUNTS, windows of a length that gain the margin or more; the windows, and those reported as toxic."""
        split = [windows(t) for t in texts]
        self.learn(set().union(*split))
        reached = np.zeros((len(texts), len(LENGTHS) + 1, len(MARGINS)))
        toxic = np.zeros(len(texts), np.int64)
        for i, part in enumerate(split):
            for gain, group in (self.found[w] for w in part if w in self.found):
                reached[i, group, : gain - MARGINS[0] + 1] += 1
                toxic[i] += gain >= REPORTED
        return reached.reshape(len(texts), COUNTS), np.array([len(part) for part in split], np.int64), toxic


def _framed(entries: list[str]) -> bytes:
    return FRAME + b"".join(w.encode() + FRAME for w in entries)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        16,
        source_size=1 << 17,
        dict_size=len(content),
        min_match=4,
        strategy=zstandard.STRATEGY_BTOPT,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def typical(marked: Counter, other: Counter, n_marked: int, n_other: int) -> dict[str, float]:
    """Log-likelihood ratio of windows that more of the marked texts have than of the others."""
    ratios = {}
    for window, a in marked.items():
        b = other.get(window, 0)
        if a * n_other > b * n_marked:
            share = (a + b) / (n_marked + n_other)
            ratio = a * np.log(a / (share * n_marked)) + (b * np.log(b / (share * n_other)) if b else 0)
            ratios[window] = 2 * float(ratio)
    return ratios


def fit(texts: list[str], labels: list[int], least: float = 20.0, ordinary_windows: int = 2000) -> Dictionaries:
    """Dictionaries from two thirds of the sample; the rest calibrates the counts.

    A piece is typical of toxic text if the ratio of the texts that have it, once or
    repeatedly, reaches ``least``, however frequent others are. Of pieces that begin
    each other, the one with the largest ratio is taken, and with it every window of the
    toxic texts that begins with it, unless as many ordinary texts have that. Ordinary
    windows are those that most ordinary texts have.
    """
    y = np.array(labels, int)
    held = np.arange(len(y)) % 3 == 2
    ordinary, toxic = ([t for t, h, label in zip(texts, held, y, strict=True) if not h and label == k] for k in (0, 1))
    toxic = originals(toxic)
    *marked_pieces, forms = counted(toxic)
    *other_pieces, whole = counted(ordinary)
    ratios: dict[str, float] = {}
    for marked, other in zip(marked_pieces, other_pieces, strict=True):
        for piece, ratio in typical(marked, other, len(toxic), len(ordinary)).items():
            ratios[piece] = max(ratio, ratios.get(piece, 0.0))
    chosen: list[str] = []
    entries, covered = set(), set()
    for piece in sorted((p for p, r in ratios.items() if r >= least), key=lambda p: (-ratios[p], -len(p), p)):
        if piece not in covered and entries.isdisjoint(beginnings(piece)):
            chosen.append(piece)
            entries.add(piece)
            covered.update(beginnings(piece))
    common = sorted((w for w in whole if entries.isdisjoint(beginnings(w))), key=lambda w: (whole[w], w))
    begun = [w for w in forms if forms[w] > whole[w] and w not in entries and not entries.isdisjoint(beginnings(w))]
    model = Dictionaries(common[-ordinary_windows:], sorted(begun, key=lambda w: (forms[w], w)) + chosen[::-1])
    if held.any() and 0 < y[held].mean() < 1:
        reached, n, _ = Comparison(model).counts([t for t, h in zip(texts, held, strict=True) if h])
        model.weights = logistic(_features(reached, n), y[held], 1e-3)
    else:
        model.weights[-1] = logit(np.array(y.mean() if len(y) else 0.5))
    return model


def _features(reached: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Counts, and counts for a hundred windows; a text without gains has zeros."""
    return np.log1p(np.column_stack([reached, 100 * reached / (n[:, None] + 20)]))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, max_docs: int = 6000, max_chars: int = 20_000, label: str = "toxic"
) -> Dictionaries:
    """Fit on at most ``max_docs`` labelled texts of at most ``max_chars`` characters."""
    texts, marks = labelled_sample(docs, labels, label, max_docs=max_docs, max_chars=max_chars)
    return fit(texts, marks)


def toxicity(docs: DataFrame, model: Dictionaries, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``score``, ``n_windows`` and ``n_toxic_windows`` (that gain REPORTED bytes) of every whole text.

    A null or empty text has no window and gets the score of a text without toxic
    windows. Rows are neither dropped nor merged.
    """

    def worker():
        compare = Comparison(model)

        def work(texts: list[str]) -> list:
            reached, n, toxic = compare.counts(texts)
            return [sigmoid(_features(reached, n) @ model.weights[:-1] + model.weights[-1]), n, toxic]

        return work

    columns = "score double, n_windows long, n_toxic_windows long"
    return map_texts(docs, id_column, text_column, columns, worker)
