"""Language identification with a string kernel.

Two texts are as similar as the sets of byte n-grams (one to three bytes) that
they share: a blended-spectrum presence kernel, normalised by the set sizes.
Nystroem landmarks give it finite features, and one ridge regression per language
separates that language from the rest. Since the kernel is a product of presence
vectors, landmarks and regression fold into one matrix, and a batch of texts is
scored by one product of its presence matrix with it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from silverair.llm.batches import map_texts
from silverair.llm.fitting import labelled_sample

BINS = 1 << 15
ORDERS = (1, 2, 3)
TEXTS_AT_ONCE = 64
UNKNOWN = "und"


def presence(texts: list[str]) -> np.ndarray:
    """Texts x BINS: which hashed n-grams of the lower-cased text occur."""
    found = np.zeros((len(texts), BINS), np.uint8)
    for row, text in zip(found, texts, strict=True):
        data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
        gram = np.zeros(len(data), np.uint32)
        for order in ORDERS:
            n = len(data) - order + 1
            if n > 0:
                gram = (gram[:n] << np.uint32(8)) | data[order - 1 :]
                row[((gram + np.uint32(order << 27)) * np.uint32(0x9E3779B1)) >> np.uint32(17)] = 1
    return found


def normalised(found: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(found.sum(axis=1, dtype=np.int64), 1))
    return found.astype(np.float32) / norm[:, None].astype(np.float32)


@dataclass
class Classifier:
    languages: list[str]
    matrix: np.ndarray  # BINS x languages

    def decide(self, texts: list[str]) -> np.ndarray:
        """Texts x languages: regression value, about 1 for the language and 0 for others."""
        parts = range(0, len(texts), TEXTS_AT_ONCE)
        return np.concatenate([normalised(presence(texts[i : i + TEXTS_AT_ONCE])) @ self.matrix for i in parts])


def fit(texts: list[str], labels: list[str], landmarks: int = 256, ridge: float = 1e-2) -> Classifier:
    """The first ``landmarks`` texts are the landmarks; all texts fit the regressions."""
    languages = sorted(set(labels))
    if not languages:
        return Classifier([], np.zeros((BINS, 0), np.float32))
    marks = normalised(presence(texts[:landmarks]))
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    kept = values > 1e-6 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    parts = range(0, len(texts), TEXTS_AT_ONCE)
    kernel = np.concatenate([normalised(presence(texts[i : i + TEXTS_AT_ONCE])) @ marks.T for i in parts])
    features = kernel @ whiten
    target = np.array([[label == x for x in languages] for label in labels], float)
    inner = features.T @ features + ridge * np.eye(features.shape[1])
    weights = whiten @ np.linalg.solve(inner, features.T @ target)
    return Classifier(languages, (marks.T @ weights).astype(np.float32))


def fit_languages(docs: DataFrame, max_docs: int = 2000, max_chars: int = 20_000, language: str = "lang") -> Classifier:
    """Fit on at most ``max_docs`` texts of at most ``max_chars`` characters with a known language."""
    texts, labels = labelled_sample(docs, docs, language, max_docs=max_docs, max_chars=max_chars)
    return fit(texts, labels)


def identify(docs: DataFrame, model: Classifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1, the clipped regression value) of every whole text.

    Texts that are null, empty or without a letter get ``und`` and 0, as does
    every text if the model has seen no language. Ties go to the language that
    sorts first. Rows are neither dropped nor merged.
    """

    def work(texts: list[str]) -> list:
        if not model.languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        values = model.decide(texts)
        best = values.argmax(axis=1)
        known = [any(map(str.isalpha, t)) for t in texts]
        names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return [names, np.where(known, np.clip(values.max(axis=1), 0, 1), 0).astype(float)]

    return map_texts(docs, id_column, text_column, "lang_pred string, score double", lambda: work)
