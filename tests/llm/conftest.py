from __future__ import annotations

import random

import pytest

FOLDER = "/root/testdata/sf0.001"
# Names that the operators use inside or return.
CLASHING = "score double, component_id long, kept binary, bucket int, seed long, row string, c0 string, hashes string"


def words(seed: int, n: int) -> str:
    """``n`` made-up words, the same for the same seed."""
    deal = random.Random(seed)
    return " ".join("".join(deal.choice("abdeilmnorstu") for _ in range(deal.randint(3, 9))) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    base = words(1, 120)
    near = base.replace(" ", "  ", 3)
    shared = words(2, 40)
    return [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, base),
        (4, base),
        (5, near),
        (6, f"{words(3, 30)} {shared} {words(4, 30)}"),
        (7, f"é{words(5, 30)} {shared}ß {words(6, 30)}\n{shared}"),
        (8, "ab"),
        (9, "a" * 300),
        (10, "b" + "a" * 300),
        (11, "  ▁ é\U0001f600\x00 \n\n<s>\\ x"),
        (11, words(7, 60)),
        (11, words(8, 60)),
        (12, words(9, 20_000)),
        (13, f"{words(9, 100)}"),
        (None, base),
        (3, base),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, "en", "s", len(t or ""), *[None] * 8) for i, t in edge_texts()]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
