from __future__ import annotations

import random

import pytest

from helpers import rows
from silverair.operators.paging import concat_pages

PAGES = "request string, page int, results array<int>, n int"


def landed(spark, data):
    return spark.createDataFrame([(r, p, items, len(items or [])) for r, p, items in data], PAGES)


@pytest.mark.parametrize("count", [None, "n"])
def test_pages_stop_at_the_first_empty_or_missing_page(spark, count):
    data = [
        ("middle", 1, [1, 2]), ("middle", 2, []), ("middle", 3, [9]),
        ("end", 2, [4]), ("end", 1, [3]), ("end", 3, None),
        ("gap", 1, [5]), ("gap", 3, [9]),
        ("late", 2, [9]), ("late", 3, [9]),
        ("none", 1, []),
        ("zero", 0, [9]), ("zero", 1, [6]),
    ]
    got = concat_pages(landed(spark, data), "request", "page", "results", "item", count=count)
    assert rows(got.select("request", "page", "item_pos", "item"), "request", "page", "item_pos") == [
        ("end", 1, 0, 3), ("end", 2, 0, 4), ("gap", 1, 0, 5), ("middle", 1, 0, 1), ("middle", 1, 1, 2), ("zero", 1, 0, 6),
    ]


def test_cap_may_end_inside_a_page(spark):
    data = [("a", 1, [1, 2]), ("a", 2, [3, 4]), ("a", 3, [5]), ("b", 1, [6])]
    got = concat_pages(landed(spark, data), "request", "page", "results", "item", max_records=3)
    assert rows(got.select("request", "item"), "item") == [("a", 1), ("a", 2), ("a", 3), ("b", 6)]


def test_against_a_loop(spark):
    rng = random.Random(5)
    data = [
        (f"r{r}", page, list(range(rng.choice([0, 1, 1, 2, 3]))))
        for r in range(40)
        for page in range(1, 9)
        if rng.random() < 0.9
    ]
    want = []
    for request in {r for r, _, _ in data}:
        pages = {p: items for r, p, items in data if r == request}
        page, taken = 1, []
        while pages.get(page):
            taken += [(request, page, i) for i in pages[page]]
            page += 1
        want += taken[:4]
    got = concat_pages(landed(spark, data), "request", "page", "results", "item", max_records=4)
    assert rows(got.select("request", "page", "item")) == sorted(want, key=repr)
