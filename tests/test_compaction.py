"""Appended partitions, and their compaction while others read and write."""

from __future__ import annotations

from datetime import timedelta

import pytest

from helpers import rows
from silverair.sinks import partitions, versions

SMALL = "id int, day string"


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), SMALL)


def add(spark, root, *pairs):
    return partitions.append(spark, root, "day", frame(spark, *pairs))


def files(spark, root):
    found = partitions.read(spark, root, SMALL).select("day", "_metadata.file_path").distinct()
    return dict(rows(found.groupBy("day").count(), "day"))


def test_appends_add_up_and_a_replacement_takes_their_place(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(3):
        add(spark, root, (i, "a"), (i, None))
    assert files(spark, root) == {None: 3, "a": 3}
    assert rows(partitions.read(spark, root, SMALL)) == sorted([(i, d) for i in range(3) for d in ("a", None)], key=repr)
    partitions.replace(spark, root, "day", lambda: frame(spark, (9, "a")))
    assert files(spark, root) == {None: 3, "a": 1}


def test_compaction_keeps_rows_and_readers(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(4):
        add(spark, root, (i, "a"), (i, "x/y: 1"), (i, None))
    add(spark, root, (7, "single"))
    opened = partitions.read(spark, root, SMALL)
    want = rows(opened)
    assert partitions.compact(spark, root, "day", SMALL) == {"partitions": 3, "rows": 12}
    assert set(files(spark, root).values()) == {1}
    assert rows(partitions.read(spark, root, SMALL)) == want == rows(opened)
    assert partitions.compact(spark, root, "day", SMALL) == {"partitions": 0, "rows": 0}
    # Four folders of three partitions go; the one that was not compacted stays.
    assert partitions.retain(spark, root, keep=1, grace=timedelta(0)) == 12
    assert rows(partitions.read(spark, root, SMALL)) == want


def test_nothing_to_compact(spark, tmp_path):
    assert partitions.compact(spark, str(tmp_path / "t"), "day", SMALL) == {"partitions": 0, "rows": 0}


@pytest.fixture
def meanwhile(monkeypatch):
    """Calls the given function once, after a version was written and before it is published."""
    real, calls = partitions._write, []

    def write(*args):
        written = real(*args)
        if calls:
            calls.pop()()
        return written

    monkeypatch.setattr(partitions, "_write", write)
    return calls


def test_rows_appended_during_a_compaction_stay(spark, tmp_path, meanwhile):
    root = str(tmp_path / "t")
    for i in range(3):
        add(spark, root, (i, "a"))
    meanwhile.append(lambda: add(spark, root, (5, "a"), (6, "b")))
    assert partitions.compact(spark, root, "day", SMALL) == {"partitions": 1, "rows": 3}
    assert rows(partitions.read(spark, root, SMALL)) == [(0, "a"), (1, "a"), (2, "a"), (5, "a"), (6, "b")]
    assert files(spark, root) == {"a": 2, "b": 1}


def test_a_partition_replaced_during_a_compaction_is_left_alone(spark, tmp_path, meanwhile):
    root = str(tmp_path / "t")
    for i in range(2):
        add(spark, root, (i, "a"), (i, "b"))
    meanwhile.append(lambda: partitions.replace(spark, root, "day", lambda: frame(spark, (9, "a"))))
    assert partitions.compact(spark, root, "day", SMALL)["partitions"] == 1
    assert rows(partitions.read(spark, root, SMALL)) == [(0, "b"), (1, "b"), (9, "a")]


def test_an_append_during_a_replacement_is_seen_by_its_second_build(spark, tmp_path, meanwhile):
    root = str(tmp_path / "t")
    add(spark, root, (1, "a"))
    meanwhile.append(lambda: add(spark, root, (2, "a")))

    def doubled():
        return frame(spark, *[(r.id * 10, r.day) for r in partitions.read(spark, root, SMALL).collect()])

    partitions.replace(spark, root, "day", doubled)
    assert rows(partitions.read(spark, root, SMALL)) == [(10, "a"), (20, "a")]
    assert versions.current(spark, root)["number"] == 3
