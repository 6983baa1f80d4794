"""Exact removal of repeated byte strings, keeping the first copy.

A byte goes if it lies in a string of 50 bytes that also starts in a document with
a smaller id, that is, where the longest previous factor has 50 bytes. One suffix
array over all texts cannot be dealt out, so the suffixes are dealt out first:

0. Texts that equal one with a smaller id are covered wholly and add no string, so
   a group of copies is one text from here on.
1. Every window of 50 bytes has a minimizer, the least hash of its 20-byte grams.
   A run of windows with one minimizer is a candidate; equal windows have equal
   minimizers and so meet in one bucket, whatever documents they are in. Grams that
   very many texts have come last in the order of hashes. So the windows on the edge of
   a passage that very many texts share, which differ from text to text, have
   minimizers outside it and do not crowd its buckets. Any order gives equal results.
2. Runs whose minimizer occurs in one document only are dropped, which leaves the
   share of the text that repeats.
3. The bytes of the other runs go to their buckets, each distinct run once per
   batch, and count there for the smallest document that has them. The suffixes of
   the bucket are sorted by prefix doubling, with the longest common prefix of
   neighbours. In that order, the previous and the next position with a smaller
   document hold the longest matches with earlier documents; the larger of the two is
   the longest previous factor (LPF). Later occurrences of a run are covered wholly.
4. Covered ranges go back to their documents and are cut out.

Buckets grow in number with the input, not in size, and the occurrences of one run
in very many documents do not meet in one of them. Once a task has sent a minimizer
with two documents to its bucket, and the bytes of a run with a smaller document, later
occurrences need no comparison: the one is shared, the other covered wholly. They
leave by way of buckets below zero, dealt out by document (``aside``), so a bucket gets a
few of them from each task, at most one from a slice of texts where no other of the
slice has it. What a task remembers is bounded; forgetting sends occurrences again and
changes no result. Texts reach both steps ordered by id, so a
task that is run again decides alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.llm.batches import slices

LENGTH = 50
GRAM = 20
GRAMS = LENGTH - GRAM + 1
USED = ("text", "ranges", "copied")
LONGEST_RUN = 255  # longer runs of one minimizer are cut, so that a length fits a byte
END = b"\xff"  # no byte of UTF-8; ends every run of a bucket
DEPTH = LONGEST_RUN + LENGTH  # bytes of the longest run and its END
BUCKET_BYTES = 2_000_000
# Occurrences whose windows are expanded at once. It bounds memory only.
OCCURRENCES = 4096
# Grams are counted by cells. Of those that a hundredth of the texts of a task have, so many of
# the most frequent come last in the order. This moves work between buckets and changes no result.
CELLS = 1 << 22
COMMON = 1 << 16
LEAST_COMMON = 32
# Minimizers, and bytes of runs, that a task remembers to have sent. They bound memory only.
REMEMBERED = 1 << 18
REMEMBERED_BYTES = 4_000_000
ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    value = data.astype(np.uint64)
    for step in (1, 2, 4):
        value = value[:-step] | value[step:] << np.uint64(8 * step)
    return value


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of 63 bits of the grams from each position on."""
    eight = eights(data)
    # 20 bytes: two numbers, and the half of a third that the second does not hold.
    gram = eight[:-12] * ODD[0] + (eight[8:-4] ^ (eight[8:-4] >> np.uint64(31))) * ODD[1] + eight[12:] * ODD[2]
    gram = (gram ^ (gram >> np.uint64(32))) * ODD[3]
    return (gram ^ (gram >> np.uint64(29))) >> np.uint64(1)


def cells(gram: np.ndarray) -> np.ndarray:
    return (gram & np.uint64(CELLS - 1)).astype(np.int64)


def common_cells(texts: DataFrame) -> bytes:
    """A bit for each cell of grams that very many of ``texts`` (column ``text``) have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(CELLS, np.int64), 0
        for batch in batches:
            found = batch.column("text").to_pylist()
            for low, high in slices(found):
                data = [np.frombuffer(t.encode(), np.uint8) for t in found[low:high]]
                counts += np.bincount(np.concatenate([cells(grams(d)) for d in data]), minlength=CELLS)
            n += len(found)
        # A cell has some grams by chance.
        cell = np.flatnonzero(counts >= max(LEAST_COMMON, n // 100) + 8 * counts.sum() // CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(counts[cell])], ["cell", "n"])

    found = texts.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    marked = np.zeros(CELLS, np.uint8)
    # At most COMMON numbers.
    marked[[r.cell for r in found.orderBy(F.desc("n"), "cell").limit(COMMON).select("cell").collect()]] = 1
    return np.packbits(marked).tobytes()


def runs(data: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, first window and number of windows of each run of a text's windows.

    Grams whose cell is marked in ``common`` come behind all others.
    """
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = grams(data)
    if common is not None:
        gram |= common[cells(gram)].astype(np.uint64) << np.uint64(63)
    # Minimum over GRAMS neighbours, by widths that double.
    least, width = gram, 1
    while 2 * width <= GRAMS:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = GRAMS - width
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    count = np.diff(np.append(first, len(least)))
    pieces = -(-count // LONGEST_RUN)
    if pieces.max() > 1:
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, left = np.repeat(first, pieces) + inner * LONGEST_RUN, np.repeat(count, pieces) - inner * LONGEST_RUN
        count = np.minimum(left, LONGEST_RUN)
    return least[first], first, count


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        yield int(bucket[part[0]]), part


def aside(doc: int) -> int:
    """A number below zero for occurrences that no bucket has to compare."""
    return -1 - doc % (1 << 20)


class Sent:
    """Minimizers that a task has sent to their buckets with two documents."""

    def __init__(self) -> None:
        self.known = np.zeros(0, np.uint64)

    def settled(self, least: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Marks occurrences that a bucket need not see to know that their minimizer is shared.

        Of a minimizer in several documents of this slice, those in the smallest and
        in the largest one are sent; of one that was sent so before, none.
        """
        if not len(least):
            return np.zeros(0, bool)
        order = np.argsort(least, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(least[order]) != 0))
        low, high = (f.reduceat(doc[order], starts) for f in (np.minimum, np.maximum))
        values, sizes = least[order[starts]], np.diff(np.append(starts, len(order)))
        before = np.isin(values, self.known)
        inside = (doc[order] != np.repeat(low, sizes)) & (doc[order] != np.repeat(high, sizes))
        mark = np.empty(len(least), bool)
        mark[order] = inside | np.repeat(before, sizes)
        new = values[(low != high) & ~before]
        # Those that this slice has again are the last to be forgotten.
        self.known = np.union1d(self.known if len(self.known) + len(new) <= REMEMBERED else values[before], new)
        return mark


def emit_runs(buckets: int, common: bytes | None = None) -> Callable:
    """Texts to rows (bucket, packed columns) of all their runs; in rows ``aside``, ``least`` holds the buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent()
        last = None if common is None else np.unpackbits(np.frombuffer(common, np.uint8))
        for batch in batches:
            known = batch.column("original").to_pylist()
            ids = batch.column("doc").fill_null(0).to_numpy()
            texts = [t if k else "" for t, k in zip(batch.column("text").to_pylist(), known, strict=True)]
            for low, high in slices(texts):
                found = [runs(np.frombuffer(t.encode(), np.uint8), last) for t in texts[low:high]]
                doc = np.repeat(ids[low:high], [len(f[0]) for f in found])
                least, first, count = (np.concatenate(x) for x in zip(*found, strict=True))
                bucket = (least % np.uint64(buckets)).astype(np.int64)
                rest = (least // np.uint64(buckets)).astype(np.uint32)
                settled = sent.settled(least, doc)
                groups = [(b, rest, p) for b, p in by_bucket(np.where(settled, -1, bucket)) if b >= 0]
                if settled.any():
                    apart = np.flatnonzero(settled)
                    groups.append((aside(int(doc[apart[0]])), bucket.astype("<i4"), apart))
                rows = [
                    (b, of[p].tobytes(), np.diff(doc[p], prepend=0).tobytes(), first[p].astype("<u4").tobytes(), count[p].astype("u1").tobytes())
                    for b, of, p in groups
                ]
                yield table(rows, [pa.int32(), *[pa.binary()] * 4], ["bucket", "least", "doc", "first", "count"])

    return work


def table(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def each_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of a sorted stream, one bucket at a time."""
    current, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != current:
                if held:
                    yield current, held
                current, held = row[0], []
            held.append(row)
    if held:
        yield current, held


def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each bucket whose minimizer occurs in two documents or more, and all that were put aside."""
    for bucket, rows in each_bucket(batches):
        if bucket < 0:
            for _, own, doc, first, count in rows:
                yield found_runs(np.cumsum(np.frombuffer(doc, "<i8")), first, count, np.frombuffer(own, "<i4"))
            continue
        least = np.frombuffer(b"".join(r[1] for r in rows), np.uint32)
        doc = np.concatenate([np.cumsum(np.frombuffer(r[2], "<i8")) for r in rows])
        order = np.argsort(least, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(least[order]) != 0))
        sizes = np.diff(np.append(starts, len(order)))
        several = np.minimum.reduceat(doc[order], starts) != np.maximum.reduceat(doc[order], starts)
        kept = np.sort(order[np.repeat(several, sizes)])
        first, count = (b"".join(r[i] for r in rows) for i in (3, 4))
        yield found_runs(doc, first, count, np.full(len(doc), bucket, np.int32), kept)


def found_runs(doc: np.ndarray, first: bytes, count: bytes, bucket: np.ndarray, kept: np.ndarray | slice = slice(None)) -> pa.RecordBatch:
    first, count = np.frombuffer(first, "<u4")[kept].astype(np.int64), np.frombuffer(count, "u1")[kept].astype(np.int32)
    columns = [pa.array(c) for c in (doc[kept], first, count, bucket[kept])]
    return pa.RecordBatch.from_arrays(columns, ["doc", "first", "count", "bucket"])


def emit_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their shared runs to rows (bucket, bytes of distinct runs, occurrences).

    Rows ``aside`` have the covered size of each occurrence and no bytes.
    """
    kinds, names = [pa.int32(), *[pa.binary()] * 5], ["bucket", "bytes", "sizes", "run", "doc", "at"]
    # The smallest document that was sent with a run.
    smallest: dict[bytes, int] = {}
    remembered = 0
    for batch in batches:
        docs, found = batch.column("doc"), batch.column("runs")
        used = [f.is_valid and k for f, k in zip(found, batch.column("original").to_pylist(), strict=True)]
        texts = [t if u else "" for t, u in zip(batch.column("text").to_pylist(), used, strict=True)]
        for low, high in slices(texts):
            gathered: dict[int, tuple[dict[bytes, int], list[tuple[int, int, int, int]]]] = {}
            later: list[tuple[int, int, int, int]] = []
            if remembered > REMEMBERED_BYTES:
                smallest, remembered = {}, 0
            for i in range(low, high):
                if not texts[i]:
                    continue
                data, doc = texts[i].encode(), docs[i].as_py()
                tag = zlib.crc32(data)
                for run in found[i].as_py():
                    first, count = run["first"], run["count"]
                    content = data[first : first + count + LENGTH - 1]
                    if len(content) < LENGTH:
                        continue
                    sent = smallest.get(content)
                    if sent is not None and sent < doc:
                        later.append((len(content), doc, first, tag))
                    else:
                        smallest[content] = doc
                        remembered += len(content) if sent is None else 0
                        known, places = gathered.setdefault(run["bucket"], ({}, []))
                        places.append((known.setdefault(content, len(known)), doc, first, tag))
            rows = []
            for bucket, (known, places) in gathered.items():
                run, doc, at = packed_places(places)
                rows.append((bucket, b"".join(known), np.array([len(k) for k in known], "<u4").tobytes(), run, doc, at))
            if later:
                size, doc, at = packed_places(later)
                rows.append((aside(later[0][1]), b"", size, b"", doc, at))
            yield table(rows, kinds, names)


def packed_places(places: list[tuple[int, int, int, int]]) -> tuple[bytes, bytes, bytes]:
    place = np.array(places, np.int64)
    return place[:, 0].astype("<u4").tobytes(), place[:, 1].tobytes(), place[:, 2:].astype("<u4").tobytes()


def by_digits(keys: np.ndarray, order: np.ndarray, digits: int) -> np.ndarray:
    """``order`` sorted by the lowest ``digits`` 16-bit digits of its keys; equal keys stay as they were.

    Numpy sorts numbers of 16 bits by counting, several times as fast as longer ones.
    """
    for digit in range(digits):
        part = (keys >> keys.dtype.type(16 * digit)).astype(np.uint16)
        order = order[np.argsort(part[order], kind="stable")]
    return order


def dense_ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Rank of each position among the distinct combinations of ``keys``, by which ``order`` sorts, in four bytes."""
    differs = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        differs[1:] |= ordered[1:] != ordered[:-1]
    rank = np.empty(len(order), np.int32)
    rank[order] = np.cumsum(differs, dtype=np.int32)
    return rank


class Suffixes:
    """Order of the suffixes of ``data`` by prefix doubling, to a depth that by default no run exceeds."""

    def __init__(self, data: bytes, deepest: int = DEPTH) -> None:
        self.deepest = deepest
        # Every position has twice the depth of bytes behind it.
        self.first = eights(np.frombuffer(data + END * (2 * deepest + 8), np.uint8)).byteswap()
        order, depth = by_digits(self.first, np.arange(len(self.first), dtype=np.int32), 4), 8
        rank = dense_ranks(order, self.first)
        self.levels = [(depth, rank)]
        while depth < deepest:
            step = min(depth, deepest - depth)
            # The order so far, seen from ``step`` bytes before, is that of the second halves.
            order = order - np.int32(step)
            order = by_digits(rank[:-step], order[order >= 0], 2)
            rank, depth = dense_ranks(order, rank[:-step], rank[step:]), depth + step
            self.levels.append((depth, rank))

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``, up to the depth at least."""
        length = np.zeros(len(a), np.int32)
        for depth, rank in reversed(self.levels):
            within = length < self.deepest
            same = rank[np.where(within, a + length, 0)] == rank[np.where(within, b + length, 0)]
            length += np.int32(depth) * (within & same)
        # Fewer than eight bytes are left: the leading zero bytes of what differs.
        rest = length < self.deepest
        differs = self.first[a[rest] + length[rest]] ^ self.first[b[rest] + length[rest]]
        zeros = np.zeros(len(differs), np.int32)
        for step in (4, 2, 1):
            blank = differs >> np.uint64(64 - 8 * step) == 0
            zeros += np.int32(step) * blank
            differs = np.where(blank, differs << np.uint64(8 * step), differs)
        length[rest] += zeros
        return length


def previous_smaller(values: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last position before each with a smaller value (-1: none), and the least of ``common`` on the way.

    ``common[i]`` belongs to the step from ``i - 1`` to ``i``. All positions jump at
    once, each as far as the one that it points to, so ways double every round.
    """
    at, least = np.arange(-1, len(values) - 1, dtype=np.int32), common.copy()
    active = np.flatnonzero(at >= 0)
    while len(active := active[(at[active] >= 0) & (values[at[active]] >= values[active])]):
        over = at[active]
        least[active], at[active] = np.minimum(least[active], least[over]), at[over]
    return at, np.where(at >= 0, least, 0)


def longest_previous_factor(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in order: the longest prefix that one with a smaller value (document) has too."""
    before = previous_smaller(values, common)[1]
    behind = previous_smaller(values[::-1], np.append(common[:1], common[:0:-1]))[1][::-1]
    return np.maximum(before, behind)


def earlier_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges of each document that 50-byte strings with an earlier copy cover."""
    for bucket, rows in each_bucket(batches):
        if bucket < 0:
            for _, _, sizes, _, docs, places in rows:
                place = np.frombuffer(places, "<u4").reshape(-1, 2).astype(np.int64)
                yield ranges_of(np.frombuffer(docs, "<i8"), place[:, 1], place[:, 0], place[:, 0] + np.frombuffer(sizes, "<u4"))
            continue
        # Each distinct run of the bucket once.
        known: dict[bytes, int] = {}
        run, doc, at = [], [], []
        for _, data, sizes, local, docs, places in rows:
            edges = np.append(0, np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64))
            numbers = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip(edges, edges[1:], strict=False)])
            run.append(numbers[np.frombuffer(local, "<u4")].astype(np.int32))
            doc.append(np.frombuffer(docs, "<i8"))
            at.append(np.frombuffer(places, "<u4").reshape(-1, 2))
        run, doc, at = np.concatenate(run), np.concatenate(doc), np.concatenate(at)
        size = np.array([len(k) for k in known], np.int64)
        smallest = np.full(len(size), np.iinfo(np.int64).max)
        np.minimum.at(smallest, run, doc)

        # Suffixes that windows start, in their order. Whether a factor has LENGTH bytes shows at that depth.
        suffixes = Suffixes(END.join(known), LENGTH)
        begin = np.cumsum(size + 1) - size - 1
        windows = size - LENGTH + 1
        head = np.cumsum(windows) - windows
        # Positions in a bucket fit four bytes.
        owner = np.repeat(np.arange(len(size), dtype=np.int32), windows)
        start = (np.arange(windows.sum()) + np.repeat(begin - head, windows)).astype(np.int32)
        order = np.argsort(suffixes.levels[-1][1][start]).astype(np.int32)
        # A match ends where one of the two runs does.
        left = ((begin + size)[owner] - start).astype(np.int32)[order]
        common = np.zeros(len(order), np.int32)
        common[1:] = suffixes.common_prefix(start[order[:-1]], start[order[1:]])
        common[1:] = np.minimum(common[1:], np.minimum(left[:-1], left[1:]))
        factor = np.empty(len(order), np.int32)
        factor[order] = longest_previous_factor(smallest[owner[order]], common)
        covered = factor >= LENGTH
        del suffixes, owner, start, order, left, common, factor

        # Behind its smallest document a run is covered wholly, there window by window.
        for some in parts(np.flatnonzero(doc > smallest[run]), 16 * OCCURRENCES):
            low = at[some, 0].astype(np.int64)
            yield ranges_of(doc[some], at[some, 1], low, low + size[run[some]])
        some_covered = np.logical_or.reduceat(covered, head)
        for some in parts(np.flatnonzero((doc == smallest[run]) & some_covered[run]), OCCURRENCES):
            yield ranges_of(*matching_ranges(run[some], doc[some], at[some], covered, head, windows))


def parts(numbers: np.ndarray, length: int) -> Iterator[np.ndarray]:
    for i in range(0, len(numbers), length):
        yield numbers[i : i + length]


def ranges_of(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "tag", "low", "high"])


def matching_ranges(
    run: np.ndarray, doc: np.ndarray, at: np.ndarray, covered: np.ndarray, head: np.ndarray, windows: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Document, tag and byte ranges of the covered windows of these occurrences."""
    total = windows[run]
    place = np.repeat(np.arange(len(run)), total)
    step = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    kept = covered[head[run[place]] + step]
    place, step = place[kept], step[kept]
    first = np.flatnonzero(np.append(True, (np.diff(place) != 0) | (np.diff(step) != 1))) if len(place) else place
    last = np.append(first[1:], len(place))[: len(first)] - 1
    owner = place[first]
    low = at[owner, 0].astype(np.int64)
    return doc[owner], at[owner, 1], low + step[first], low + step[last] + LENGTH


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    return joined


def text_mark(text: str) -> Column:
    """128 bits that tell texts apart: the second hash runs over the text from another seed, not over the first hash."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b"))


def with_ranges(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """All rows of ``docs``: ``row`` (columns but the text), ``text``, ``ranges`` (unmerged), ``copied`` (cut it all)."""
    kept = [c for c in docs.columns if c != text_column]
    source = docs.select(
        F.struct(*kept).alias("row"),
        F.col(id_column).cast("long").alias("doc"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    mark = text_mark("text")
    compared = F.col("doc").isNotNull() & (F.octet_length("text") >= LENGTH)
    marks = source.where(compared).select("doc", mark.alias("mark"), F.octet_length("text").cast("long").alias("size"))
    firsts = marks.groupBy("mark").agg(F.min("doc").alias("doc"), F.first("size").alias("size"))
    buckets = (firsts.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES + 8
    firsts = firsts.groupBy("doc").agg(F.collect_list("mark").alias("marks"))
    # Outer joins of the same columns: all three steps read one shuffle of the texts.
    marked = source.join(firsts, "doc", "left").select(
        "row", "doc", "text", F.coalesce(F.array_contains("marks", mark), F.lit(False)).alias("original")
    )
    common = common_cells(docs.where(F.octet_length(text_column) >= LENGTH).select(F.col(text_column).alias("text")))
    # What a task sends depends on what it sent before, so its rows need an order of their own.
    order = ("doc", F.xxhash64("text"))
    packed = "bucket int, least binary, doc binary, first binary, count binary"
    first = marked.sortWithinPartitions(*order).mapInArrow(emit_runs(buckets, common), packed).repartition("bucket").sortWithinPartitions("bucket")
    shared = first.mapInArrow(shared_runs, "doc long, first long, count int, bucket int")
    wanted = shared.groupBy("doc").agg(F.collect_list(F.struct("first", "count", "bucket")).alias("runs"))
    packed = "bucket int, bytes binary, sizes binary, run binary, doc binary, at binary"
    second = marked.join(wanted, "doc", "left").select("row", "doc", "text", "original", "runs")
    second = second.sortWithinPartitions(*order).mapInArrow(emit_bytes, packed).repartition("bucket").sortWithinPartitions("bucket")
    ranges = second.mapInArrow(earlier_matches, "doc long, tag long, low long, high long")
    ranges = ranges.groupBy("doc").agg(F.collect_list(F.struct("tag", "low", "high")).alias("ranges"))
    return marked.join(ranges, "doc", "left").select(
        "row", "doc", "text", "ranges", (compared & ~F.col("original")).alias("copied")
    )


def own_spans(data: bytes, ranges: list[dict] | None, copied: bool | None) -> list[tuple[int, int]]:
    """Merged ranges of this text; those of another text with the same id are left out."""
    if copied:
        return [(0, len(data))]
    if not ranges:
        return []
    tag = zlib.crc32(data)
    return merged([(r["low"], r["high"]) for r in ranges if r["tag"] == tag])


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for span in spans for e in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without characters that they cover in part."""

    def inside(at: int) -> bool:
        return at < len(data) and data[at] >> 6 == 2

    shrunk = []
    for low, high in spans:
        while inside(low):
            low += 1
        while inside(high):
            high -= 1
        if low < high:
            shrunk.append((low, high))
    return shrunk


def cut_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``kept`` (remaining bytes), ``n_bytes`` and ``spans`` (removed byte ranges) of every row.

    Texts are UTF-8 bytes, a null text is empty. Ids are integers; rows without
    one keep their bytes and remove none elsewhere. Rows that share an id are
    compared with smaller ids only, so equal rows are cut alike. Texts under 50
    bytes stay whole. Rows are neither dropped nor merged.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, spans = [], [], []
            for text, ranges, copied in zip(*(batch.column(c).to_pylist() for c in USED), strict=True):
                data = text.encode()
                own = own_spans(data, ranges, copied)
                kept.append(without(data, own))
                sizes.append(len(data))
                spans.append([{"low": a, "high": b} for a, b in own])
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            arrays = [batch.column(id_column), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(arrays, [id_column, "kept", "n_bytes", "spans"])

    found = with_ranges(docs.select(id_column, text_column), id_column, text_column)
    columns = f"{id_column} {docs.schema[id_column].dataType.simpleString()}"
    columns += ", kept binary, n_bytes long, spans array<struct<low:long,high:long>>"
    return found.select(f"row.{id_column}", *USED).mapInArrow(cut, columns)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without its repeats, as far as they are whole characters."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, ranges, copied in zip(*(batch.column(c).to_pylist() for c in USED), strict=True):
                data = text.encode()
                kept.append(without(data, whole_characters(data, own_spans(data, ranges, copied))).decode())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string())], ["row", "kept"])

    found = with_ranges(docs, id_column, text_column)
    kind = found.schema["row"].dataType.simpleString()
    return found.mapInArrow(cut, f"row {kind}, kept string").select(
        *(F.col("kept").alias(c) if c == text_column else F.col(f"row.{c}") for c in docs.columns)
    )
