"""SimHash near-duplicates: shingle fingerprints, pigeonhole blocks, verified distances, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.llm.batches import map_texts
from silverair.llm.components import smallest_reachable
from silverair.session import materialise

BITS = 64
SEED = 42
# A block of more distinct fingerprints is divided further.
CROWD = 4096


def fingerprint(text: str, words: int) -> int:
    """A bit is set if over half of the shingle hashes have it; no shingle gives 0."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    total = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65_536 + 1):
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id and ``fingerprint`` (64 bits as a signed long) of every row."""

    return map_texts(docs, id_column, text_column, "fingerprint long", _prints(words))


def _prints(words: int) -> Callable:
    def worker():
        def work(texts: list[str]) -> list[np.ndarray]:
            return [np.array([fingerprint(t, words) for t in texts], "<u8").view("<i8")]

        return work

    return worker


def block_masks(distance: int) -> list[int]:
    """Masks of three blocks out of ``distance + 3``: close fingerprints agree under one of them."""
    edges = np.linspace(0, BITS, distance + 4).astype(int)
    blocks = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [a | b | c for a, b, c in combinations(blocks, 3)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def inner_masks(mask: int, distance: int) -> list[int]:
    """The bits outside ``mask`` in ``distance + 2`` parts, by two: close fingerprints agree under one of them."""
    outside = [b for b in range(BITS) if not mask >> b & 1]
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(outside, distance + 2)]
    masks = [a | b for a, b in combinations(parts, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def spanning_links(prints: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links within ``distance`` that connect what all such links connect, at most one per fingerprint."""
    label = np.arange(len(prints))
    for i in range(len(prints) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= distance)
        for j in near[label[near] != label[i]]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield i, int(j)


def close_links(prints: DataFrame, distance: int, crowd: int = CROWD) -> DataFrame:
    """Verified links (a, b) between the nodes of distinct ``prints`` (node, fingerprint).

    A block is a masked fingerprint: distinct fingerprints that differ in the bits
    outside three blocks only, so copies cannot fill it. One of more than ``crowd``
    rows, such as texts of one template, is dealt out again by two parts of the
    bits that are left, so that no task gets it whole and its work is not
    quadratic in its size. Close fingerprints share one of these parts too, so no link is lost.
    Links come out as a spanning forest of each group, never as all pairs.
    """
    masks = block_masks(distance)
    keyed = prints.select(
        "node",
        "fingerprint",
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "block"),
    )
    # Few blocks are crowded: at most one for every ``crowd`` rows of a mask.
    crowded = keyed.groupBy("mask", "block").count().where(F.col("count") > crowd).select("mask", "block", F.lit(True).alias("crowded"))
    inner = F.array(*[F.array(*[F.lit(m).cast("long") for m in inner_masks(mask, distance)]) for mask in masks])
    parts = F.transform(inner[F.col("mask")], lambda m, i: F.struct(i.alias("part"), F.col("fingerprint").bitwiseAND(m).alias("inside")))
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("inside")))
    group = ["mask", "block", "part", "inside"]
    dealt = keyed.join(crowded, ["mask", "block"], "left").select(
        "node", "fingerprint", "mask", "block", F.inline(F.when(F.col("crowded"), parts).otherwise(whole))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = [column.to_numpy() for column in batch.columns]
            held = part if held is None else [np.concatenate(x) for x in zip(held, part, strict=True)]
            starts = group_starts(held)
            # The last group may go on in the next batch.
            cut = int(starts[-1])
            if cut:
                yield links([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None:
            yield links(held)

    def group_starts(columns: list[np.ndarray]) -> np.ndarray:
        new = np.logical_or.reduce([key[1:] != key[:-1] for key in columns[2:]])
        return np.append(0, np.flatnonzero(new) + 1)

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        node, prints = columns[:2]
        starts = group_starts(columns)
        ends = np.append(starts[1:], len(node))
        many = ends - starts > 1
        found = [
            (node[s + i], node[s + j])
            for s, e in zip(starts[many], ends[many], strict=True)
            for i, j in spanning_links(prints[s:e].view(np.uint64), distance)
        ]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "fingerprint")
    return ordered.select("node", "fingerprint", *group).mapInArrow(scan, "a long, b long")


def components(
    docs: DataFrame, words: int = 3, distance: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row's id, ``fingerprint`` (long) and ``component_id``, the smallest id it is linked to.

    Fingerprints within ``distance`` bits are linked. Equal fingerprints are
    folded to one node before the join on blocks, so a text with very many copies
    is one row there. A null or empty text has fingerprint 0 and is linked like
    any other. Rows with a null id keep it; their component is the smallest id of
    their fingerprint's component, null if that has none. Repeated rows give
    repeated results.
    """
    prints = materialise(fingerprints(docs, words, id_column, text_column), "simhash")
    nodes = materialise(prints.groupBy("fingerprint").agg(F.min(id_column).alias("smallest")), "simhash-nodes")
    grouped = nodes.join(roots(nodes, distance), "fingerprint")
    smallest = grouped.groupBy("root").agg(F.min("smallest").alias("component_id"))
    known = grouped.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(known, "fingerprint").select(id_column, "fingerprint", "component_id")


def roots(nodes: DataFrame, distance: int) -> DataFrame:
    """``root`` of every distinct ``fingerprint``: the smallest one that links lead to."""
    # Fingerprints are the nodes of the graph: they exist for rows without id too.
    linked = nodes.select(F.col("fingerprint").alias("node"), "fingerprint")
    labels = smallest_reachable(materialise(close_links(linked, distance).distinct(), "simhash-links"))
    labels = labels.select(F.col("node").alias("fingerprint"), "root")
    return nodes.select("fingerprint").join(labels, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def first_of_each(
    docs: DataFrame,
    words: int = 3,
    distance: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row of each component, with its ``columns`` (all by default).

    It is the row with the smallest id; rows without id come last, and rows of one
    id go by a digest of all columns. Ids need be neither unique nor there: rows that are not
    linked all stay, whatever their ids. Of equal rows one stays.
    """
    columns = list(columns or docs.columns)
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    marked = docs.select(*columns, row.alias("row_digest"))
    # Short columns only are written; the texts are read again.
    printed = map_texts(marked, id_column, text_column, "row_print long", _prints(words), carry=[id_column, "row_digest"])
    rows = materialise(printed, "simhash-rows")
    nodes = materialise(rows.select(F.col("row_print").alias("fingerprint")).distinct(), "simhash-nodes")
    keyed = rows.join(roots(nodes, distance).withColumnRenamed("fingerprint", "row_print"), "row_print")
    order = F.struct(F.col(id_column).isNull(), F.col(id_column), F.col("row_digest"))
    kept = keyed.groupBy("root").agg(F.min_by("row_digest", order).alias("row_digest")).select("row_digest")
    # Equal rows share their digest.
    return marked.join(kept, "row_digest", "left_semi").dropDuplicates(["row_digest"]).select(*columns)
