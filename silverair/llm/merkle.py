"""A Merkle manifest of a table: content-addressed records, and proofs by descent from the root.

Rows become leaves, ordered by id inside a group. Every run of three neighbours
becomes their digest until one node of the group is left, and the groups' tops
form a last tree in the same way. A record of the store maps a digest to its
children, down to LEVELS levels at a time, so a tree of n leaves is built and
descended in log81(n) passes. All of it is SQL functions.

Requests for leaves descend from the root. Each record on the way is opened once
for all requests below it; the digits of a rank in base three choose the child
at each level, and the children that were not chosen become the next segment of
the path. Reversed, the segments fold a leaf up to the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.operators.lookup import lookup_join
from silverair.operators.ranking import number_rows
from silverair.session import materialise

RUN = 3
LEVELS = 4
PAGE = RUN**LEVELS
PATH = "array<struct<left: string, right: string>>"


def digest(column: Column) -> Column:
    return F.sha2(column, 256)


def field(column: Column) -> Column:
    """A value with its length in UTF-8 bytes, so that neighbouring fields cannot run into each other; null is ``-``."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: of its fields, one behind the other."""
    return digest(F.concat(*map(field, columns)))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: group, id, leaf, carried columns, and the rank ``pos`` in a tree of ``size`` leaves.
    ``tops``: ``tree``, its size and subroot. ``store``: records by digest, with the pass that opens them.
    ``largest``: leaves of the largest tree. ``groups``: their number. ``root``: None for an empty table.
    """

    leaves: DataFrame
    tops: DataFrame
    store: DataFrame
    largest: int
    groups: int
    root: str | None


def passes_of(size: int) -> int:
    """Passes that fold ``size`` nodes into one."""
    count, nodes = 0, size
    while nodes > 1:
        count, nodes = count + 1, -(-nodes // PAGE)
    return count


def pass_of(size: str) -> Column:
    """``passes_of`` for a column, exact where logarithms would round."""
    steps = F.when(F.col(size) <= 1, 0)
    for count, bound in enumerate((PAGE**k for k in range(1, 10)), 1):
        steps = steps.when(F.col(size) <= bound, count)
    return steps


def _levels(nodes: Column, size: Column) -> Column:
    """The levels of a page, from its nodes up to its top; a tree ends where one node is left."""
    height = F.lit(0)
    for k in range(LEVELS):
        height = height + (size > RUN**k).cast("int")
    steps = F.slice(F.array(*[F.lit(k) for k in range(LEVELS)]), F.lit(1), height)

    def above(below: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(below) / RUN).cast("int") - 1)
        return F.transform(runs, lambda i: digest(F.array_join(F.slice(below, i * RUN + 1, F.lit(RUN)), "")))

    return F.aggregate(steps, F.array(nodes), lambda made, _: F.concat(made, F.array(above(F.element_at(made, -1)))))


def _build(nodes: DataFrame, largest: int, label: str) -> tuple[DataFrame, list[DataFrame]]:
    """Tops (tree, size, digest) and records of trees given as (tree, pos, size, digest)."""
    tops, records = [], []
    for step in range(1, max(passes_of(largest), 1) + 1):
        # A page holds PAGE neighbours at most, so no group grows with the data.
        pages = nodes.groupBy("tree", "leaves", "size", F.expr(f"pos div {PAGE}").alias("pos")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("nodes")
        )
        pages = pages.select("tree", "leaves", "size", "pos", _levels(F.col("nodes.digest"), F.col("size")).alias("levels"))
        pages = pages.withColumn("digest", F.element_at(F.element_at("levels", -1), 1))
        pages = materialise(pages, f"merkle-{label}")
        tops.append(pages.where(F.col("size") <= PAGE).select("tree", "leaves", "digest"))
        records.append(pages.where(F.size("levels") > 1).select(F.lit(step).alias("step"), "digest", "levels"))
        nodes = pages.where(F.col("size") > PAGE).select(
            "tree", "leaves", F.expr(f"(size + {PAGE - 1}) div {PAGE}").alias("size"), "pos", "digest"
        )
    done = tops[0]
    for more in tops[1:]:
        done = done.unionByName(more)
    return done.withColumnRenamed("leaves", "size"), records


def build(
    docs: DataFrame,
    columns: Sequence[str],
    id_column: str = "doc_id",
    group_column: str = "source",
    carry: Sequence[Column] = (),
) -> Manifest:
    """The manifest of all rows of ``docs``; each leaf is the digest of its ``columns``.

    Leaves ascend by id (null first), those of a repeated id by digest, so equal
    rows are leaves of their own. Groups ascend bytewise, null first, and a group of
    one leaf has that leaf as subroot. Null fields count as such, empty and very
    long texts like any other. ``carry`` are named columns that stay with the leaves.
    An empty table has no leaves and no root. Other columns are not read.

    Texts are read and hashed once; only digests are written and shuffled. Ranks come
    from a range sort, so a group that holds most rows is spread like any other.
    """
    leaf = leaf_digest([F.col(c) for c in columns]).alias("leaf")
    rows = docs.select(F.col(group_column).alias("group"), F.col(id_column).alias("id"), leaf, *carry)
    rows = materialise(rows, "merkle-rows")
    order = [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf")]
    ranked = number_rows(rows, order, "rank").withColumn("group_key", field(F.col("group")))
    groups = ranked.groupBy("group_key").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("size"))
    trees = materialise(number_rows(groups, ["first"], "tree"), "merkle-trees")
    largest, count = trees.agg(F.coalesce(F.max("size"), F.lit(0)), F.count(F.lit(1))).first()
    placed = lookup_join(ranked, trees, ["group_key"], ["rank"])
    leaves = placed.withColumn("pos", F.col("rank") - F.col("first")).drop("rank", "first", "group_key")

    nodes = leaves.select("tree", F.col("size").alias("leaves"), "size", "pos", F.col("leaf").alias("digest"))
    tops, records = _build(nodes, largest, "leaves")
    above = tops.select(
        F.lit(0).alias("tree"), F.lit(count).alias("leaves"), F.lit(count).alias("size"), (F.col("tree") - 1).alias("pos"), "digest"
    )
    root, upper = _build(above, count, "groups")
    first = root.first()
    # The steps of the upper tree are kept apart by their sign.
    parts = [*records, *(u.withColumn("step", -F.col("step")) for u in upper)]
    store = parts[0]
    for part in parts[1:]:
        store = store.unionByName(part)
    store = materialise(store.dropDuplicates(["step", "digest"]), "merkle-store")
    return Manifest(leaves, tops, store, largest, count, first.digest if first else None)


def _segment(levels: Column, place: Column) -> Column:
    """The children that are not chosen on the way from the top of ``levels`` down to node ``place``."""
    powers = F.array(*[F.lit(RUN**k).cast("long") for k in range(LEVELS)])

    def at(k: Column) -> Column:
        node = F.floor(place / F.element_at(powers, k + 1)).cast("int")
        digit, row = node % RUN, F.element_at(levels, k + 1)
        left = F.array_join(F.slice(row, node - digit + 1, digit), "")
        right = F.array_join(F.slice(row, node + 2, RUN - 1 - digit), "")
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.sequence(F.size(levels) - 2, F.lit(0), F.lit(-1)), at)


def _descend(requests: DataFrame, starts: DataFrame, store: DataFrame, passes: int, sign: int) -> DataFrame:
    """``requests`` (tree, pos, size, …) with the ``found`` digest and the ``path`` from the root down to it.

    ``starts`` has a row per tree: tree, size, subroot and the path down to it. The
    frontier holds the pages that requests ask for, each once.
    """
    names = ["tree", "subroot", "page", "digest", "path"]
    heads = starts.withColumns({"digest": F.col("subroot"), "page": F.lit(0).cast("long"), "start": pass_of("size")})
    alone = requests.where("size = 1").join(heads.where("start = 0").select("tree", "subroot", "path"), "tree")
    results = [alone.withColumn("found", F.col("subroot"))]
    frontier = None
    for step in range(passes, 0, -1):
        here = heads.where(F.col("start") == step).select(*names)
        at = here if frontier is None else frontier.unionByName(here)
        opened = at.join(store.where(F.col("step") == sign * step).select("digest", "levels"), "digest")
        if step > 1:
            wanted = requests.select("tree", F.expr(f"pos div {PAGE ** (step - 1)}").alias("page")).distinct()
            inner = opened.select("*", F.posexplode(F.element_at("levels", 1)).alias("place", "child"))
            inner = inner.select(
                "tree",
                "subroot",
                (F.col("page") * PAGE + F.col("place")).alias("page"),
                F.col("child").alias("digest"),
                F.concat("path", _segment(F.col("levels"), F.col("place"))).alias("path"),
            )
            frontier = materialise(inner.join(wanted, ["tree", "page"], "left_semi").select(*names), "merkle-frontier")
        else:
            asked = requests.where("size > 1").withColumn("page", F.expr(f"pos div {PAGE}"))
            joined = asked.join(opened.drop("digest"), ["tree", "page"])
            place = F.col("pos") % PAGE
            results.append(
                joined.withColumns(
                    {
                        "found": F.element_at(F.element_at("levels", 1), (place + 1).cast("int")),
                        "path": F.concat("path", _segment(F.col("levels"), place)),
                    }
                ).drop("page", "levels")
            )
    made = results[0]
    for more in results[1:]:
        made = made.unionByName(more)
    return made


def prove(spark: SparkSession, manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Requested leaves with ``subroot``, ``found`` (the digest that the descent ends at) and ``path``.

    ``requests`` are rows of ``manifest.leaves``, all by default. ``path`` leads from
    the leaf up to the root: the siblings ``left`` and ``right`` of the node at each level.
    """
    requests = manifest.leaves if requests is None else requests
    count = F.lit(manifest.groups).cast("long").alias("size")
    root = F.lit(manifest.root).cast("string").alias("subroot")
    top = spark.range(min(manifest.groups, 1)).select(F.col("id").alias("tree"), count, root, F.array().cast(PATH).alias("path"))
    wanted = requests.select("tree").distinct()
    trees = manifest.tops.join(wanted, "tree", "left_semi").select(
        F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("pos"), count, F.col("size").alias("leaves")
    )
    # Written, so that the join is one on a column and not one on a constant.
    trees = materialise(trees, "merkle-asked")
    subroots = _descend(trees, top, manifest.store, passes_of(manifest.groups), -1)
    starts = subroots.select((F.col("pos") + 1).alias("tree"), F.col("leaves").alias("size"), F.col("found").alias("subroot"), "path")
    starts = materialise(starts, "merkle-starts")
    found = _descend(requests, starts, manifest.store, passes_of(manifest.largest), 1)
    return found.withColumn("path", F.reverse("path"))


def proof_digest(path: str = "path") -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: str, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, F.col(leaf), lambda node, s: digest(F.concat(s["left"], node, s["right"])))
