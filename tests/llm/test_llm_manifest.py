from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from silverair.llm import merkle
from silverair.llm.queries import LEAF_COLUMNS, QUERIES, SQL

from suite.compare import bag, connect


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def plain_siblings(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    path = []
    for level in levels[:-1]:
        first = place - place % 3
        path.append(("".join(level[first:place]), "".join(level[place + 1 : first + 3])))
        place //= 3
    return path


def plain_manifest(rows: list[dict], altered=lambda r: r["text"]) -> list[tuple]:
    """The contract in plain Python: (doc_id, leaf, subroot, root, proof, folded root)."""
    groups: dict = {}
    for r in rows:
        leaf = h(*(plain_field(r[c]) for c in LEAF_COLUMNS))
        other = h(*(plain_field(altered(r) if c == "text" else r[c]) for c in LEAF_COLUMNS))
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, other, r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_levels([m[2] for m in sorted(groups[s])]) for s in order]
    top = plain_levels([t[-1][0] for t in trees]) if trees else [[]]
    made = []
    for number, (source, tree) in enumerate(zip(order, trees, strict=True)):
        for place, (_, _, leaf, other, doc_id) in enumerate(sorted(groups[source])):
            path = plain_siblings(tree, place) + plain_siblings(top, number)
            node = other
            for left, right in path:
                node = h(left, node, right)
            proof = h(*(left + right for left, right in path))
            made.append((doc_id, leaf, tree[-1][0], top[-1][0], proof, node))
    return made


def tampered_text(r: dict):
    crc = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
    return r["text"].replace("\n", "") if crc and r["text"] is not None else r["text"]


def proofs(spark, manifest, requests=None, leaf: str = "leaf") -> list[tuple]:
    found = merkle.prove(spark, manifest, requests).withColumn("node", merkle.fold(leaf))
    rows = found.select("id", "leaf", "subroot", "found", merkle.proof_digest().alias("proof"), "node").collect()
    assert all(r.found == r.leaf for r in rows)
    return [(r.id, r.leaf, r.subroot, manifest.root, r.proof, r.node) for r in rows]


def as_dicts(frame) -> list[dict]:
    return [r.asDict() for r in frame.select(*LEAF_COLUMNS).collect()]


def same(got: list[tuple], want: list[tuple]) -> bool:
    return sorted(map(str, got)) == sorted(map(str, want))


def test_query_equals_plain_code_and_sql(spark, folder, documents):
    frame = QUERIES["op13_merkle_manifest"](spark, folder)
    rows = frame.collect()
    assert same([tuple(r)[:6] for r in rows], plain_manifest(as_dicts(documents), tampered_text))
    assert all(r.verified == (r.folded_root == r.root) for r in rows) and {r.verified for r in rows} == {True, False}
    answer = connect(folder).execute(SQL["op13_merkle_manifest"])
    names = [d[0] for d in answer.description]
    assert bag(frame.columns, [tuple(r) for r in rows]) == bag(names, answer.fetchall())


def test_nulls_ties_and_repeated_rows(spark, edge):
    sources = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") == 7, "é").otherwise(F.col("source"))
    docs = edge.withColumn("source", sources).withColumn("lang", F.when(F.col("doc_id") > 4, F.col("lang")))
    docs = docs.withColumns({"tree": F.lit("x"), "leaf": F.lit(1), "size": F.lit(None).cast("int"), "path": F.lit(0)})
    manifest = merkle.build(docs, LEAF_COLUMNS)
    assert same(proofs(spark, manifest), plain_manifest(as_dicts(docs)))


@pytest.mark.parametrize("count", [0, 1, 90])
def test_a_group_per_row(spark, count):
    docs = spark.range(count).selectExpr(
        "id as doc_id", "concat('s', id) as source", "'en' as lang", "id * 2 as n_chars", "concat('t', id % 7) as text"
    )
    manifest = merkle.build(docs, LEAF_COLUMNS)
    assert (manifest.root is None) == (count == 0)
    assert same(proofs(spark, manifest), plain_manifest(as_dicts(docs)))


def test_trees_of_every_height(spark):
    """Groups of 1 to 5, 9, 10, 27, 28, 81, 82 and 250 leaves."""
    sizes = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 9, 10, 27, 28, 81, 82, 250)], "n int")
    docs = sizes.selectExpr("n", "explode(sequence(1, n)) as doc_id").selectExpr(
        "cast(doc_id as long) as doc_id", "concat('s', n) as source", "'en' as lang", "1 as n_chars", "'t' as text"
    )
    assert same(proofs(spark, merkle.build(docs, LEAF_COLUMNS)), plain_manifest(as_dicts(docs)))


def test_three_passes_of_one_hot_group(spark):
    """7,000 leaves of one group beside small groups: ranks above 81 squared."""
    docs = spark.range(7_100).selectExpr(
        "id as doc_id", "if(id < 7000, 'hot', concat('s', id % 9)) as source", "'en' as lang", "id as n_chars", "cast(id as string) as text"
    )
    manifest = merkle.build(docs, LEAF_COLUMNS)
    want = plain_manifest(as_dicts(docs))
    assert same(proofs(spark, manifest), want)
    # Fewer requests give the same proofs of the leaves that are asked for.
    asked = manifest.leaves.where("id % 1000 = 3")
    assert same(proofs(spark, manifest, asked), [w for w in want if w[0] % 1000 == 3])


def test_store_is_addressed_by_content(spark, documents):
    manifest = merkle.build(documents, LEAF_COLUMNS)
    records = manifest.store.collect()
    assert len({(r.step, r.digest) for r in records}) == len(records)
    for r in records:
        assert plain_levels(r.levels[0]) == r.levels if len(r.levels) <= merkle.LEVELS else r.levels[-1] == [r.digest]
        assert len(r.levels[0]) <= merkle.PAGE
    tampered = F.concat("leaf", F.lit("0"))
    rows = merkle.prove(spark, manifest).withColumn("bad", merkle.digest(tampered)).withColumn("node", merkle.fold("bad")).collect()
    assert rows and all(r.node != manifest.root for r in rows)


def test_no_python_and_no_text_in_a_shuffle(spark, documents):
    manifest = merkle.build(documents, LEAF_COLUMNS)
    plan = merkle.prove(spark, manifest)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan and "text" not in manifest.leaves.columns
