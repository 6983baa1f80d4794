"""Benchmark leaks by spaced seeds.

Texts become lower-case tokens of letters and digits. Each fixed mask picks six
positions of a window and ignores the others; their hash is a seed. Test and
training seeds are joined, and each hit is verified by comparing the tokens
around it. A leak is a window of 13 tokens that agrees in at least 11 places.
Whatever two places differ, a window of 13 has a seed under one of the masks that
avoids both, so the join misses no leak. Items of 9 to 12 tokens form one window
that may differ in one place, items of 7 or 8 tokens must agree fully. Shorter
ones are too common to tell and never match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.session import materialise

MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8))
SPANS = tuple(m[-1] + 1 for m in MASKS)
WINDOW = 13
SHORTEST = min(SPANS)
# Tokens before a hit that a matching window may begin with.
BEFORE = WINDOW - SHORTEST
# Tokens of a text that are worked on in one row, beside those around them.
PIECE = 64
SEEDS = "array<struct<at: int, seed: bigint>>"
# Seeds that may be broadcast, some 100 MB as a hash table; items hold less.
# Larger benchmarks are joined by a shuffle of seeds; hits then fetch their piece.
BROADCAST_SEEDS = 2_000_000


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def pieces(texts: DataFrame) -> DataFrame:
    """Rows of ``hashes`` as pieces: ``size`` of the whole, ``start`` and the hashes (``part``, from ``first`` on) around it.

    Seeds belong to the piece that they start in. A piece holds what any of them
    needs, so rows behind it have a bounded size however long the text is.
    """
    size = F.size("hashes")

    def cut(start: Column) -> Column:
        first = F.greatest(start - BEFORE, F.lit(0))
        part = F.slice("hashes", first + 1, start + (PIECE + WINDOW - 1) - first)
        return F.struct(start.alias("start"), first.alias("first"), part.alias("part"))

    cuts = F.transform(F.sequence(F.lit(0), size - 1, F.lit(PIECE)), cut)
    long_enough = texts.where(size >= SHORTEST)
    return long_enough.select(*[c for c in texts.columns if c != "hashes"], size.alias("size"), F.inline(cuts))


def with_seeds(parts: DataFrame) -> DataFrame:
    """One row per seed of ``pieces``: ``seed`` and ``at``, the token that its window starts with."""

    def under(number: int) -> Column:
        end = F.least(F.col("start") + PIECE, F.col("size") - (SPANS[number] - 1))

        def seed(at: Column) -> Column:
            picked = [F.get("part", at - F.col("first") + o) for o in MASKS[number]]
            return F.struct(at.alias("at"), F.xxhash64(F.lit(number), *picked).alias("seed"))

        starts = F.sequence(F.col("start"), F.greatest(end - 1, F.col("start")))
        return F.when(end > F.col("start"), F.transform(starts, seed)).otherwise(F.array().cast(SEEDS))

    return parts.select("*", F.inline(F.concat(*map(under, range(len(MASKS))))))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """One row per document and item that share a window.

    Columns: ids, ``matched`` (most places that agree in one window), ``window``
    (its length), and the tokens ``first_token`` to ``last_token`` of the document that
    matching windows span. Null and empty texts have no tokens and never match.
    Repeated rows of one id and item fold into one row; ids may be null.

    Work and memory grow with the tokens of a text, not with their square. Scripts
    without spaces form a few long tokens, so short leaks in them are not found.
    ``broadcast_seeds`` chooses the join, not the result.
    """
    items = benchmark.select(F.col(item_column).alias("item"), tokens(F.col(item_text)).alias("hashes"))
    items = items.where(F.size("hashes") >= SHORTEST).select(F.xxhash64("item", "hashes").alias("copy"), "*").distinct()
    seeds = with_seeds(pieces(items)).select("seed", "copy", F.col("at").alias("item_at"))
    sides = items.select("copy", "item", F.col("hashes").alias("item_hashes"))
    source = pieces(docs.select(F.col(id_column).alias("id"), tokens(F.col(text_column)).alias("hashes")))
    if seeds.count() <= broadcast_seeds:
        hits = with_seeds(source).join(F.broadcast(seeds), "seed").join(F.broadcast(sides), "copy")
    else:
        source = materialise(source.withColumn("piece", F.monotonically_increasing_id()), "pieces")
        found = with_seeds(source).select("seed", "piece", "at").join(seeds, "seed").drop("seed")
        hits = found.join(source, "piece").join(sides, "copy")

    # Item tokens around the hit that the document covers, and the document's beside them.
    shift = F.col("at") - F.col("item_at")
    low = F.greatest(F.col("item_at") - BEFORE, -shift, F.lit(0))
    high = F.least(F.col("item_at") + WINDOW, F.size("item_hashes"), F.col("size") - shift)
    hits = hits.select("id", "item", "first", "part", "item_hashes", shift.alias("shift"), low.alias("low"), (high - low).alias("n"))
    window = F.least(F.lit(WINDOW), F.size("item_hashes"))
    same = F.zip_with(
        F.slice("part", F.col("shift") + F.col("low") - F.col("first") + 1, F.col("n")),
        F.slice("item_hashes", F.col("low") + 1, F.col("n")),
        lambda a, b: (a == b).cast("int"),
    )
    compared = hits.select("id", "item", "n", window.alias("window"), (F.col("shift") + F.col("low")).alias("from"), same.alias("same"))
    compared = compared.where(F.col("n") >= F.col("window"))
    agree = F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("window")),
        lambda k: F.struct(
            F.aggregate(F.slice("same", k + 1, F.col("window")), F.lit(0), lambda a, x: a + x).alias("matched"), k.alias("k")
        ),
    )
    allowed = F.when(F.col("window") >= WINDOW, 2).when(F.col("window") >= 9, 1).otherwise(0)
    scored = compared.select("id", "item", "window", "from", agree.alias("agree"), allowed.alias("allowed"))
    good = scored.withColumn("good", F.filter("agree", lambda a: a["matched"] >= F.col("window") - F.col("allowed")))
    good = good.where(F.size("good") > 0)
    return (
        good.groupBy("id", "item")
        .agg(
            F.max(F.array_max("good.matched")).cast("long").alias("matched"),
            F.max("window").cast("long").alias("window"),
            F.min(F.col("from") + F.array_min("good.k")).cast("long").alias("first_token"),
            F.max(F.col("from") + F.array_max("good.k") + F.col("window") - 1).cast("long").alias("last_token"),
        )
        .withColumnsRenamed({"id": id_column, "item": item_column})
    )
