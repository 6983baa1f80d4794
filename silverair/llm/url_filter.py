"""URL rules, and a list of blocked URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverair.session import materialise

# A block of the filter has 4 words of 64 bits; a key sets one bit of each word.
WORDS = 4
KEYS_PER_BLOCK = 16
# Blocks of a filter that may be broadcast: 48 bytes each, some 50 MB in all.
# A larger filter is joined on the block number like any other table.
BROADCAST_BLOCKS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.``, ``m.`` or ``blog.``, and path without ``.html`` or a slash at its end."""
    return F.concat(F.regexp_replace(host, r"^(www|m|blog)\.", ""), F.regexp_replace(path, r"(\.html|/)$", ""))


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of its name and action; the first of equally long ones."""
    longest_first = sorted(rules, key=lambda r: -len(r.name))
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(longest_first):
        inside = (host == rule.host) | host.endswith(f".{rule.host}")
        found = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("verdict"))
        fits = F.when(inside & path.startswith(rule.path), found).otherwise(fits)
    return fits


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    mixed = F.xxhash64(key, F.lit("bits"))
    places = [F.shiftright(mixed, 6 * i).bitwiseAND(63).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``block`` and its words for the ``key`` column of ``listed``; blocks without a key have no row."""
    words = [F.bit_or(b).alias(f"word{i}") for i, b in enumerate(_bits(F.col("key")))]
    return listed.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*words)


def listed_keys(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct ``key`` values of ``keys`` that are in ``listed``.

    The filter passes all listed keys and a few others; the exact hash join
    behind it removes those. Its size follows the list: 16 keys to a block.
    """
    # Counted, folded into the filter and joined: written once instead of derived three times.
    listed = materialise(listed.select("key").where("key is not null").distinct(), "listed")
    blocks = listed.count() // KEYS_PER_BLOCK + 1
    words = bloom_filter(listed, blocks)
    words = F.broadcast(words) if blocks <= BROADCAST_BLOCKS else words
    probed = keys.select("key", _block(F.col("key"), blocks).alias("block")).join(words, "block")
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col("key"))):
        hit &= F.col(f"word{i}").bitwiseAND(bit) != 0
    return probed.where(hit).select("key").distinct().join(listed.hint("shuffle_hash"), "key", "left_semi")


def judge(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    The verdict is that of the longest rule that fits; without one, ``block`` if
    the canonical URL is in ``listed`` (column ``key``) and ``allow`` if not. A null
    URL, or one without ``://``, has empty host and path and is allowed. Rows are
    neither dropped nor merged, and other columns are not read.
    """
    url = F.col(url_column)
    split = pages.select(F.col(id_column), host_of(url).alias("host"), path_of(url).alias("path"))
    fit = split.withColumn("fit", first_rule(F.col("host"), F.col("path"), rules))
    keyed = fit.withColumn("key", canonical(F.col("host"), F.col("path")))
    # URLs with a rule of their own need no look at the list.
    asked = keyed.where("fit is null and host <> ''")
    known = listed_keys(asked, listed).select("key", F.lit("block").alias("listed"))
    verdict = F.coalesce("fit.verdict", F.when(F.col("host") != "", F.col("listed")), F.lit("allow"))
    return keyed.join(known, "key", "left").select(
        id_column, "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict")
    )
