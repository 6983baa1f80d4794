"""Keys, quotes, lists and first-present values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def natural_key(separator: str, *parts: Column | str) -> Column:
    """Text key; NULL parts are skipped and the result is never NULL."""
    return F.concat_ws(separator, *[as_column(p).cast("string") for p in parts])


def strip_quotes(text: Column | str) -> Column:
    """Remove one leading and one trailing double quote; keep inner ones.

    A trailing quote may stand before a final line break. Only such text needs
    the pattern; for the rest a substring is several times cheaper.
    """
    text = as_column(text)
    leading, trailing = (test(text, F.lit('"')).cast("int") for test in (F.startswith, F.endswith))
    inner = F.substr(text, leading + 1, F.length(text) - leading - trailing)
    ends_in_break = F.right(text, F.lit(1)).isin("\n", "\r", "\u0085", "\u2028", "\u2029")
    return F.when(ends_in_break, F.regexp_replace(text, '^"|"$', "")).otherwise(inner)


def equals_unquoted(text: Column | str, value: str) -> Column:
    """``strip_quotes(text) = value``, written so that it reaches a parquet scan."""
    return as_column(text).isin(value, f'"{value}', f'{value}"', f'"{value}"')


def first_present(*candidates: Column | str) -> Column:
    """First candidate that is neither NULL nor empty text."""
    return F.coalesce(*[F.nullif(as_column(c), F.lit("")) for c in candidates])


def list_items(text: Column | str, separator: str = ",") -> Column:
    """Split a separated list, trim the items and drop blank ones."""
    parts = F.transform(F.split(as_column(text), separator), lambda item: F.trim(item))
    return F.filter(parts, lambda item: item != "")


def tagged(name: str, value: Column) -> Column:
    """``name=value``; a present tag without a value reads as ``None``."""
    return F.concat(F.lit(f"{name}="), F.coalesce(value, F.lit("None")))
