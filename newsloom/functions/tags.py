"""Tag normalization."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip


def _empty() -> Column:
    return F.array().cast("array<string>")


def normalize_list(tags: Column) -> Column:
    """Trim the entries of a tag list; nulls and blanks go, null becomes empty."""
    kept = F.filter(F.transform(tags, strip), lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(kept, _empty())


def split_tags(text: Column) -> Column:
    """Tags from comma separated text; null becomes empty."""
    return normalize_list(F.split(text, ","))


def default_tags(tags: Column, default: Iterable[str] = ()) -> Column:
    """The given list, or the default where there is none."""
    fallback = F.array(*[F.lit(t) for t in default]).cast("array<string>")
    return F.coalesce(tags, fallback)
