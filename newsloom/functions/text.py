"""Whitespace handling and text defaults."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separators 1C-1F, which count as white space in the
# collected text but not in Java's \s.
SPACE = r"[\s\x1c-\x1f]"
# Fixed value: title of an article that has none.
DEFAULT_TITLE = "Sem título"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    The body must use no other columns (pass several as a struct): the optimizer could move a
    Python UDF into it, where Spark cannot run one.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def groups(text: Column, pattern: str, count: int) -> Column:
    """Array of a pattern's first ``count`` groups from one match; null without a match."""
    marked = F.regexp_replace(text, pattern, "\x00".join(f"${g}" for g in range(1, count + 1)))
    return F.when(text.rlike(pattern), F.split(marked, "\x00", -1))


def strip(col: Column) -> Column:
    """Trim any Unicode white space from both ends (``trim`` handles blanks only)."""
    trimmed = F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", "")
    return F.when(col.rlike(rf"(?U)^{SPACE}|{SPACE}$"), trimmed).otherwise(col)


def collapse_text(col: Column) -> Column:
    """One blank between words, none at the ends and none before ``!?.,;:``."""
    blanks = F.trim(F.regexp_replace(col, rf"(?U){SPACE}+", " "))
    return F.regexp_replace(blanks, r" +([!?.,;:])", "$1")


def empty_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def title_or_default(title: Column, summary: Column, fallback: str = DEFAULT_TITLE) -> Column:
    """The first non-empty of title, summary and the fallback."""
    return F.coalesce(empty_to_null(title), empty_to_null(summary), F.lit(fallback))


def _base_letter(char: str) -> str:
    """The ASCII letter that a letter with marks is built on, or the letter itself."""
    base = unicodedata.normalize("NFD", char)[0]
    return base if base.isascii() else char


# All letters of the Latin blocks that are an ASCII letter with marks, by the rule above.
_LATIN = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
ACCENTED = "".join(c for c in _LATIN if _base_letter(c) != c)
PLAIN = "".join(map(_base_letter, ACCENTED))


def fold(col: Column) -> Column:
    """Lower case without accents; as many characters as before, so places stay the same.

    Marks that follow their letter as characters of their own are kept.
    """
    return F.lower(F.translate(col, ACCENTED, PLAIN))
