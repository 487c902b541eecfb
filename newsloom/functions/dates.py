"""Date text to UTC timestamps, with regular expressions and ``try_make_timestamp``.

Not read (it gives null): ISO text whose separator between date and time is a digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import bind, groups, strip

# date, optional time, optional offset; the same dash or colon style on both sides
_ISO_TIME = (
    r"(?:[^\d](\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?: ?([+-])([01]\d|2[0-3])(?::?([0-5]\d)(?::?([0-5]\d))?)?)?)?$"
)
_ISO = r"^(\d{4})(-?)(\d{2})\2(\d{2})" + _ISO_TIME
# year, week and, if it is not Monday, the day of the week
_ISO_WEEK = r"^(\d{4})(-?)W(\d{2})(?:\2([1-7]))?" + _ISO_TIME
_CLOCK = r"(?:\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$"
_YMD = r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _CLOCK
_DMY = r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _CLOCK

# The relative words that are understood.
TODAY_WORDS = ("hoje", "today")
YESTERDAY_WORDS = ("ontem", "yesterday")


def _number(text: Column) -> Column:
    return F.when(text == "", F.lit(0)).otherwise(text.cast("int"))


def _timestamp(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    stamp = F.try_make_timestamp(year, month, day, hour, minute, second, F.lit("UTC"))
    return F.when((year > 0) & (second < 60), stamp)


def _week_day(year: Column, week: Column, day: Column) -> Column:
    """Date of a day of an ISO week; null if the year has no such week."""
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    weeks = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    date = F.date_add(first, (week - 1) * 7 + F.greatest(day, F.lit(1)) - 1)
    return F.when((week > 0) & (week <= weeks), date)


def _iso(text: Column) -> Column:
    return F.coalesce(_iso_form(text, _ISO), F.when(text.contains("W"), _iso_form(text, _ISO_WEEK, weeks=True)))


def _iso_form(text: Column, pattern: str, weeks: bool = False) -> Column:
    def build(found: Column) -> Column:
        part = lambda group: _number(found[group - 1])
        date = (part(1), part(3), part(4))
        if weeks:
            day = _week_day(*date)
            date = (F.year(day), F.month(day), F.day(day))
        micros = F.rpad(F.substring(found[8], 1, 6), 6, "0").cast("int")
        second = (part(8) + micros / F.lit(1000000)).cast("decimal(16,6)")
        local = _timestamp(*date, part(5), part(7), second)
        offset = part(11) * 3600 + part(12) * 60 + part(13)
        shift = F.when(found[9] == "-", offset).otherwise(-offset)
        return F.timestamp_micros(F.unix_micros(local) + shift.cast("long") * 1000000)

    return bind(groups(text, pattern, 13), build)


def _with_clock(text: Column, pattern: str, year: int, month: int, day: int) -> Column:
    def build(found: Column) -> Column:
        part = lambda group: _number(found[group - 1])
        return _timestamp(part(year), part(month), part(day), part(4), part(5), part(6).cast("decimal(16,6)"))

    return bind(groups(text, pattern, 6), build)


def parse_date(value: Column, reference: Column | None = None, fallback_to_reference: bool = True) -> Column:
    """Flexible parse: ISO, year-first, day-first, then words relative to ``reference``.

    Text without an offset counts as UTC; anything unreadable is null.
    """
    words = reference if reference is not None and fallback_to_reference else None

    def read(pair: Column) -> Column:
        text = pair["text"]
        parsed = [_iso(text), _with_clock(text, _YMD, 1, 2, 3), _with_clock(text, _DMY, 3, 2, 1)]
        if words is not None:
            midnight = F.date_trunc("day", pair["reference"])
            yesterday = midnight - F.expr("INTERVAL '1' DAY")
            word = F.lower(text)
            parsed.append(
                F.when(word.isin(*TODAY_WORDS), midnight).when(word.isin(*YESTERDAY_WORDS), yesterday)
            )
        return F.coalesce(*parsed)

    text = F.replace(strip(value), F.lit("Z"), F.lit("+00:00"))
    context = [words.alias("reference")] if words is not None else []
    return bind(F.struct(text.alias("text"), *context), read)


def parse_iso(value: Column) -> Column:
    """Strict parse: ISO text only, else null (the caller turns that into an error)."""
    zulu = F.regexp_replace(value, "Z$", "+00:00")
    return _iso(zulu)
