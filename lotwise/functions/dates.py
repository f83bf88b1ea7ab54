"""Dates of listings. The session's time zone must be UTC; relative phrases need an explicit day to count from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import bound, unless
from .texts import strip_accents_lower

STAMP = "yyyy-MM-dd_HH-mm"
# Seconds of the units of "há N unit", by the start of the unit's word.
UNITS = {"segund": 1, "minut": 60, "hor": 3600, "dia": 86400, "seman": 604800, "mes": 30 * 86400, "ano": 365 * 86400}
# The phrase that tells how long ago a listing was published or updated.
PHRASE = r"(?iu){kind}\s+há\s+(\d+)\s+(segundos?|minutos?|horas?|dias?|semanas?|mês|meses|anos?)"

DAY_FIRST = r"(?s)^.{4}-.{2}-.{2}"
#: Seconds from 1970 of the first day there is.
YEAR_1 = -62_135_596_800


def stamp_to_timestamp(stamp: Column) -> Column:
    """YYYY-MM-DD_HH-MM, or null if there is no such minute."""
    return F.try_to_timestamp(stamp, F.lit(STAMP)).cast("timestamp_ntz")


def timestamp_to_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def iso_to_utc_date(text: Column) -> Column:
    """Day in UTC of an ISO time; a time without a zone is in UTC."""
    return F.trim(text).try_cast("timestamp").cast("date")


def prefix_date(text: Column) -> Column:
    """The first ten of at least ten characters if they look like a day, whatever the zone; else the day in UTC. A text."""
    t = F.trim(text)
    return F.when(t.rlike(DAY_FIRST), F.left(t, F.lit(10))).otherwise(iso_to_utc_date(t).cast("string"))


def unit_seconds(unit: Column) -> Column:
    u, out = strip_accents_lower(unit), None
    for start, seconds in UNITS.items():
        out = F.when(u.startswith(start), seconds) if out is None else out.when(u.startswith(start), seconds)
    return out.cast("bigint")


def relative_date(text: Column, kind: str, as_of: Column) -> Column:
    """Day of 'publicado há N unidade' (or 'atualizado') counted back from a time; null if that is before year 1."""
    pattern = PHRASE.format(kind=kind)
    now = F.unix_timestamp(as_of.cast("timestamp"))

    def day(phrase: Column) -> Column:
        n = unless(F.regexp_extract(phrase, pattern, 1), "").try_cast("bigint")
        then = F.try_subtract(now, F.try_multiply(n, unit_seconds(F.regexp_extract(phrase, pattern, 2))))
        return bound(then, lambda t: F.timestamp_seconds(F.when(t >= YEAR_1, t)).cast("date"))

    return bound(F.regexp_extract(text, pattern, 0), day)


def calendar_date(text: Column, kind: str, as_of: Column) -> Column:
    """A day from any of the forms above: its prefix first, then the day in UTC, then the phrase."""
    t = F.nullif(F.trim(text), F.lit(""))
    prefix = F.when(t.rlike(DAY_FIRST), F.left(t, F.lit(10)).try_cast("date"))
    return F.coalesce(prefix, iso_to_utc_date(t), relative_date(t, kind, as_of))
