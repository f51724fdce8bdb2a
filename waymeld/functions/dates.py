"""Written dates, seasons and instants as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymeld.functions.text import MONTHS

_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
#: Milliseconds from which a date means 'never', and the least that counts.
NEVER_MS, LEAST_MS = 29000000000000, -2208988800000


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")


def _month(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3)))


def written_date(text: Column) -> Column:
    """'24th December 2007', '01/12/2026', '20260413' or '2026-04-06Z' as a date; null for anything else."""
    t = F.trim(text)
    ways = ((r"^(\d{4})-(\d{2})-(\d{2})", (1, 2, 3)), (r"^(\d{4})(\d{2})(\d{2})$", (1, 2, 3)), (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 2, 1)))
    out = F.lit(None).cast("date")
    named = rf"(?i)(\d{{1,2}})(?:st|nd|rd|th)?\s+{_MONTH}\.?,?\s+(\d{{4}})"
    part = lambda pattern, k: F.regexp_extract(t, pattern, k)
    out = F.when(t.rlike(named), _day(part(named, 3), _month(part(named, 2)), part(named, 1)))
    for pattern, (y, m, d) in reversed(ways):
        out = F.when(t.rlike(pattern), _day(part(pattern, y), part(pattern, m), part(pattern, d))).otherwise(out)
    return out


def iso_day(text: Column) -> Column:
    """The day that a text's first ten characters are, or null."""
    return F.try_to_date(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd")


def epoch_day(ms: Column) -> Column:
    """Milliseconds since 1970 as a date; null for sentinels beyond the year 2888 and before 1900."""
    value = ms.try_cast("double")
    return F.when((value <= NEVER_MS) & (value >= LEAST_MS), F.date_add(F.lit("1970-01-01").cast("date"), F.floor(value / 86400000).cast("int")))


def end_of_month(text: Column) -> Column:
    """'until December 2026' as its last day."""
    pattern = rf"(?i)until\s+{_MONTH}\s+(\d{{4}})"
    return F.when(text.rlike(pattern), F.last_day(_day(F.regexp_extract(text, pattern, 2), _month(F.regexp_extract(text, pattern, 1)), F.lit(1))))


def season(text: Column) -> Column:
    """'1 October to 30 April' as (from, to), each MM-DD."""
    p = rf"(?i)(\d{{1,2}})(?:st|nd|rd|th)?\s+{_MONTH}\s*(?:to|-|–|until|and)\s*(\d{{1,2}})(?:st|nd|rd|th)?\s+{_MONTH}"
    at = lambda day, month: F.format_string("%02d-%02d", _month(F.regexp_extract(text, p, month)), F.regexp_extract(text, p, day).try_cast("int"))
    return F.when(text.rlike(p), F.struct(at(1, 2).alias("from"), at(3, 4).alias("to")))


def season_dates(first: Column, last: Column, day: Column, horizon_days: int = 90) -> Column:
    """(start, end) of the season MM-DD to MM-DD that holds `day`, or of the next; null beyond the horizon.

    A season may run over the new year. 29 February is taken as the 28th.
    """
    def at(year: Column, mmdd: Column) -> Column:
        return F.to_date(F.concat(year.cast("string"), F.lit("-"), F.when(mmdd == "02-29", "02-28").otherwise(mmdd)))

    def one(k: int) -> Column:
        start, end = at(F.year(day) + k, first), at(F.year(day) + k, last)
        return F.struct(start.alias("start"), F.when(end < start, at(F.year(day) + k + 1, last)).otherwise(end).alias("end"))

    ahead = F.get(F.filter(F.array(one(-1), one(0), one(1)), lambda s: s["end"] >= day), 0)
    return F.when(ahead["start"] <= F.date_add(day, horizon_days), ahead)


#: Upper bounds in days of the ages of a source, the last one open. Fixed values.
AGES = (("under_30d", 30), ("under_90d", 90), ("under_1y", 365), ("under_2y", 730), ("under_5y", 1825), ("over_5y", None))


def age_bucket(day: Column, today: Column) -> Column:
    """Bucket of the days from `day` to `today`; 'unknown' without a day, 'future' after today."""
    age = F.datediff(today, day)
    out = F.when(age.isNull(), "unknown").when(age < 0, "future")
    for name, upper in AGES[:-1]:
        out = out.when(age <= upper, name)
    return out.otherwise(AGES[-1][0])


def blocked_until(status: Column, at: Column, retry_after_s: Column) -> Column:
    """When a refused source may be asked again: its own Retry-After, a week for 403 and 410, else a day."""
    later = F.when(retry_after_s.isNotNull(), F.make_dt_interval(secs=retry_after_s.cast("decimal(18,6)"))).when(status.isin(403, 410), F.expr("INTERVAL 7 DAYS")).otherwise(F.expr("INTERVAL 24 HOURS"))
    return at + later
