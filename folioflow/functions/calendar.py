"""Calendar expressions: strict timestamps, ISO weeks, months, years, and their closing instants.  All are Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sort rank of period kinds.
KIND_RANK = {"week": 0, "month": 1, "year": 2, "reconciliation": 3}
#: Archive member times lie in these bounds (seconds since 1970).
ARCHIVE_TIME_LOW, ARCHIVE_TIME_HIGH = 315532800, 4354819198


def parse_utc(text: Column) -> Column:
    """RFC 3339 in UTC with a final Z, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$"), F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")))


def strict_date(text: Column) -> Column:
    """YYYY-MM-DD, else null; shorter forms that a cast would take are refused."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def week_label(day: Column) -> Column:
    return F.concat(F.lpad(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), 4, "0"), F.lit("-W"), F.lpad(F.extract(F.lit("WEEK"), day).cast("string"), 2, "0"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def week_start(label: Column) -> Column:
    """Monday of an ISO week label; null for a week that the year does not have."""
    year, week = F.substring(label, 1, 4).try_cast("int"), F.substring(label, 7, 2).try_cast("int")
    monday = F.date_add(F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date"), (week - 1) * 7)
    return F.when(label.rlike(r"^\d{4}-W\d{2}$") & (week_label(monday) == label), monday)


def week_of(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def next_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "month"), 1)


def previous_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "month"), -1)


def month_end(day: Column) -> Column:
    return F.last_day(day)


def valid_period(kind: Column, value: Column) -> Column:
    return (
        F.when(kind == "week", week_start(value).isNotNull())
        .when(kind == "month", value.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"))
        .when(kind == "year", value.rlike(r"^\d{4}$"))
        .when(kind == "reconciliation", parse_utc(value).isNotNull())
        .otherwise(False)
    )


def period_start(kind: Column, value: Column) -> Column:
    return F.when(kind == "week", week_start(value)).when(kind == "month", strict_date(F.concat(value, F.lit("-01")))).when(kind == "year", strict_date(F.concat(value, F.lit("-01-01"))))


def period_end(kind: Column, value: Column) -> Column:
    start = period_start(kind, value)
    return F.when(kind == "week", F.date_add(start, 6)).when(kind == "month", F.last_day(start)).when(kind == "year", F.date_sub(F.add_months(start, 12), 1))


def close_epoch(end: Column, zone: str = "Europe/Berlin") -> Column:
    """Seconds since 1970 of the midnight that ends the day in the zone."""
    return F.unix_timestamp(F.to_utc_timestamp(F.date_add(end, 1).cast("timestamp"), zone))


def periods_of(day: Column) -> Column:
    """The week, month and year of a day as an array of (kind, value)."""
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    return F.array(pair("week", week_label(day)), pair("month", month_label(day)), pair("year", F.date_format(day, "yyyy")))


def kind_rank(kind: Column) -> Column:
    out = F.lit(9)
    for name, rank in KIND_RANK.items():
        out = F.when(kind == name, rank).otherwise(out)
    return out


def archive_time(epoch: Column) -> Column:
    """A member's time: in bounds, and an even second."""
    clamped = F.least(F.greatest(epoch, F.lit(ARCHIVE_TIME_LOW)), F.lit(ARCHIVE_TIME_HIGH))
    return clamped - F.pmod(clamped, F.lit(2))


def _parts(epoch: Column) -> tuple[Column, ...]:
    """Day and hour, minute, second of UTC, whatever the session's time zone."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch / 86400).cast("int"))
    second = F.pmod(epoch, F.lit(86400))
    return day, F.floor(second / 3600).cast("int"), F.floor(F.pmod(second, F.lit(3600)) / 60).cast("int"), F.pmod(second, F.lit(60)).cast("int")


def archive_datetime(epoch: Column) -> Column:
    """A member's time as an array (year, month, day, hour, minute, even second)."""
    day, *clock = _parts(archive_time(epoch))
    return F.array(F.year(day), F.month(day), F.dayofmonth(day), *clock)


def generated_at(epoch: Column) -> Column:
    """A reproducible build time in UTC; null for a time before 1970.  Years after 9999 have more digits and no sign."""
    day, *clock = _parts(epoch)
    return F.when(epoch >= 0, F.format_string("%sT%02d:%02d:%02dZ", F.ltrim(day.cast("string"), F.lit("+")), *clock))


def scope_valid(as_of: Column, from_year: Column, to_year: Column) -> Column:
    """Whether a run's time has whole seconds and its years lie in order between 1990 and 9999."""
    whole = F.coalesce(F.pmod(F.unix_micros(as_of.cast("timestamp")), F.lit(1_000_000)) == 0, F.lit(False))
    return whole & F.coalesce((from_year >= 1990) & (from_year <= to_year) & (to_year <= 9999), F.lit(False))


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, not below zero, to three places."""
    return F.round(F.greatest(F.lit(0.0), (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6), 3)


def shift_days(at: Column, days: Column) -> Column:
    return at + F.make_interval(days=days)
