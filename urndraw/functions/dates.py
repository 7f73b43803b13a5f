"""Calendar rules: cut-offs in local time, strict parsing, calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_OFFSET_MINUTES = 7 * 60  # fixed value: local clock is UTC+7, no daylight saving
ROLLOVER_MINUTE = 20 * 60  # fixed value: from 20:00 local the day's own draw is expected
WARNING_MINUTE = 20 * 60
CRITICAL_MINUTE = 20 * 60 + 30


def local_time(utc: Column) -> Column:
    return utc + F.make_dt_interval(mins=F.lit(LOCAL_OFFSET_MINUTES))


def minute_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).cast("long")


def epoch_minute(ts: Column) -> Column:
    """Minutes since 1970 of a local timestamp, whatever the session time zone."""
    return F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long") * 1440 + minute_of_day(ts)


def whole_seconds(span: Column) -> Column:
    parts = (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60))
    total = F.floor(F.extract(F.lit("SECOND"), span))
    for unit, size in parts:
        total = total + F.extract(F.lit(unit), span) * size
    return total.cast("long")


def latest_completed(utc: Column, cutoff_minute: Column | int) -> Column:
    """Last date whose draw is complete: today from the cut-off on, else yesterday."""
    local = local_time(utc)
    day = F.to_date(local)
    return F.when(minute_of_day(local) >= cutoff_minute, day).otherwise(F.date_sub(day, 1))


def expected_date(utc: Column, rollover_minute: int = ROLLOVER_MINUTE) -> Column:
    """The draw date that should be served at this moment."""
    return latest_completed(utc, rollover_minute)


def alert_window(utc: Column, warning: int = WARNING_MINUTE, critical: int = CRITICAL_MINUTE) -> Column:
    if critical <= warning:
        raise ValueError("the critical window must start after the warning window")
    minute = minute_of_day(local_time(utc))
    return F.when(minute < warning, "pre_warning").when(minute < critical, "warning").otherwise("critical")


def batch_year_end(year: Column, today: Column) -> Column:
    """Last completed date of a yearly batch; NULL where ``batch_year_problem`` says why."""
    yesterday = F.date_sub(today, 1)
    return F.when(year < F.year(today), F.make_date(year, F.lit(12), F.lit(31))).when(
        (year == F.year(today)) & (F.year(yesterday) == year), yesterday
    )


def batch_year_problem(year: Column, today: Column) -> Column:
    """``future_year`` for a year that has not begun, ``nothing_completed`` on 1 January of the year itself, else NULL."""
    return F.when(year > F.year(today), "future_year").when((year == F.year(today)) & (F.dayofyear(today) == 1), "nothing_completed")


def parse_compact(text: Column) -> Column:
    """DDMMYYYY, NULL when it is no real date."""
    return F.try_to_date(text, "ddMMyyyy")


def parse_display(day: Column, month: Column, year: Column) -> Column:
    """D, M, YYYY captured from free text, NULL when it is no real date."""
    return F.try_to_date(
        F.concat(F.lpad(day, 2, "0"), F.lpad(month, 2, "0"), year), "ddMMyyyy"
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    iso_day = (F.weekday(day) + 1).cast("long")
    return {
        "day_of_week": iso_day,
        "day_name": F.date_format(day, "EEEE"),
        "iso_week": F.weekofyear(day).cast("long"),
        "month": F.month(day).cast("long"),
        "quarter": F.quarter(day).cast("long"),
        "year": F.year(day).cast("long"),
        "is_weekend": iso_day >= 6,
    }
