"""Dates, times of day and durations."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col

# Accepted time-of-day layouts (HH:MM and HH:MM:SS, 24 h, or 12 h with AM/PM).
_TIME_24 = r"^\s*(?:\d{4}-\d{2}-\d{2}[T ])?([01]?\d|2[0-3]):([0-5]\d)(?::[0-5]\d(?:\.\d+)?)?\s*$"
_TIME_12 = r"(?i)^\s*(0?[1-9]|1[0-2]):([0-5]\d)(?::[0-5]\d)?\s*([ap])\.?m\.?\s*$"


def hour_decimal(c: Column | str) -> Column:
    """Time text to hours: '07:30' -> 7.5; text that is not a time becomes null."""
    c = col(c).cast("string")

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(c, pattern, group).try_cast("int")

    h24 = part(_TIME_24, 1) + part(_TIME_24, 2) / F.lit(60.0)
    half = F.lower(F.regexp_extract(c, _TIME_12, 3))
    h12 = part(_TIME_12, 1) % 12 + F.when(half == "p", 12).otherwise(0) + part(_TIME_12, 2) / F.lit(60.0)
    return F.coalesce(h24, F.when(half != "", h12))


def date_parts(date: Column | str, time: Column | str) -> dict[str, Column]:
    """Year, month, weekday (Monday = 0) and decimal hour."""
    d = col(date)
    return {
        "anio": F.year(d),
        "mes": F.month(d),
        "dia_semana": F.weekday(d),
        "Hora_decimal": hour_decimal(time),
    }


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two stamps; a text that is no timestamp makes the result null."""
    a, b = (col(c).try_cast("timestamp_ntz") for c in (start, end))
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(60e6)
