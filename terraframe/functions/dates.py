"""Dates, windows and names."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def windows(start: date, end: date, step: int) -> list[tuple[date, date]]:
    """Half-open windows from ``start``; the last is cut at ``end``; a step under 1 gives one."""
    if step <= 0:
        return [(start, end)]
    n = max(0, -(-(end - start).days // step))
    return [(start + timedelta(i * step), min(end, start + timedelta((i + 1) * step))) for i in range(n)]


def window_index(day: Column, start: date, step: int) -> Column:
    """Number of the fixed-length window a day falls in, counted from ``start``."""
    return F.floor(F.datediff(day, F.lit(start)) / step).cast("int")


def solar_day(ts: Column, lon: Column) -> Column:
    """Local day by the sun: UTC plus lon / 15 hours; a missing longitude counts as 0."""
    return F.to_date(F.timestamp_seconds(F.unix_timestamp(ts) + F.coalesce(lon, F.lit(0)) * 240))


def label_valid(label_day: Column, sample_day: Column, before: int, after: int) -> Column:
    return F.datediff(sample_day, label_day).between(-before, after)


def parse_band(description: Column) -> tuple[Column, Column]:
    """(band, date) of ``<band>_YYYY_MM_DD``; NULLs where it has another form."""
    pattern = r"^([A-Za-z0-9]+)_(\d{4})_(\d{2})_(\d{2})$"
    ok = description.rlike(pattern)
    day = F.concat_ws("-", *[F.regexp_extract(description, pattern, i) for i in (2, 3, 4)])
    return F.when(ok, F.regexp_extract(description, pattern, 1)), F.when(ok, F.try_to_date(day, "yyyy-MM-dd"))


def band_name(band: str, end: Column) -> Column:
    return F.concat(F.lit(f"{band}_"), F.date_format(end, "yyyy_MM_dd"))
