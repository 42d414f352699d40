"""Calendar, epidemiological-week and date-parsing rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_micros(ts) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp, independent of the
    session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(ts))


def ntz_to_instant(ts) -> Column:
    """Wall clock read as UTC -> TimestampType (for watermarks and windows), with no
    dependence on the session time zone (no DST gaps or overlaps)."""
    return F.timestamp_micros(ntz_micros(ts))


def instant_to_ntz(ts) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def week_start_sunday(d) -> Column:
    """The Sunday that starts the (Sunday-Saturday) week holding ``d``."""
    d = _c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def _epi_anchor(d) -> Column:
    # The Wednesday of the week: the week belongs to the year holding its Wednesday,
    # which is the same as "week 1 is the first week with >= 4 days in the year".
    return F.date_add(week_start_sunday(d), 3)


def epi_year(d) -> Column:
    return F.year(_epi_anchor(d))


def epi_week(d) -> Column:
    return (F.floor((F.dayofyear(_epi_anchor(d)) - 1) / 7) + 1).cast("int")


def epi_week_id(year_col, week_col) -> Column:
    """``2024W01``."""
    return F.format_string("%dW%02d", _c(year_col), _c(week_col))


def calendar_columns(d) -> list[Column]:
    """Calendar attributes for a date column."""
    d = _c(d)
    ey, ew = epi_year(d), epi_week(d)
    return [
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        (((F.dayofweek(d) + 5) % 7) + 1).alias("day_of_week_iso"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.weekofyear(d).alias("iso_week"),
        ey.alias("epi_year"),
        ew.alias("epi_week"),
        epi_week_id(ey, ew).alias("epi_week_id"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    ]


def safe_date(x, fmt: str) -> Column:
    """Trimmed text parsed with ``fmt``; blank or invalid -> NULL (never raises)."""
    s = F.trim(_c(x))
    return F.when(s != "", F.try_to_date(s, fmt))


def days_in_month(d) -> Column:
    """D5."""
    return F.dayofmonth(F.last_day(_c(d)))


def days_in_year(year_col) -> Column:
    y = _c(year_col)
    return F.datediff(F.make_date(y + 1, F.lit(1), F.lit(1)), F.make_date(y, F.lit(1), F.lit(1)))


def half_open_year_range(ts_col, start_year: int, end_year: int) -> Column:
    """``year(ts) BETWEEN a AND b`` rewritten so the scan can prune on it."""
    c = _c(ts_col)
    return (c >= F.lit(f"{start_year}-01-01").cast("timestamp_ntz")) & \
           (c < F.lit(f"{end_year + 1}-01-01").cast("timestamp_ntz"))


def build_years(first: int | None = None, last: int | None = None, back: int | None = None, *, this_year: int) -> tuple[int, int]:
    """The years of a build, both ends included: an explicit span, or this year and the
    ``back`` years before it. Anything else (mixed, half a span, reversed, negative) is refused."""
    given = (first is not None, last is not None, back is not None)
    if given == (True, True, False) and first <= last:
        return first, last
    if given == (False, False, True) and back >= 0:
        return this_year - back, this_year
    raise ValueError(f"neither a span nor a number of years back: first={first}, last={last}, back={back}")
