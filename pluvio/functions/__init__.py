"""Column expressions used across operators.

All are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import SEASON_FALLBACK_RANK, SEASONS, STATION_PREFIX


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def observation_id(station: Column | str, date: Column | str) -> Column:
    """Row key: station without its dataset prefix, ``_``, ``yyyyMMdd``."""
    return F.concat(F.replace(_c(station), F.lit(STATION_PREFIX), F.lit("")),
                    F.lit("_"), F.date_format(_c(date), "yyyyMMdd"))


def month_start(date: Column | str) -> Column:
    """First instant of the month as a zone-less timestamp.

    ``date_trunc`` would give a zoned timestamp; the contract is NTZ.
    """
    return F.trunc(_c(date), "MM").cast("timestamp_ntz")


def year_start(date: Column | str) -> Column:
    return F.trunc(_c(date), "YEAR").cast("timestamp_ntz")


def season(date: Column | str) -> Column:
    """Southern-hemisphere season label of a date (by month only)."""
    m = F.month(_c(date))
    expr = None
    for label, months in SEASONS[:-1]:
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(SEASONS[-1][0]))


def season_rank(label: Column | str) -> Column:
    """Presentation order of season labels; anything else sorts last."""
    lab = _c(label)
    expr = None
    for rank, (name, _) in enumerate(SEASONS, start=1):
        cond = lab == F.lit(name)
        expr = F.when(cond, F.lit(rank)) if expr is None else expr.when(cond, F.lit(rank))
    return expr.otherwise(F.lit(SEASON_FALLBACK_RANK))


def zero_if_null(c: Column) -> Column:
    """``COALESCE(x, 0)`` for double aggregates ("no data" reads as 0)."""
    return F.coalesce(c, F.lit(0.0))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI divide-by-zero."""
    return num / F.nullif(den, F.lit(0.0))


def day_parts(date: Column | str) -> dict[str, Column]:
    """Landing-path parts: year as int, month/day zero-padded strings."""
    d = _c(date)
    return {
        "year": F.year(d),
        "month": F.lpad(F.month(d).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
    }


def make_day(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from landing-path parts (which load as ints)."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), _c(day).cast("int"))


def iso_date(c: Column | str) -> Column:
    """Parse ``yyyy-MM-dd`` or ``yyyy-MM-dd'T'HH:mm:ss``; NULL if malformed."""
    return F.to_date(F.try_to_timestamp(_c(c)))


__all__ = [
    "observation_id", "month_start", "year_start", "season", "season_rank",
    "zero_if_null", "safe_ratio", "day_parts", "make_day", "iso_date",
]
