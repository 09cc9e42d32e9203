"""Load periods and request planning.

Period generation is a transform over a DataFrame of requests
``(start_date, end_date, frequency, custom_days)``: each request explodes
into its periods with ``sequence``, so any number of requests is planned
in parallel without a driver loop.

Rules kept from the reference behaviour:
- a request without both dates means the previous calendar month of
  ``as_of`` (UTC);
- monthly / yearly periods start at ``start_date`` and then align to the
  calendar; the last one is clipped to ``end_date``;
- any other frequency steps ``custom_days`` days (default 7); a
  non-numeric or non-positive step makes the request invalid (reported in
  ``invalid_period_requests``), instead of never ending;
- ``start > end`` yields no period.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DATATYPES, DEFAULT_CUSTOM_DAYS, PAGE_LIMIT

DAILY, MONTHLY, YEARLY = "daily", "monthly", "yearly"


def _lit_date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        v = v.date()
    if not isinstance(v, _dt.date):
        v = _dt.date.fromisoformat(str(v)[:10])
    return F.lit(v)


def last_month(as_of: Column) -> tuple[Column, Column]:
    """(first day, last day) of the calendar month before ``as_of``."""
    prev = F.add_months(as_of, -1)
    return F.trunc(prev, "MM"), F.last_day(prev)


def periods_last_month(df: DataFrame, as_of: str = "as_of") -> DataFrame:
    """Previous full month of each ``as_of`` date."""
    s, e = last_month(F.col(as_of).cast("date"))
    return df.select("*", s.alias("start"), e.alias("end"))


def _parse_day(c: Column) -> Column:
    """Strict ``yyyy-MM-dd``; NULL (not an error) when malformed."""
    return F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


def _step_days(custom_days: Column) -> Column:
    return F.coalesce(custom_days.try_cast("int"),
                      F.when(custom_days.isNull(), F.lit(DEFAULT_CUSTOM_DAYS)))


def _period_array(s: Column, e: Column, freq: Column, step: Column) -> Column:
    """Array of ``struct(start, end)`` for one request, NULL when empty/invalid."""
    def clip(first: Column, nxt) -> Column:
        return F.struct(F.greatest(first, s).alias("start"),
                        F.least(F.date_sub(nxt(first), 1), e).alias("end"))

    daily = F.transform(F.sequence(s, e, F.expr("interval 1 day")),
                        lambda d: F.struct(d.alias("start"), d.alias("end")))
    monthly = F.transform(F.sequence(F.trunc(s, "MM"), e, F.expr("interval 1 month")),
                          lambda m: clip(m, lambda x: F.add_months(x, 1)))
    yearly = F.transform(F.sequence(F.trunc(s, "YEAR"), e, F.expr("interval 1 year")),
                         lambda y: clip(y, lambda x: F.add_months(x, 12)))
    custom = F.transform(F.sequence(F.lit(0), F.datediff(e, s), step),
                         lambda i: F.struct(F.date_add(s, i).alias("start"),
                                            F.least(F.date_add(s, i + step - 1), e).alias("end")))
    arr = (F.when(freq == DAILY, daily).when(freq == MONTHLY, monthly)
           .when(freq == YEARLY, yearly).when(step > 0, custom))
    return F.when(s <= e, arr)


def _resolved(requests: DataFrame, as_of) -> DataFrame:
    s_raw = F.col("start_date").cast("string")
    e_raw = F.col("end_date").cast("string")
    has_both = (F.coalesce(s_raw, F.lit("")) != "") & (F.coalesce(e_raw, F.lit("")) != "")
    lm_s, lm_e = last_month(as_of.cast("date") if isinstance(as_of, Column) else _lit_date(as_of))
    cols = requests.columns
    freq = F.coalesce(F.col("frequency").cast("string"), F.lit(MONTHLY)) \
        if "frequency" in cols else F.lit(MONTHLY)
    step = _step_days(F.col("custom_days").cast("string")) if "custom_days" in cols \
        else F.lit(DEFAULT_CUSTOM_DAYS)
    return requests.withColumns({
        "_default": ~has_both,
        "_s": F.when(has_both, _parse_day(s_raw)).otherwise(lm_s),
        "_e": F.when(has_both, _parse_day(e_raw)).otherwise(lm_e),
        "_freq": freq,
        "_step": step,
    })


def generate_periods(requests: DataFrame, as_of=None, keep: list[str] | None = None) -> DataFrame:
    """Explode each valid request into its periods ``(start, end)``.

    ``keep`` lists request columns to carry (e.g. a request id). A default
    request (missing dates) gives the month before ``as_of`` as one period.
    """
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).date()
    r = _resolved(requests, as_of)
    arr = F.when(F.col("_default"), F.array(F.struct(F.col("_s").alias("start"),
                                                     F.col("_e").alias("end")))) \
        .otherwise(_period_array(F.col("_s"), F.col("_e"), F.col("_freq"), F.col("_step")))
    keep = keep or []
    return (r.select(*keep, F.explode(arr).alias("p"))
            .select(*keep, F.col("p.start").alias("start"), F.col("p.end").alias("end")))


def invalid_period_requests(requests: DataFrame, as_of=None) -> DataFrame:
    """Requests that cannot be planned: unparsable dates, or a custom
    frequency whose step is not a positive integer."""
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).date()
    r = _resolved(requests, as_of)
    bad_dates = ~F.col("_default") & (F.col("_s").isNull() | F.col("_e").isNull())
    bad_step = (~F.col("_freq").isin(DAILY, MONTHLY, YEARLY)) & \
        (F.col("_step").isNull() | (F.col("_step") <= 0))
    return (r.where(bad_dates | bad_step)
            .withColumn("reason", F.when(bad_dates, "invalid start_date or end_date")
                        .otherwise("invalid custom_days"))
            .drop("_default", "_s", "_e", "_freq", "_step"))


def periods(spark: SparkSession, start_date, end_date, frequency: str = MONTHLY,
            custom_days=None, as_of=None) -> DataFrame:
    """Periods of a single request (convenience wrapper)."""
    if frequency not in (DAILY, MONTHLY, YEARLY):
        step = DEFAULT_CUSTOM_DAYS if custom_days is None else int(custom_days)
        if step <= 0:
            raise ValueError("custom_days must be a positive integer")
    req = spark.createDataFrame(
        [(None if start_date is None else str(start_date),
          None if end_date is None else str(end_date), frequency,
          None if custom_days is None else str(custom_days))],
        "start_date string, end_date string, frequency string, custom_days string")
    return generate_periods(req, as_of).select(
        F.col("start").alias("start"), F.col("end").alias("end"))


def expand_days(periods_df: DataFrame, start: str = "start", end: str = "end",
                out: str = "day") -> DataFrame:
    """One row per day of each period (empty when start > end)."""
    s, e = F.col(start), F.col(end)
    days = F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day")))
    return periods_df.select("*", F.explode(days).alias(out))


def expected_loads(periods_df: DataFrame, datatypes=DATATYPES) -> DataFrame:
    """Every (period, datatype) pair that should be landed.

    The datatype list is a small literal array exploded per period, so no
    join (and no cartesian product) is planned.
    """
    arr = F.array(*[F.lit(t) for t in datatypes])
    return periods_df.select("*", F.explode(arr).alias("datatype"))


def missing_loads(expected: DataFrame, landed: DataFrame,
                  keys=("start", "end", "datatype")) -> DataFrame:
    """Expected (period, datatype) pairs with nothing landed."""
    return expected.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def expected_pages(totals: DataFrame, total: str = "total",
                   limit: int = PAGE_LIMIT) -> DataFrame:
    """1-based page offsets ``1, 1+limit, ...`` up to the declared total.

    Requests with a total of 0 (or NULL) need no page.
    """
    t = F.col(total)
    offsets = F.when(t > 0, F.sequence(F.lit(1).cast("long"), t.cast("long"),
                                       F.lit(limit).cast("long")))
    return (totals.select("*", F.posexplode(offsets).alias("page_index", "offset"))
            .withColumn("page", F.col("page_index") + 1).drop("page_index"))

