"""Trading-calendar gating (§2.4 P22–P25, P27; §2.5 D7–D9).

The calendar is a session table over the dates that matter: weekdays minus a
holiday list, regular hours in the exchange's zone converted to UTC per day
(so daylight saving comes out of the table), early closes overriding the
close.  Holidays and early closes are inputs, with the range of dates that
they cover: outside of it nothing is known, so a date there is no session and no
closed day but an error (``calendar_error``).  All plans are lazy: events meet
the calendar in an equi-join on the UTC date, and the optimizer broadcasts the
calendar when it has measured it to be small.  Tables of several markets carry
a ``market`` column; lists and events then meet on market and date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions import col_of
from tapeworks.functions.time import iso_text

# The New York exchange's regular hours and zone.
EXCHANGE_ZONE = "America/New_York"
OPEN_TIME = "09:30:00"
CLOSE_TIME = "16:00:00"

# 2024 and 2025 full-day holidays and early closes (13:00) of the
# New York exchange, as the exchange publishes them, and the range they cover.
HOLIDAYS_2024 = ("2024-01-01", "2024-01-15", "2024-02-19", "2024-03-29", "2024-05-27", "2024-06-19",
                 "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25")
HOLIDAYS_2025 = ("2025-01-01", "2025-01-09", "2025-01-20", "2025-02-17", "2025-04-18", "2025-05-26", "2025-06-19",
                 "2025-07-04", "2025-09-01", "2025-11-27", "2025-12-25")
EARLY_CLOSES_2024 = (("2024-07-03", "13:00:00"), ("2024-11-29", "13:00:00"), ("2024-12-24", "13:00:00"))
EARLY_CLOSES_2025 = (("2025-07-03", "13:00:00"), ("2025-11-28", "13:00:00"), ("2025-12-24", "13:00:00"))
COVERAGE = ("2024-01-01", "2025-12-31")

Coverage = tuple[str, str] | None  # first and last date of the lists; None: they hold for all dates
UNCOVERED = "date_not_covered"


def covered(date, coverage: Coverage) -> Column:
    """Whether the lists say anything about a date (null for a null date)."""
    d = col_of(date)
    return d.isNotNull() if coverage is None else d.between(F.lit(coverage[0]).cast("date"), F.lit(coverage[1]).cast("date"))


def calendar_error(date, coverage: Coverage) -> Column:
    """The error of a date that the lists don't cover, else null."""
    return F.when(~covered(date, coverage), F.lit(UNCOVERED))


def date_spine(events: DataFrame, ts: str = "ts", tail_days: int = 0) -> DataFrame:
    """Every date from the first to the last UTC date of the events, and
    ``tail_days`` more."""
    bounds = events.agg(F.min(F.to_date(ts)).alias("a"), F.date_add(F.max(F.to_date(ts)), tail_days).alias("b"))
    return bounds.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("date"))


def keys(*tables: DataFrame) -> list[str]:
    """The market, where all these tables have one."""
    return ["market"] if all("market" in t.columns for t in tables) else []


def event_dates(events: DataFrame, ts: str = "ts") -> DataFrame:
    """The UTC dates (by market) that have an event."""
    return events.select(*keys(events), F.to_date(ts).alias("date")).where("date is not null").distinct()


def sessions(spine: DataFrame, holidays: DataFrame, early_closes: DataFrame,
             open_time: str = OPEN_TIME, close_time: str = CLOSE_TIME, zone: str = EXCHANGE_ZONE,
             coverage: Coverage = None) -> DataFrame:
    """(date, open_utc, close_utc) for every session day of the spine
    within the ``coverage`` of the lists.

    ``holidays``: (date); ``early_closes``: (date, close_time).
    """
    days = spine.filter(~F.dayofweek("date").isin(1, 7) & covered("date", coverage))
    own = keys(days, holidays, early_closes)
    days = days.join(holidays.select(*own, "date"), [*own, "date"], "left_anti")
    days = days.join(early_closes.groupBy(*own, "date").agg(F.min("close_time").alias("_early")), [*own, "date"], "left")
    local = lambda t: F.to_timestamp(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" "), t))
    return days.select(
        *keys(days), "date",
        F.to_utc_timestamp(local(F.lit(open_time)), zone).alias("open_utc"),
        F.to_utc_timestamp(local(F.coalesce(F.col("_early"), F.lit(close_time))), zone).alias("close_utc"))


def session_filter(events: DataFrame, cal: DataFrame, ts: str = "ts") -> DataFrame:
    """Events on session days (label = the UTC date of the instant)."""
    own = keys(events, cal)
    return events.withColumn("date", F.to_date(ts)).join(cal.select(*own, "date"), [*own, "date"], "left_semi")


def uncovered(events: DataFrame, coverage: Coverage, ts: str = "ts") -> DataFrame:
    """D7's other side: events whose date the lists don't cover, as error rows."""
    e = events.withColumn("date", F.to_date(ts)).withColumn("calendar_error", calendar_error("date", coverage))
    return e.filter(F.col("calendar_error").isNotNull())


def open_minute(events: DataFrame, cal: DataFrame, ts: str = "ts", close_inclusive: bool = False,
                coverage: Coverage = None) -> DataFrame:
    """``is_open`` per event: its UTC date is a session and
    ``open <= ts < close`` (``close_inclusive`` flips the right end).  A date that
    is not covered has ``calendar_error`` and neither flag."""
    e = events.withColumn("_d", F.to_date(ts))
    own = keys(events, cal)
    c = cal.select(*own, F.col("date").alias("_d"), "open_utc", "close_utc")
    j = e.join(c, [*own, "_d"], "left").withColumn("calendar_error", calendar_error("_d", coverage))
    known = F.col("calendar_error").isNull()
    right = (F.col(ts) <= F.col("close_utc")) if close_inclusive else (F.col(ts) < F.col("close_utc"))
    return j.withColumn("is_session", F.when(known, F.col("open_utc").isNotNull())).withColumn(
        "is_open", F.when(known, F.coalesce((F.col(ts) >= F.col("open_utc")) & right, F.lit(False)))).drop("_d")


def next_weekday(date) -> Column:
    """The first Monday-to-Friday date after ``date``."""
    d = col_of(date)
    return F.date_add(d, F.when(F.dayofweek(d) == 6, 3).when(F.dayofweek(d) == 7, 2).otherwise(1))


def next_sessions(dates: DataFrame, holidays: DataFrame, early_closes: DataFrame, coverage: Coverage = None) -> DataFrame:
    """D9 helper, a forward as-of join: for every date, the first session strictly
    after it, however long the exchange stays closed (null where the lists end
    before it).

    The session wanted follows either the date itself or the last holiday of the
    closure it falls into, so the weekdays behind all dates and all holidays, less
    the holidays, hold it.  Dates and sessions are merged, and each date takes the
    least session behind it, in a window over the calendar dates of a market: one
    row each, a few hundred a year."""
    own = keys(dates, holidays)
    days, none = dates.select(*own, "date").withColumn("_wanted", F.lit(True)), F.lit(None).cast("date")
    behind = days.select(*own, "date").unionAll(holidays.select(*own, "date")).withColumn("date", next_weekday("date")).distinct()
    open_days = sessions(behind, holidays, early_closes, coverage=coverage)
    merged = days.withColumn("_s", none).unionAll(open_days.select(*own, "date", F.lit(False), F.col("date").alias("_s")))
    one = merged.groupBy(*own, "date").agg(F.bool_or("_wanted").alias("_wanted"), F.max("_s").alias("_s"))
    ahead = Window.partitionBy(*own).orderBy("date").rowsBetween(1, Window.unboundedFollowing)
    return one.withColumn("next_session", F.min("_s").over(ahead)).where("_wanted").drop("_wanted", "_s")


def next_session(events: DataFrame, following: DataFrame, ts: str = "ts") -> DataFrame:
    """As-of forward join: the next session after each event's UTC date
    (``following``: the ``next_sessions`` of the events' dates)."""
    ns = following.withColumnRenamed("date", "_d")
    return events.withColumn("_d", F.to_date(ts)).join(ns, [*keys(events, following), "_d"], "left").drop("_d")


def market_status(events: DataFrame, cal: DataFrame, following: DataFrame, ts: str = "ts", coverage: Coverage = None) -> DataFrame:
    """The status row a check at each event's instant would report; a date
    that is not covered has ``calendar_error`` and no status."""
    o = open_minute(events, cal, ts, coverage=coverage)
    o = next_session(o, following, ts)
    iso = lambda c: iso_text(c, zulu=False)
    return o.select(
        "*",
        iso(F.col(ts)).alias("current_time"),
        F.when(F.col("is_session"), iso(F.col("open_utc"))).alias("open_time"),
        F.when(F.col("is_session"), iso(F.col("close_utc"))).alias("close_time"),
        F.when(~F.col("is_session"), F.date_format("next_session", "yyyy-MM-dd")).alias("next_trading_day"),
    )


def open_gate(is_session, is_open, check_trading_day: bool = True, check_current_time: bool = True) -> Column:
    """The wait-for-open decision for one (check_trading_day,
    check_current_time) setting: refused on a non-session day when the day is
    checked; true when only the day is checked; else the open flag.  Null where
    the calendar does not cover the day that it would have to ask."""
    s, o = col_of(is_session), col_of(is_open)
    if check_trading_day:
        blocked = ~s
        return F.when(s.isNull(), F.lit(None)).when(blocked, F.lit(False)).otherwise(F.lit(True) if not check_current_time else o)
    return F.lit(True) if not check_current_time else o


def close_gate(is_session, is_open) -> Column:
    """closed = not (session and open); null where the date is not covered."""
    return ~(col_of(is_session) & col_of(is_open))


def trading_ticks(spine: DataFrame, first: str = "14:30:00", last: str = "20:30:00") -> DataFrame:
    """P25: weekday hourly ticks (UTC) from ``first`` to ``last``."""
    wk = spine.filter(~F.dayofweek("date").isin(1, 7))
    at = lambda t: F.to_timestamp(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" " + t)))
    return wk.select("date", F.explode(F.sequence(at(first), at(last), F.expr("INTERVAL 1 HOUR"))).alias("tick"))
