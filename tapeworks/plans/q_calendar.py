"""Market-calendar queries over ``events`` (§2.4 P22–P25, P27; §2.5 D7–D9).

Holidays and early closes are the published lists of 2024 and 2025, given to
the operators as tables with the range they cover.  One event in 97 is read as a
year later (2025, covered) and one as three years later (not covered).  Users of
even number trade on one exchange, the others on another that keeps the same days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators import calendar as C
from tapeworks.plans.catalog import register
from tapeworks.sources.tables import as_utc, table

MARKETS = ("XNYS", "XNAS")
_SHIFT_1, _SHIFT_3 = 1, 2   # residues of event_id % 97


def _events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    ts, way = as_utc("ts"), F.col("event_id") % 97
    later = lambda years: ts + F.make_interval(years=F.lit(years))
    market = F.element_at(F.array(*[F.lit(m) for m in MARKETS]), (F.col("user_id") % 2 + 1).cast("int"))
    return e.select("event_id", market.alias("market"), F.when(way == _SHIFT_1, later(1)).when(way == _SHIFT_3, later(3)).otherwise(ts).alias("ts"))


def _lists(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(holidays, early closes) as tables."""
    holidays = spark.createDataFrame([(m, d) for m in MARKETS for d in C.HOLIDAYS_2024 + C.HOLIDAYS_2025], "market string, d string")
    early = spark.createDataFrame([(m, *x) for m in MARKETS for x in C.EARLY_CLOSES_2024 + C.EARLY_CLOSES_2025],
                                  "market string, d string, close_time string")
    return (holidays.select("market", F.to_date("d").alias("date")), early.select("market", F.to_date("d").alias("date"), "close_time"))


def _spine(spark: SparkSession, sf: str) -> DataFrame:
    return C.date_spine(_events(spark, sf))


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The sessions among the events' own dates."""
    return C.sessions(C.event_dates(_events(spark, sf)), *_lists(spark), coverage=C.COVERAGE)


def _following(spark: SparkSession, sf: str) -> DataFrame:
    return C.next_sessions(C.event_dates(_events(spark, sf)), *_lists(spark), coverage=C.COVERAGE)


_HOL = ", ".join(f"('{d}')" for d in C.HOLIDAYS_2024 + C.HOLIDAYS_2025)
_EARLY = ", ".join(f"('{d}', '{t}')" for d, t in C.EARLY_CLOSES_2024 + C.EARLY_CLOSES_2025)
_CAL_SQL = f"""e AS (
  SELECT event_id, ts + CASE event_id % 97 WHEN {_SHIFT_1} THEN INTERVAL 1 YEAR WHEN {_SHIFT_3} THEN INTERVAL 3 YEAR ELSE INTERVAL 0 DAY END AS ts
  FROM events),
bounds AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM e),
spine AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
          FROM bounds),
long_spine AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) + INTERVAL 400 DAY, INTERVAL 1 DAY)) AS DATE) AS date
          FROM bounds),
hol AS (SELECT CAST(d AS DATE) AS date FROM (VALUES {_HOL}) t(d)),
early AS (SELECT CAST(d AS DATE) AS date, t AS close_time FROM (VALUES {_EARLY}) x(d, t)),
cal AS (
  SELECT s.date,
    timezone('UTC', timezone('{C.EXCHANGE_ZONE}', CAST(strftime(s.date, '%Y-%m-%d') || ' {C.OPEN_TIME}' AS TIMESTAMP))) AS open_utc,
    timezone('UTC', timezone('{C.EXCHANGE_ZONE}', CAST(strftime(s.date, '%Y-%m-%d') || ' ' ||
      coalesce(e.close_time, '{C.CLOSE_TIME}') AS TIMESTAMP))) AS close_utc
  FROM long_spine s LEFT JOIN early e ON s.date = e.date
  WHERE isodow(s.date) <= 5 AND s.date BETWEEN DATE '{C.COVERAGE[0]}' AND DATE '{C.COVERAGE[1]}' AND s.date NOT IN (SELECT date FROM hol)),
nxt AS (SELECT date, min(CASE WHEN date IN (SELECT date FROM cal) THEN date END)
          OVER (ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_session FROM long_spine),
ev AS (
  SELECT e.event_id, e.ts, x.known, CASE WHEN x.known THEN c.date IS NOT NULL END AS is_session,
    CASE WHEN NOT x.known THEN '{C.UNCOVERED}' END AS calendar_error,
    CASE WHEN x.known THEN coalesce(e.ts >= c.open_utc AND e.ts < c.close_utc, false) END AS is_open, c.open_utc, c.close_utc, n.next_session
  FROM (SELECT *, CAST(ts AS DATE) BETWEEN DATE '{C.COVERAGE[0]}' AND DATE '{C.COVERAGE[1]}' AS known FROM e) x
  JOIN e ON e.event_id = x.event_id
  LEFT JOIN cal c ON CAST(e.ts AS DATE) = c.date LEFT JOIN nxt n ON CAST(e.ts AS DATE) = n.date)"""


def _iso(x: str) -> str:
    return (f"(CASE WHEN epoch_us({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00')")


def _sql(body: str) -> str:
    return f"WITH {_CAL_SQL}\n{body}"


@register("sessions", _sql("""
SELECT strftime(date, '%Y-%m-%d') AS date, strftime(open_utc, '%Y-%m-%d %H:%M:%S') AS open_utc,
       strftime(close_utc, '%Y-%m-%d %H:%M:%S') AS close_utc FROM cal WHERE date IN (SELECT date FROM spine)"""))
def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Session days with UTC open and close over the events' date span."""
    cal = C.sessions(_spine(spark, sf), *_lists(spark), coverage=C.COVERAGE)
    return cal.select(F.date_format("date", "yyyy-MM-dd").alias("date"),
                      F.date_format("open_utc", "yyyy-MM-dd HH:mm:ss").alias("open_utc"),
                      F.date_format("close_utc", "yyyy-MM-dd HH:mm:ss").alias("close_utc"))


@register("session_filter", _sql(f"""
SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, calendar_error FROM ev WHERE is_session OR calendar_error IS NOT NULL"""))
def session_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Events that fall on a session day (UTC date), and error rows for
    those whose date the calendar does not cover."""
    e = _events(spark, sf)
    s = C.session_filter(e, _calendar(spark, sf)).withColumn("calendar_error", F.lit(None).cast("string"))
    both = s.unionByName(C.uncovered(e, C.COVERAGE))
    return both.select("event_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "calendar_error")


def _minutes(spark: SparkSession, sf: str) -> DataFrame:
    return C.open_minute(_events(spark, sf), _calendar(spark, sf), coverage=C.COVERAGE)


@register("open_minute_join", _sql("SELECT event_id, is_session, is_open, calendar_error FROM ev"))
def open_minute_join(spark: SparkSession, sf: str) -> DataFrame:
    """Is the market open at each event's instant (open inclusive, close exclusive)."""
    return _minutes(spark, sf).select("event_id", "is_session", "is_open", "calendar_error")


@register("next_session", _sql("SELECT event_id, strftime(next_session, '%Y-%m-%d') AS next_session FROM ev"))
def next_session(spark: SparkSession, sf: str) -> DataFrame:
    """The first session strictly after each event's UTC date."""
    n = C.next_session(_events(spark, sf), _following(spark, sf))
    return n.select("event_id", F.date_format("next_session", "yyyy-MM-dd").alias("next_session"))


@register("market_status", _sql(f"""
SELECT event_id, is_open, is_session AS is_trading_day, {_iso('ts')} AS current_time,
  CASE WHEN is_session THEN {_iso('open_utc')} END AS open_time,
  CASE WHEN is_session THEN {_iso('close_utc')} END AS close_time,
  CASE WHEN NOT is_session THEN strftime(next_session, '%Y-%m-%d') END AS next_trading_day, calendar_error
FROM ev"""))
def market_status(spark: SparkSession, sf: str) -> DataFrame:
    """The market-status row as of each event's instant."""
    m = C.market_status(_events(spark, sf), _calendar(spark, sf), _following(spark, sf), coverage=C.COVERAGE)
    return m.select("event_id", "is_open", F.col("is_session").alias("is_trading_day"), "current_time",
                    "open_time", "close_time", "next_trading_day", "calendar_error")


@register("market_open_gate", _sql("""
SELECT event_id,
  CASE WHEN NOT known THEN NULL WHEN NOT is_session THEN false ELSE is_open END AS gate_day_and_time,
  CASE WHEN NOT known THEN NULL WHEN NOT is_session THEN false ELSE true END AS gate_day_only,
  is_open AS gate_time_only, true AS gate_none, calendar_error
FROM ev"""))
def market_open_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The wait-for-open decision for all four flag settings."""
    o = _minutes(spark, sf)
    g = lambda td, ct: C.open_gate("is_session", "is_open", td, ct)
    return o.select("event_id", g(True, True).alias("gate_day_and_time"), g(True, False).alias("gate_day_only"),
                    g(False, True).alias("gate_time_only"), g(False, False).alias("gate_none"),
                    "calendar_error")


@register("market_close_gate", _sql("SELECT event_id, NOT (is_session AND is_open) AS closed, calendar_error FROM ev"))
def market_close_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The wait-for-close decision: closed unless a session is open."""
    return _minutes(spark, sf).select("event_id", C.close_gate("is_session", "is_open").alias("closed"), "calendar_error")


@register("trading_ticks", _sql("""
SELECT strftime(t.tick, '%Y-%m-%d %H:%M:%S') AS tick,
  coalesce(t.tick >= c.open_utc AND t.tick < c.close_utc, false) AS is_open
FROM (SELECT date, unnest(generate_series(CAST(date AS TIMESTAMP) + INTERVAL '14 hours 30 minutes',
                                          CAST(date AS TIMESTAMP) + INTERVAL '20 hours 30 minutes', INTERVAL 1 HOUR)) AS tick
      FROM spine WHERE isodow(date) <= 5) t LEFT JOIN cal c ON t.date = c.date"""))
def trading_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """P25: weekday hourly ticks 14:30–20:30 UTC, each tagged open or closed."""
    spine = _spine(spark, sf)
    cal = C.sessions(spine, *_lists(spark), coverage=C.COVERAGE)
    ticks = C.trading_ticks(spine)
    o = C.open_minute(ticks.drop("date"), cal, ts="tick")
    return o.select(F.date_format("tick", "yyyy-MM-dd HH:mm:ss").alias("tick"), "is_open")
