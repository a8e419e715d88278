"""Plan shapes and every registered query against its DuckDB oracle."""

import contextlib
import datetime as dt
import io
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tapeworks.plans import catalog
from tapeworks.sources.tables import TABLES

STREAMING_OR_WRITES = {"stream_uploads", "stream_job_state", "daily_uploads", "write_replace", "append_revision",
                       "stream_idempotent_requests"}


def _plan(df, mode: str = "simple") -> str:
    """The plan text ``DataFrame.explain`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def queries():
    return catalog.queries()


def test_no_python_in_any_plan(spark, queries):
    for name, fn in queries.items():
        if name in STREAMING_OR_WRITES:
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_window_filter_reaches_scan(spark, queries):
    df = queries["window_half_open"](spark, SF_SMALL)
    text = _plan(df, "formatted")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


def test_top_k_uses_window_group_limit(spark, queries):
    plan = _plan(queries["top_k_per_channel"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_calendar_joins_are_broadcast_once_measured(spark, queries):
    for name in ("session_filter", "open_minute_join", "next_session"):
        df = queries[name](spark, SF_SMALL)
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in final and "BroadcastNestedLoopJoin" not in final, name


def test_flagship_reads_stored_pages_and_events(spark, queries):
    plan = _plan(queries["channel_events"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") <= 6


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["uri", "channel_id", "video_count", "video_ids", "published_after", "published_before"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, queries, name):
    sdf = queries[name](spark, SF_SMALL)
    res = duck.execute(catalog.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(dcols, res.fetchall())


def test_handle_lookup_broadcasts_small_dimension(spark, queries):
    plan = _plan(queries["resolve_channels"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_streams_equal_batch(spark, queries):
    """SURVEY §5 (4): the streaming forms give the batch results on the same files."""
    def rows_of(name):
        return sorted(map(tuple, queries[name](spark, SF_SMALL).collect()))
    assert rows_of("stream_uploads") == rows_of("window_half_open")
    latest = sorted((r["job_id"], r["status"], r["updated_at"]) for r in queries["latest_job"](spark, SF_SMALL).collect())
    assert rows_of("stream_job_state") == latest


def test_nothing_is_gathered_in_one_partition(spark, queries):
    """SURVEY §4: every window is partitioned.  The date spine of two calendar
    keys comes from a one-row aggregate."""
    allowed = {"sessions", "trading_ticks"}
    for name, fn in queries.items():
        if name in STREAMING_OR_WRITES or name in allowed:
            continue
        assert "SinglePartition" not in _plan(fn(spark, SF_SMALL)), name


def test_filters_pass_the_parse_generator(spark):
    """evaluate_once stops re-parsing, not pushdown: a filter on a
    pass-through column still reaches the Parquet scan."""
    from pyspark.sql import functions as F
    from tapeworks.plans import bindings as B
    from tapeworks.sources.contracts import CONTRACTS, parse_contract
    df = parse_contract(B.artifact_docs(spark, SF_SMALL), "raw", CONTRACTS["artifact"]).filter(F.col("doc_id") < 10)
    assert "PushedFilters: [IsNotNull(doc_id), LessThan(doc_id,10)]" in _plan(df, "formatted")


def test_timeline_documents_are_built_once(spark, queries):
    """Scans and shuffles of the initial plans: flat rows once, loops inside the row."""
    for name, scans, shuffles in (("transcript_contract", 4, 10), ("timeline_contracts", 4, 10), ("channel_events", 2, 6)):
        plan = _plan(queries[name](spark, SF_SMALL))
        assert plan.count("FileScan parquet") <= scans, name
        assert len(re.findall(r"\bExchange ", plan)) <= shuffles, name  # broadcasts are no shuffles
