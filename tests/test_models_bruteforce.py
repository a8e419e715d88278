"""Operators against row-at-a-time models of the reference's loops."""

import random

import pytest

from tapeworks.operators import discovery as D
from tapeworks.operators import jobs as J


def _request_loop(statuses, retries, delay):
    """The client's retry loop over a recorded sequence of responses."""
    waited = 0.0
    for attempt in range(retries + 1):
        if attempt >= len(statuses):
            return "pending", attempt, waited
        s = statuses[attempt]
        if (s == 429 or s >= 500) and attempt < retries:
            waited += delay * 2 ** attempt
            continue
        if s == 429 or s >= 500:
            return "exhausted", attempt + 1, waited
        return ("fail" if s >= 400 else "ok"), attempt + 1, waited
    raise AssertionError


@pytest.mark.parametrize("retries", [0, 2, 5])
def test_http_outcome_matches_retry_loop(spark, retries):
    rnd = random.Random(retries)
    codes = [200, 200, 429, 500, 503, 404, 403]
    log = {f"r{i}": [rnd.choice(codes) for _ in range(rnd.randint(1, 7))] for i in range(300)}
    rows = [(r, a, s) for r, ss in log.items() for a, s in enumerate(ss)]
    df = spark.createDataFrame(rows, "request_id string, attempt int, status int")
    got = {r["request_id"]: (r["outcome"], r["attempts_used"], r["backoff_s"])
           for r in J.http_outcome(df, retries=retries, delay_s=1.0).collect()}
    assert got == {r: _request_loop(ss, retries, 1.0) for r, ss in log.items()}


def _resolve(refs, handles):
    """Normalize (strip, dedupe in order), resolve handles, dedupe IDs again."""
    norm = list(dict.fromkeys(r.strip() for r in refs if r.strip()))
    out = []
    for r in norm:
        if r.startswith("@"):
            name = r[1:]
            if not name or name.startswith("@") or "/" in name or any(c.isspace() for c in name):
                continue
            cid = handles.get(name.lower())
            if cid is None:
                continue
            out.append(cid)
        else:
            out.append(r)
    return list(dict.fromkeys(out))


def test_resolve_channels_matches_the_list_logic(spark):
    rnd = random.Random(5)
    handles = {f"name{i}": f"UC{i:03d}" for i in range(20)}
    pool = ([f"@Name{i}" for i in range(25)] + [f" @name{i} " for i in range(10)] + [f"UC{i:03d}" for i in range(30)]
            + ["", "  ", "@", "@@x", "@a/b"])
    refs = [rnd.choice(pool) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(refs)), "pos long, ref string")
    dim = spark.createDataFrame([(h, c) for h, c in handles.items()], "handle string, channel_id string")
    got = [r["channel_id"] for r in D.resolve_channels(df, dim).filter("error IS NULL").orderBy("pos").collect()]
    assert got == _resolve(refs, handles)
