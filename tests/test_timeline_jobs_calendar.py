"""Timelines, jobs and calendar on small literal cases."""

from pyspark.sql import functions as F

from conftest import rows
from tapeworks.operators import calendar as C
from tapeworks.operators import jobs as J
from tapeworks.operators import timeline as TL

SEG = "doc_id int, seg_pos long, segment_id string, start_ms long, end_ms long, text string"
WORD = "doc_id int, segment_id string, word_pos int, start_ms long, end_ms long, text string"


def test_words_inside_segment_and_duplicates(spark):
    segs = spark.createDataFrame([(1, 0, "seg-0001", 1000, 2400, "hello world"),
                                  (1, 1, "seg-0001", 2500, 2600, "again")], SEG)
    words = spark.createDataFrame([(1, "seg-0001", 0, 1000, 1500, "hello"), (1, "seg-0001", 1, 1600, 2300, "world"),
                                   (1, "seg-0001", 2, 1550, 2450, "late")], WORD)
    first = segs.filter("seg_pos = 0")
    assert rows(TL.containment_violations(words, first), "word_pos") == [(2,)]
    assert rows(TL.word_order_violations(words, first), "word_pos") == [(2,)]
    assert rows(TL.duplicate_keys(segs, ["doc_id", "segment_id"]), "segment_id", "n") == [("seg-0001", 2)]


def test_segment_order_and_duration(spark):
    segs = spark.createDataFrame([(1, 0, "a", 0, 100, "x"), (1, 1, "b", 50, 150, "y"), (1, 2, "c", 40, 90, "z")], SEG)
    assert rows(TL.segment_order_violations(segs), "seg_pos") == [(2,)]
    docs = spark.createDataFrame([(1, 120)], "doc_id int, duration_ms long")
    assert rows(TL.duration_violations(segs, docs), "segment_id") == [("b",)]


def test_alignment_latest_and_fit(spark):
    t = spark.createDataFrame([(1, "seg-0001"), (1, "seg-0002")], "doc_id int, segment_id string")
    tr = spark.createDataFrame([(1, "seg-0001", 1, "a"), (1, "seg-0001", 2, "b")],
                               "doc_id int, segment_id string, translation_version long, translated_text string")
    syn = spark.createDataFrame([(1, "seg-0001", 1000, 2400, 1300, "a")],
                                "doc_id int, segment_id string, target_start_ms long, target_end_ms long, "
                                "actual_duration_ms long, text string")
    latest = TL.latest_translation(tr)
    assert rows(latest, "translation_version") == [(2,)]
    al = rows(TL.align_segments(t, latest, syn), "segment_id", "in_translation", "in_synthesis")
    assert al == [("seg-0001", True, True), ("seg-0002", False, False)]
    assert rows(TL.dub_fit(syn), "fit") == [("fits",)]
    assert rows(TL.stale_segments(latest, syn), "segment_id") == [("seg-0001",)]


def test_chunk_merge_restores_timeline(spark):
    # one 40 s timeline, 30 s chunks overlapping 2 s: segment at 27-29.5 s appears in both chunks
    chunks = spark.createDataFrame([(1, 0, 0, 1000, 2000, "a"), (1, 0, 0, 27000, 29500, "b"),
                                    (1, 1, 28000, -1000, 1500, "b"), (1, 1, 28000, 5000, 6000, "c")],
                                   "doc_id int, chunk long, offset_ms long, start_ms long, end_ms long, text string")
    out = rows(TL.chunk_merge(chunks, 30000, 2000), "seg_pos", "start_ms", "end_ms", "text")
    assert out == [(0, 1000, 2000, "a"), (1, 27000, 29500, "b"), (2, 33000, 34000, "c")]


def test_srt(spark):
    segs = spark.createDataFrame([(1, 0, "s1", 1000, 2400, "Hi"), (1, 1, "s2", 3723500, 3724000, "Bye")], SEG)
    assert "".join(r["srt"] for r in TL.srt_cues(segs).orderBy("cue").collect()) == (
        "1\n00:00:01,000 --> 00:00:02,400\nHi\n\n2\n01:02:03,500 --> 01:02:04,000\nBye\n\n")


def test_http_outcomes_and_backoff(spark):
    log = spark.createDataFrame([("a", 0, 429), ("a", 1, 200), ("b", 0, 500), ("b", 1, 503), ("b", 2, 500),
                                 ("c", 0, 404), ("d", 0, 503)], "request_id string, attempt int, status int")
    out = rows(J.http_outcome(log), "request_id", "outcome", "attempts_used", "backoff_s")
    assert out == [("a", "ok", 2, 1.0), ("b", "exhausted", 3, 3.0), ("c", "fail", 1, 0.0), ("d", "pending", 1, 1.0)]


def test_latest_job_gate_and_idempotency(spark):
    jobs = spark.createDataFrame([("j1", "running", "2026-08-19 00:00:00", 1), ("j1", "failed", "2026-08-19 01:00:00", 2),
                                  ("j2", "succeeded", "2026-08-19 00:00:00", 3)],
                                 "job_id string, status string, t string, event_id int").withColumn(
        "updated_ts", F.to_timestamp("t"))
    g = rows(J.success_gate(J.latest_job(jobs)), "job_id", "status", "poll_done", "outcome")
    assert g == [("j1", "failed", True, "error"), ("j2", "succeeded", True, "ok")]
    req = spark.createDataFrame([("k", 2), ("k", 1), ("m", 3)], "idempotency_key string, submitted_at int")
    assert rows(J.idempotent_requests(req)) == [("k", 1), ("m", 3)]


def _cal(spark, start, end):
    days = spark.createDataFrame([(start,), (end,)], "t string").select(F.to_timestamp("t").alias("ts"))
    spine = C.date_spine(days)
    hol = spark.createDataFrame([(d,) for d in C.HOLIDAYS_2024], "d string").select(F.to_date("d").alias("date"))
    early = spark.createDataFrame(list(C.EARLY_CLOSES_2024), "d string, close_time string").select(
        F.to_date("d").alias("date"), "close_time")
    return spine, C.sessions(spine, hol, early), (hol, early)


def test_sessions_dst_holidays_and_next(spark):
    spine, cal, lists = _cal(spark, "2024-01-01", "2024-07-10")
    s = {r["date"].isoformat(): r for r in cal.collect()}
    assert "2024-01-01" not in s and "2024-01-15" not in s and "2024-01-06" not in s
    assert s["2024-01-02"]["open_utc"].strftime("%H:%M") == "14:30"
    assert s["2024-07-02"]["open_utc"].strftime("%H:%M") == "13:30"
    assert s["2024-07-03"]["close_utc"].strftime("%H:%M") == "17:00"
    ev = spark.createDataFrame([(1, "2024-01-05 15:00:00"), (2, "2024-01-06 15:00:00"), (3, "2024-01-02 21:00:00"),
                                (4, "2024-01-02 14:30:00")], "id int, t string").withColumn("ts", F.to_timestamp("t"))
    o = {r["id"]: r for r in C.next_session(C.open_minute(ev, cal), C.next_sessions(C.event_dates(ev), *lists)).collect()}
    assert o[1]["is_open"] and not o[2]["is_open"] and not o[3]["is_open"] and o[4]["is_open"]
    assert o[1]["next_session"].isoformat() == "2024-01-08" and o[2]["next_session"].isoformat() == "2024-01-08"


def test_gate_truth_table(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, False)], "s boolean, o boolean")
    got = df.select(C.open_gate("s", "o", True, True), C.open_gate("s", "o", True, False),
                    C.open_gate("s", "o", False, True), C.open_gate("s", "o", False, False),
                    C.close_gate("s", "o")).collect()
    assert [tuple(r) for r in got] == [(True, True, True, True, False), (False, True, False, True, True),
                                       (False, False, False, True, True)]


def test_nested_rule_forms(spark):
    doc = ("doc_id int, segments array<struct<segment_id:string,start_ms:long,end_ms:long,"
           "words:array<struct<start_ms:long,end_ms:long,text:string>>>>")
    ok = [("seg-0001", 1000, 2400, [(1000, 1500, "a"), (1600, 2300, "b")])]
    bad = [("seg-0001", 1000, 2400, [(1600, 2300, "b"), (1000, 2500, "a")]), ("seg-0001", 900, 1000, [])]
    df = spark.createDataFrame([(1, ok), (2, bad)], doc)
    s = F.col("segments")
    got = df.orderBy("doc_id").select(
        F.size(F.filter(s, lambda x: ~TL.nested_words_inside(x))), F.size(F.filter(s, lambda x: ~TL.nested_words_ordered(x))),
        TL.nested_ids_unique(s), TL.nested_segments_ordered(s)).collect()
    assert [tuple(r) for r in got] == [(0, 0, True, True), (1, 1, False, False)]


def test_an_event_of_1970_is_only_another_date(spark):
    _, _, lists = _cal(spark, "2024-01-01", "2024-01-02")
    ev = spark.createDataFrame([(1, "1970-01-02 15:00:00"), (2, "2024-12-24 15:00:00"), (3, None)], "id int, t string").withColumn(
        "ts", F.to_timestamp("t"))
    cal = C.sessions(C.event_dates(ev), *lists)
    got = {r["id"]: r for r in C.next_session(C.open_minute(ev, cal), C.next_sessions(C.event_dates(ev), *lists)).collect()}
    assert got[1]["is_session"] and got[1]["next_session"].isoformat() == "1970-01-05"
    assert got[2]["is_open"] and got[2]["next_session"].isoformat() == "2024-12-26"
    assert not got[3]["is_session"] and got[3]["next_session"] is None


def test_rules_find_faults_far_apart_in_a_long_document(spark):
    n = 25_000
    segs = spark.range(n).select(
        F.lit(1).alias("doc_id"), F.col("id").alias("seg_pos"),
        F.when(F.col("id") == 24_000, "s5").otherwise(F.concat(F.lit("s"), "id")).alias("segment_id"),
        F.when(F.col("id") == 20_000, 3).otherwise(F.col("id") * 10).cast("long").alias("start_ms"),
        (F.col("id") * 10 + 9).alias("end_ms"), F.lit("t").alias("text"))
    assert rows(TL.duplicate_keys(segs, ["doc_id", "segment_id"]), "segment_id", "n") == [("s5", 2)]
    assert rows(TL.segment_order_violations(segs), "seg_pos") == [(20_000,)]
    docs = spark.createDataFrame([(1, 1000), (1, 1000)], "doc_id int, duration_ms long")
    assert TL.duration_violations(segs, docs).count() == n - 100
    nested = TL.nest_segments(segs)
    assert nested.count() == 1 and TL.flatten_segments(nested).count() == n


def test_transcript_document_checks(spark):
    import json
    from tapeworks.sources.contracts import CONTRACTS, parse_contract
    seg = lambda sid, a, b, words=(): {"segment_id": sid, "start_ms": a, "end_ms": b, "text": "t",
                                       "words": [{"start_ms": x, "end_ms": y, "text": "w"} for x, y in words]}
    base = {"source_audio": {"uri": "s3://a/b.flac", "content_type": "audio/flac"}, "language": "en",
            "duration_ms": 5000, "provider": "p", "model": "m"}
    docs = [
        {**base, "segments": [seg("s1", 1000, 2400, [(1000, 1500), (1600, 2300)])]},          # valid
        {**base, "segments": [seg("s1", 0, 100), seg("s1", 200, 300)]},                        # duplicate ID
        {**base, "segments": [seg("s1", 500, 600), seg("s2", 100, 200)]},                      # order
        {**base, "segments": [seg("s1", 0, 6000)]},                                            # beyond duration
        {**base, "language": "e", "segments": [seg("s1", 0, 100, [(50, 40)])]},                # field + word interval
        {**base, "segments": [seg("s1", 1000, 2400, [(1600, 2300), (1000, 1500)])]},           # word order
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, raw string")
    out = TL.transcript_checks(parse_contract(df, "raw", CONTRACTS["transcript"]), "id").orderBy("id").collect()
    got = [(r["field_error"], r["first_segment_error"], r["model_error"]) for r in out]
    assert got == [(None, None, None), (None, None, "segment_id_unique"), (None, None, "segment_order"),
                   (None, None, "segment_duration"), ("language", "word_interval", None),
                   (None, "word_order", None)]
    assert [r["raw_response_artifacts"] for r in out][0] == []


def test_translation_and_synthesis_document_checks(spark):
    import json
    from tapeworks.sources.contracts import CONTRACTS, parse_contract
    art = {"uri": "s3://a/b", "content_type": "application/json"}
    tseg = lambda sid, a, b, v=1: {"segment_id": sid, "source_start_ms": a, "source_end_ms": b, "source_text": "s",
                                   "translated_text": "t", "translation_version": v}
    tdoc = lambda segs: {"source_transcript": art, "source_language": "en", "target_language": "zh", "provider": "p",
                         "model": "m", "segments": segs}
    tdocs = [tdoc([tseg("seg-0001", 1000, 1400)]), tdoc([tseg("a", 500, 900), tseg("b", 100, 200)]),
             tdoc([tseg("a", 0, 10), tseg("a", 20, 30)]), tdoc([tseg("a", 10, 5)]), tdoc([tseg("a", 0, 5, v=0)])]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(tdocs)], "id int, raw string")
    t = TL.translated_timeline_checks(parse_contract(df, "raw", CONTRACTS["translated_timeline"]), "id").orderBy("id")
    assert [(r["first_segment_error"], r["model_error"]) for r in t.collect()] == [
        (None, None), (None, "segment_order"), (None, "segment_id_unique"), ("translated_interval", None),
        ("translation_version", None)]
    sseg = lambda sid, a, b, d: {"segment_id": sid, "target_start_ms": a, "target_end_ms": b, "text": "t",
                                 "voice": "v", "audio": art, "actual_duration_ms": d}
    sdoc = lambda segs: {"source_timeline": art, "language": "zh", "provider": "p", "model": "m", "voice": "v",
                         "segments": segs, "dubbed_audio": art}
    sdocs = [sdoc([sseg("seg-0001", 1000, 2400, 1300)]), sdoc([sseg("a", 500, 900, 1), sseg("b", 100, 200, 1)]),
             sdoc([sseg("a", 0, 10, 1), sseg("a", 20, 30, 1)]), sdoc([sseg("a", 0, 10, 0)])]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(sdocs)], "id int, raw string")
    s = TL.synthesis_checks(parse_contract(df, "raw", CONTRACTS["synthesis_result"]), "id").orderBy("id")
    assert [(r["first_segment_error"], r["model_error"]) for r in s.collect()] == [
        (None, None), (None, None), (None, "segment_id_unique"), ("actual_duration", None)]


def test_ticks_and_session_filter(spark):
    spine, cal, _ = _cal(spark, "2024-01-05", "2024-01-08")     # Fri .. Mon
    ticks = C.trading_ticks(spine).collect()
    assert len(ticks) == 14 and {t["tick"].strftime("%H:%M") for t in ticks} == {f"{h}:30" for h in range(14, 21)}
    ev = spark.createDataFrame([(1, "2024-01-05 23:59:00"), (2, "2024-01-06 12:00:00"), (3, "2024-01-08 00:00:01")],
                               "id int, t string").withColumn("ts", F.to_timestamp("t"))
    assert rows(C.session_filter(ev, cal), "id") == [(1,), (3,)]


def test_next_session_behind_a_long_closure(spark):
    """The exchange is closed for 40 days."""
    import datetime as dt
    closed = [dt.date(2024, 3, 4) + dt.timedelta(days=k) for k in range(40)]   # Mon 4 March .. Fri 12 April
    hol = spark.createDataFrame([(d,) for d in closed], "date date")
    early = spark.createDataFrame([], "date date, close_time string")
    days = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 3, 20),), (dt.date(2024, 4, 12),), (dt.date(2024, 4, 15),),
                                  (dt.date(2024, 3, 1),), (dt.date(2023, 12, 30),)], "date date")
    got = {str(r["date"]): str(r["next_session"]) for r in C.next_sessions(days, hol, early).collect()}
    assert got == {"2024-03-01": "2024-04-15", "2024-03-20": "2024-04-15", "2024-04-12": "2024-04-15", "2024-04-15": "2024-04-16",
                   "2023-12-30": "2024-01-01"}


def test_dates_outside_the_lists_are_errors(spark):
    hol = spark.createDataFrame([(d,) for d in C.HOLIDAYS_2024 + C.HOLIDAYS_2025], "d string").select(F.to_date("d").alias("date"))
    early = spark.createDataFrame(list(C.EARLY_CLOSES_2025), "d string, close_time string").select(F.to_date("d").alias("date"), "close_time")
    ev = spark.createDataFrame([(1, "2025-12-25 15:00:00"), (2, "2025-12-24 19:00:00"), (3, "2026-01-05 15:00:00"), (4, "2025-12-31 16:00:00")],
                               "id int, t string").withColumn("ts", F.to_timestamp("t"))
    cal = C.sessions(C.event_dates(ev), hol, early, coverage=C.COVERAGE)
    following = C.next_sessions(C.event_dates(ev), hol, early, coverage=C.COVERAGE)
    got = {r["id"]: r for r in C.market_status(ev, cal, following, coverage=C.COVERAGE).collect()}
    assert [got[i]["is_session"] for i in (1, 2, 3, 4)] == [False, True, None, True]     # Christmas is closed
    assert [got[i]["is_open"] for i in (1, 2, 3, 4)] == [False, False, None, True]       # early close at 18:00 UTC
    assert [got[i]["calendar_error"] for i in (1, 2, 3, 4)] == [None, None, C.UNCOVERED, None]
    assert got[1]["next_trading_day"] == "2025-12-26" and got[4]["next_session"] is None and got[3]["next_trading_day"] is None
    assert rows(C.session_filter(ev, cal), "id") == [(2,), (4,)] and rows(C.uncovered(ev, C.COVERAGE), "id") == [(3,)]
    gates = {r["id"]: r for r in C.open_minute(ev, cal, coverage=C.COVERAGE).select(
        "id", C.open_gate("is_session", "is_open").alias("o"), C.close_gate("is_session", "is_open").alias("c")).collect()}
    assert [(gates[i]["o"], gates[i]["c"]) for i in (1, 3, 4)] == [(False, True), (None, None), (True, False)]


def test_loop_error_against_a_plain_loop(spark):
    import random
    rng = random.Random(6)
    docs = []
    for i in range(80):
        segs = [(f"s{rng.randint(0, 9)}" if rng.random() < 0.3 else f"u{k}", rng.choice([k * 10, k * 10, 0, -5]), rng.choice([k * 10 + 5, 99]))
                for k in range(rng.randint(0, 8))]
        docs.append((i, segs, 60))
    docs.append((80, [(f"s{k}", k, k + 1) for k in range(5000)] + [("s0", 5000, 5001)], 10**6))

    def plain(segs, duration, order, limit):
        seen, before = set(), 0
        for sid, start, end in segs:
            if sid in seen:
                return "segment_id_unique"
            if order and start < before:
                return "segment_order"
            if limit and end > duration:
                return "segment_duration"
            seen.add(sid)
            before = start
        return None

    df = spark.createDataFrame(docs, "id int, segments array<struct<segment_id:string,start_ms:long,end_ms:long>>, duration_ms long")
    for order, limit in ((True, True), (True, False), (False, False)):
        got = df.select("id", TL.loop_error(F.col("segments"), "start_ms" if order else None, F.col("duration_ms") if limit else None).alias("c")).collect()
        assert {r["id"]: r["c"] for r in got} == {i: plain(s, d, order, limit) for i, s, d in docs}


def test_chunks_meet_at_their_longest_common_run(spark):
    said = "the quick brown fox jumps over the lazy dog and runs far away".split()
    words = [(1, 0, k, 20_000 + 1000 * k, 20_400 + 1000 * k, x) for k, x in enumerate(said[:10])]          # 20 .. 29.4 s
    heard = ["box", "Jumps,", "over", "the", "crazy", "dog", "and", "runs", "far", "away"]                  # from word 3; 80 ms late
    words += [(1, 1, k, 1080 + 1000 * k, 1480 + 1000 * k, x) for k, x in enumerate(heard)]                  # chunk 1 begins at 22 s
    words += [(2, 0, 0, 25_000, 25_500, "left"), (2, 0, 1, 28_000, 28_500, "gone"), (2, 1, 0, 3000, 3500, "other"), (2, 1, 1, 6500, 6900, "right")]
    df = spark.createDataFrame(words, "doc_id int, chunk long, pos long, start_ms long, end_ms long, text string")
    out = TL.aligned_chunk_merge(df, 22_000, 8_000).orderBy("doc_id", "word_no").collect()
    # doc 1: "jumps over the" is the longest run; its middle is "over".  doc 2: nothing in common, split at 26 s.
    assert " ".join(r["text"] for r in out if r["doc_id"] == 1) == "the quick brown fox jumps over the crazy dog and runs far away"
    assert [r["text"] for r in out if r["doc_id"] == 2] == ["left", "right"]
    assert [r["word_no"] for r in out if r["doc_id"] == 1] == list(range(13))


def test_longest_common_run_against_all_pairs(spark):
    import random
    rng = random.Random(2)
    data = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 9))], [rng.choice("abcd") for _ in range(rng.randint(0, 9))]) for i in range(60)]

    def plain(a, b):
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        return best

    df = spark.createDataFrame(data, "id int, a array<string>, b array<string>")
    got = {r["id"]: tuple(r["r"]) for r in df.select("id", TL.longest_common_run(F.col("a"), F.col("b")).alias("r")).collect()}
    assert got == {i: plain(a, b) for i, a, b in data}
