"""Costly work on small files is shared by all tasks of a shuffle, whatever the files' row groups."""

import datetime as dt

from tapeworks.operators.contract_check import document_codes
from tapeworks.plans import bindings as B
from tapeworks.plans import q_documents, q_streams


def write(df, path):
    df.coalesce(1).write.parquet(str(path))
    return df


def test_contract_documents_of_one_row_group_go_to_many_tasks(spark, tmp_path):
    write(spark.range(40).selectExpr("id AS p_partkey", "cast(id AS int) AS p_size"), tmp_path / "part.parquet")
    docs = q_documents.documents(spark, str(tmp_path), "transcript")
    assert docs.rdd.getNumPartitions() >= 8
    assert sorted(r["p_partkey"] for r in docs.collect()) == list(range(40))


def test_object_checks_do_not_read_the_whole_value(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}}',), ("[1]",), ("{}",), ("5",)], "raw string")
    plan = df.select(document_codes("raw", "video_manifest").alias("c"))._jdf.queryExecution().analyzed().toString()
    assert ", OBJECT)" not in plan and ", ARRAY)" not in plan
    found = [r["c"] for r in df.select(document_codes("raw", "artifact").alias("c")).collect()]
    assert found == [["uri:missing", "content_type:missing", "a:unknown"], ["object_type"], ["uri:missing", "content_type:missing"], ["object_type"]]


def events(spark, tmp_path, n=300):
    rows = [(k, dt.datetime(2024, 1, 2, 10) + dt.timedelta(minutes=k), k % 7, ["view", "click", "purchase", "error"][k % 4], float(k), '{"k": %d}' % (k % 100))
            for k in range(n)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return write(spark.createDataFrame(rows, schema), tmp_path / "events.parquet")


def test_video_items_of_one_row_group_go_to_many_tasks(spark, tmp_path):
    events(spark, tmp_path)
    items = B.video_items(spark, str(tmp_path))
    assert items.rdd.getNumPartitions() >= 8
    assert sorted(r["id"] for r in items.collect()) == sorted(f"v{k}" for k in range(300))


def test_status_log_of_one_row_group_goes_to_many_tasks(spark, tmp_path):
    events(spark, tmp_path)
    log = B.job_log(spark, str(tmp_path))
    assert log.rdd.getNumPartitions() >= 8
    assert sorted(r["event_id"] for r in log.collect()) == list(range(300))


def test_a_delivery_is_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_streams, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    events(spark, tmp_path)
    q_streams._delivered(spark, str(tmp_path), "events")
    cores = spark.sparkContext.defaultParallelism
    first, again = (spark.read.parquet(f"{tmp_path}/in-events/{x}") for x in ("first", "again"))
    assert (len(first.inputFiles()), len(again.inputFiles())) == (4 * cores, cores)
    assert sorted(r[0] for r in first.select("event_id").collect()) == list(range(300))
    assert sorted(r[0] for r in again.select("event_id").collect()) == list(range(0, 300, 3))
