"""A6 replace-by-key and A7 history-keeping appends."""

from conftest import rows
from tapeworks.sources import sinks


def test_replace_touches_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "part string, id int, v string")
    sinks.write_replace(first, path, ["part"])
    sinks.write_replace(spark.createDataFrame([("a", 3, "z")], "part string, id int, v string"), path, ["part"])
    assert rows(spark.read.parquet(path), "part", "id", "v") == [("a", 3, "z"), ("b", 2, "y")]


def test_append_keeps_history_and_numbers_revisions(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.createDataFrame([("k1", 10, "a"), ("k1", 20, "b"), ("k2", 5, "c")], "key string, t long, v string")
    sinks.append_revision(spark, df, path, "key", ["t"])
    sinks.append_revision(spark, spark.createDataFrame([("k1", 30, "d")], "key string, t long, v string"),
                          path, "key", ["t"])
    assert rows(spark.read.parquet(path), "key", "revision", "v") == [
        ("k1", 1, "a"), ("k1", 2, "b"), ("k1", 3, "d"), ("k2", 1, "c")]
    assert rows(sinks.latest_revision(spark, path, "key"), "key", "revision", "v") == [("k1", 3, "d"), ("k2", 1, "c")]


def test_replace_by_key_keeps_the_other_rows(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "part string, id int, v string"
    sinks.write_replace(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "w")], schema), path, ["part"], ["id"])
    untouched = {f.name for f in (tmp_path / "t" / "part=b").iterdir()}
    sinks.write_replace(spark.createDataFrame([("a", 2, "new"), ("a", 3, "z"), ("c", 1, "c")], schema), path, ["part"], ["id"])
    assert rows(spark.read.parquet(path), "part", "id", "v") == [("a", 1, "x"), ("a", 2, "new"), ("a", 3, "z"), ("b", 1, "w"), ("c", 1, "c")]
    assert {f.name for f in (tmp_path / "t" / "part=b").iterdir()} == untouched
    sinks.write_replace(spark.createDataFrame([], schema), path, ["part"], ["id"])
    assert spark.read.parquet(path).count() == 5


def test_append_does_not_read_the_history(spark, tmp_path):
    path = str(tmp_path / "h")
    schema = "key string, t long, v string"
    sinks.append_revision(spark, spark.createDataFrame([("k1", 10, "a"), ("k2", 5, "c")], schema), path, "key", ["t"])
    new = sinks.next_revisions(spark, spark.createDataFrame([("k1", 20, "b"), ("k3", 1, "n")], schema), path, "key", ["t"])
    read = {f.rsplit("/", 1)[0].split("/bucket=")[0] for f in new.inputFiles() if f.startswith("file:")}
    assert read and all(f.endswith("h-heads") for f in read)
    assert rows(new, "key", "revision") == [("k1", 2), ("k3", 1)]
