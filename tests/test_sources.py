import pytest
from pyspark.sql import functions as F

from jobloom.plans.selfcheck import self_check
from jobloom.schemas import EMPLOYEES, FLOAT, INT, RECORD, STRING, shape
from jobloom.session import build_session, session_settings, shared_dir
from jobloom.sources import events as ev, files, tables


def test_delimited_files(spark, tmp_path):
    """Several files in one scan; an empty field is NULL, the word None is not."""
    (tmp_path / "one+two three.tsv").write_text("a\tb\n1\tNone\n2\t\n")
    (tmp_path / "two.tsv").write_text("a\tb\nx\ty\n")
    paths = [str(tmp_path / "one+two three.tsv"), str(tmp_path / "two.tsv")]
    df = files.scan_delimited(spark, paths, ["a", "b"])
    bare = {f: files_path.lstrip("/") for f, files_path in zip("12", paths)}
    assert sorted(map(tuple, df.collect()), key=repr) == sorted([
        ("1", "None", bare["1"]), ("2", None, bare["1"]), ("x", "y", bare["2"])], key=repr)
    target = shape(b=STRING, a=INT)
    assert sorted(map(tuple, files.cast_to_schema(df, target).collect()), key=repr) == sorted(
        [("None", 1), (None, 2), ("y", None)], key=repr)
    counts = {r.column: r.rejected for r in files.rejected_cells(df, target).collect()}
    assert counts == {"b": 0, "a": 1}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.cast_to_schema(df, target, strict=True).collect()


def test_path_slices_are_whole(spark):
    df = spark.range(1000).select(F.concat(F.lit("p"), F.col("id") % 700).alias("file"))
    slices = list(files.path_slices(df, size=100))
    assert [len(x) for x in slices] == [100] * 7 and sorted(p for s in slices for p in s) == sorted(
        {f"p{n}" for n in range(700)})
    assert list(files.path_slices(df.filter("false"))) == []


def test_missing_paths(spark, tmp_path):
    here = tmp_path / "here"
    here.write_text("x")
    gone = str(tmp_path / "gone")
    assert files.missing_paths(spark, [str(here), gone]) == [gone]


def test_literal_rows(spark):
    assert tables.literal_rows(spark, [[1, "Alice"], (2, "Bob")], EMPLOYEES).count() == 2
    for bad in [(1, None), (None, "x"), (2147483648, "x")]:
        with pytest.raises(Exception):
            tables.literal_rows(spark, [bad], EMPLOYEES).collect()


def test_self_check(spark):
    self_check(spark)
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("check_")]
    with pytest.raises(Exception):
        self_check(spark, spark.createDataFrame([(1, "x")], EMPLOYEES), provider="no_such_format")
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("check_")]


def test_kafka_options():
    topic = ev.Topic("kafka", "a:9092,b:9092", "jobs", min_partitions=600,
                     options={"kafka.group.id": "g"})
    assert ev._kafka_options(topic) == {
        "kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "jobs",
        "startingOffsets": "earliest", "minPartitions": "600", "kafka.group.id": "g"}
    with pytest.raises(ValueError):
        ev.Topic("http", "x", "jobs")


def test_dump_sizes(spark, tmp_path):
    rows = [(None, bytearray(b"abc"), "t", 0, 0, None, 0), (bytearray(b"k"), None, "t", 1, 0, None, 0)]
    topic = ev.Topic("file", str(tmp_path / "topic"), "t")
    ev.publish(spark.createDataFrame(rows, RECORD), topic)
    got = ev.dump(ev.read_events(spark, topic))
    assert sorted((r.partition, r.serialized_key_size, r.serialized_value_size)
                  for r in got.collect()) == [(0, -1, 3), (1, 1, -1)]


def test_profiles():
    conf = session_settings("cluster", executor_cores=4, max_executors=1000, warehouse="s3a://w")
    assert conf["spark.executor.cores"] == "4"
    assert conf["spark.dynamicAllocation.maxExecutors"] == "1000"
    assert conf["spark.sql.warehouse.dir"] == "s3a://w/"
    assert not any("retentionDurationCheck" in k for k in conf)
    for bad in [dict(profile="x"), dict(executor_cores=0)]:
        with pytest.raises(ValueError):
            session_settings(**bad)
    with pytest.raises(ValueError):
        build_session(" ")


def test_shared_dir_follows_the_cluster(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert a != b and (root is None or a.startswith(root))
