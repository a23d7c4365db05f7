"""Job files read by tasks, against Spark's own scan of the same files."""

import gzip
import io
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobloom.operators.publish import staged
from jobloom.sources import joboutputs as jo
from jobloom.sources.files import scan_delimited

COLUMNS = ["a", "b"]
PIECES = st.lists(st.sampled_from([b"\n", b"\r", b"\r\n", b"x", b"yy", b"", b"z" * 9]), max_size=30)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 20))
def test_ranges_hold_each_line_once(pieces, width):
    data = b"".join(pieces)
    lines = jo.LINE_END.split(data)
    expected = lines if lines[-1] else lines[:-1]
    got = []
    for low in range(0, len(data), width):
        got += jo.range_lines(io.BytesIO(data), low, low + width, len(data), piece=3)
    assert got == expected


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 20))
def test_streams_hold_each_line_once(pieces, width):
    data = b"".join(pieces)
    lines = jo.LINE_END.split(data)
    expected = lines if lines[-1] else lines[:-1]
    assert [x for some in jo.whole_lines(io.BytesIO(data), width) for x in some] == expected


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(content) if name.endswith(".gz") else content)
    return name


def read(spark, tmp_path, files, **options):
    table = staged(spark.createDataFrame(files, "id string, file string"), str(tmp_path / "files"))
    located = staged(jo.locate(table, f"{tmp_path}/", COLUMNS, "\t"), str(tmp_path / "located"))
    return jo.read_rows(located, f"{tmp_path}/", COLUMNS, "\t", **options), located


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


CONTENTS = {
    "plain.tsv": b"a\tb\n1\tNone\n2\t\n", "no end.tsv": b"a\tb\n3\tx", "crlf+x%41.tsv": b"a\tb\r\n4\tx\r\n\r\n5\ty\r\n",
    "mac.tsv": b"a\tb\r6\tx\r7\ty", "blank.tsv": b"\n \n\t\na\tb\n\n\t\n8\tx\n", "bom.tsv": b"\xef\xbb\xbfa\tb\n9\tz\n",
    "quotes.tsv": b'a\tb\n"10"\t"x\ty"\n"11\t\n12\t""\n13\t"a ""b"""\n', "short.tsv": b"a\tb\n14\n15\tx\tmore\n",
    "utf.tsv": "a\tb\n16\té中\n".encode() + b"17\t\xff\xfe\n", "packed.tsv.gz": b"a\tb\n18\tx\r\n19\ty\n", "empty.tsv": b"",
    "header.tsv": b"a\tb\n", "twice.tsv": b"a\tb\na\tb\n20\tx\n", "case.tsv": b"A\tb\n21\tx\n",
}


@pytest.mark.parametrize("name", sorted(CONTENTS))
@pytest.mark.parametrize("range_bytes", [jo.RANGE_BYTES, 5])
def test_as_spark_reads_them(spark, tmp_path, name, range_bytes):
    write(tmp_path, name, CONTENTS[name])
    got, located = read(spark, tmp_path, [("j", name)], range_bytes=range_bytes)
    assert located.filter("fault is not null").count() == 0
    assert rows_of(got) == rows_of(scan_delimited(spark, str(tmp_path / name), COLUMNS))


def test_faults_are_rows(spark, tmp_path):
    write(tmp_path, "good", b"a\tb\n1\tx\n")
    write(tmp_path, "other", b"a\tc\n1\tx\n")
    write(tmp_path, "wide", b"a\tb\tc\n1\tx\ty\n")
    (tmp_path / "folder").mkdir()
    names = ["good", "other", "wide", "folder", "gone", None]
    got, located = read(spark, tmp_path, [("j", n) for n in names] + [("k", "good"), ("k", "good")])
    assert {r.file: r.fault for r in located.collect()} == {
        "good": None, "other": "The header of other names column 2 'c' instead of 'b'",
        "wide": "The header of wide has 3 columns instead of 2", "folder": "Not a file: folder",
        "gone": "No such file: gone", None: "A file without a name"}
    assert sorted(map(tuple, got.collect())) == [("j", "1", "x"), ("k", "1", "x"), ("k", "1", "x")]


def test_no_files(spark, tmp_path):
    got, located = read(spark, tmp_path, [])
    assert got.count() == 0 and located.count() == 0


def test_a_large_file_is_many_tasks(spark, tmp_path):
    draw = random.Random(1)
    lines = [f"{n}\t{'x' * draw.randrange(200)}" for n in range(5000)]
    write(tmp_path, "big", ("a\tb\n" + "\n".join(lines)).encode())
    got, _ = read(spark, tmp_path, [("j", "big")], range_bytes=20_000)
    assert got.select("a").distinct().count() == 5000 and got.count() == 5000
    tasks = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(tasks) > 8 and max(tasks) < 2500


def jobs_run(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_as_many_spark_jobs_for_any_number_of_files(spark, tmp_path):
    counts = []
    for n in (3, 2500):
        folder = tmp_path / str(n)
        names = [write(folder, f"{k}.tsv", b"a\tb\n%d\tx\n" % k) for k in range(n)]
        group = f"files-{tmp_path.name}-{n}"
        counts.append(jobs_run(spark, group, lambda: read(
            spark, folder, [("j", x) for x in names])[0].write.parquet(str(folder / "out"))))
        assert spark.read.parquet(str(folder / "out")).count() == n
    assert counts[0] == counts[1]


def test_names_of_stores(spark):
    assert jo.split_uri("s3a://bucket/a b%20c") == ("s3a", "bucket/a b%20c")
    assert jo.split_uri("file:///x/y") == ("file", "/x/y") and jo.split_uri("file:/x") == ("file", "/x")
    assert jo.split_uri("/x") == ("", "/x")
    assert jo.opens(spark, "/tmp/") and jo.opens(spark, "s3a://b/") and not jo.opens(spark, "viewfs://b/")
