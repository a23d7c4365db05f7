"""One table for all namespaces, and the job table laid out by id."""

import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from jobloom.importers.quality import QUALITY_IMPORTER
from jobloom.operators import jobs as j
from jobloom.operators.publish import staged, versions
from jobloom.operators.sharedtable import SharedTable, bucket_of
from jobloom.plans import importing as imp
from jobloom.schemas import INT, STRING, shape
from jobloom.sources.tables import create_namespace
from test_ingest import World, line, user

ROW = shape(k=INT, v=STRING)


def shared(spark, tmp_path, **options):
    return SharedTable(spark, str(tmp_path / "t"), ROW, ["k"], "ns", **options)


def source(spark, rows):
    return spark.createDataFrame(rows, "ns string, k int, v string")


class Batches:
    """Merges numbered batches into a shared table."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.path, self.n = spark, tmp_path, 0
        self.table = shared(spark, tmp_path, **options)

    def merge(self, rows, mode="update", writer=None, keep=3):
        self.n += 1
        return self.table.merge([(source(self.spark, rows), mode)], writer or f"run/{self.n}",
                                str(self.path / f"scratch-{self.n}"), keep)

    def rows(self):
        return Counter((r.ns, r.k, r.v) for r in self.table.read().collect())


def test_against_a_plain_merge(spark, tmp_path):
    draw = random.Random(3)
    batches, kept, nulls = Batches(spark, tmp_path, buckets=4), {}, Counter()
    assert batches.rows() == Counter()
    for n in range(6):
        mode = "insert" if n % 3 == 2 else "update"
        keys = {(f"n{draw.randrange(4)}", draw.randrange(30)) for _ in range(draw.choice([1, 25]))}
        rows = [(ns, k, f"{n}.{k}") for ns, k in keys] + [("n0", None, f"null {n}"), ("n0", None, None)]
        batches.merge(rows, mode)
        nulls.update(rows[-2:])
        for ns, k, v in rows[:-2]:
            if mode == "update" or (ns, k) not in kept:
                kept[ns, k] = v
        assert batches.rows() == Counter((ns, k, v) for (ns, k), v in kept.items()) + nulls
    batches.merge([("n1", 1, None)])
    assert batches.rows()["n1", 1, None] == 1


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    batches = Batches(spark, tmp_path, buckets=4)
    batches.merge([("a", 1, "x"), ("a", None, "n")], writer="r/0")
    batches.merge([("a", 1, "y")], writer="r/1")
    before = batches.rows()
    assert batches.merge([("a", 1, "x"), ("a", None, "n")], writer="r/0") == 1
    assert batches.rows() == before == Counter([("a", 1, "y"), ("a", None, "n")])


def test_an_unfinished_version_is_no_base_and_goes(spark, tmp_path, monkeypatch):
    from jobloom.operators import sharedtable

    batches = Batches(spark, tmp_path, buckets=4)
    batches.merge([("a", 1, "x"), ("a", None, "n")])
    inner = sharedtable.write_version

    def lost(df, location, number, base, writer):
        from jobloom.operators.publish import put_json
        put_json(spark, f"{location}/state/{number}.json", {"done": False, "writer": writer})
        df.write.parquet(f"{location}/v={number}")
        raise OSError("lost")

    monkeypatch.setattr(sharedtable, "write_version", lost)
    with pytest.raises(OSError):
        batches.merge([("a", 1, "y"), ("a", None, "m")], writer="r/9")
    monkeypatch.setattr(sharedtable, "write_version", inner)
    assert batches.rows() == Counter([("a", 1, "x"), ("a", None, "n")])
    batches.merge([("a", 1, "y"), ("a", None, "m")], writer="r/9")
    assert batches.rows() == Counter([("a", 1, "y"), ("a", None, "n"), ("a", None, "m")])
    assert not (tmp_path / "t" / "data" / "_v=1").exists()


def written(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_bytes_written_grow_with_the_batch(spark, tmp_path):
    batches = Batches(spark, tmp_path, buckets=64)
    everything = spark.range(60_000).select(
        F.lit("n").alias("ns"), F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    batches.table.merge([(everything, "update")], "r/0", str(tmp_path / "s0"))
    data = tmp_path / "t" / "data"
    whole = written(data / "_v=0")
    batches.merge([("n", 7, "x")])
    batches.merge([("n", k, "x") for k in range(8)])
    one, some = written(data / "_v=1"), written(data / "_v=2")
    assert one < whole / 30 and one < some < whole / 5
    assert batches.table.read().count() == 60_000
    batches.merge([("other", 7, "x")])
    assert written(data / "_v=3") < 5000


def test_old_pieces_go(spark, tmp_path):
    batches = Batches(spark, tmp_path, buckets=2)
    for n in range(5):
        batches.merge([("a'b\\c", 1, str(n)), (f"n{n}", 1, str(n))], keep=2)
    assert batches.rows() == Counter([("a'b\\c", 1, "4"), *((f"n{n}", 1, str(n)) for n in range(5))])
    assert sorted(versions(spark, batches.table.location)) == [3, 4]
    folders = [f for f in (tmp_path / "t" / "data").glob("_v=*/ns=a*/_bucket=*")]
    assert len(folders) == 2


def test_only_touched_pieces_are_read(spark, tmp_path):
    batches = Batches(spark, tmp_path, buckets=8)
    batches.merge([(f"n{n}", k, "x") for n in range(5) for k in range(40)])
    pieces = batches.table.current_pieces(0).filter("ns = 'n3' and _bucket < 2")
    pieces = staged(pieces, str(tmp_path / "some"))
    rows = batches.table.of_pieces(pieces)
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    assert {(r.ns, r._bucket < 2) for r in rows.collect()} == {("n3", True)}
    batches.table.point_view(f"v_{tmp_path.name.replace('-', '_')}", 0)
    view = spark.table(f"v_{tmp_path.name.replace('-', '_')}")
    assert view.count() == 200
    plan = view.filter("ns = 'n3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ns" in plan and "= n3" in plan


def test_null_keys_are_spread(spark):
    rows = spark.range(200).select(F.lit(None).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    used = rows.select(bucket_of(ROW, ["k"], 16).alias("b")).distinct().count()
    assert used == 16


def test_the_number_of_buckets_belongs_to_the_table(spark, tmp_path):
    Batches(spark, tmp_path, buckets=4).merge([("a", 1, "x")])
    with pytest.raises(ValueError, match="4 buckets"):
        Batches(spark, tmp_path, buckets=8).merge([("a", 1, "x")], writer="other")


def test_as_many_spark_jobs_for_any_number_of_namespaces(spark, tmp_path):
    counts = []
    for n in (3, 400):
        batches = Batches(spark, tmp_path / str(n), buckets=2)
        batches.merge([(f"n{i}", 1, "x") for i in range(n)])
        group = f"ns-{tmp_path.name}-{n}"
        spark.sparkContext.setJobGroup(group, group)
        batches.merge([(f"n{i}", 1, "y") for i in range(n)])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        assert batches.rows() == Counter((f"n{i}", 1, "y") for i in range(n))
    # But listing many folders is a Spark job where listing a few is not.
    assert counts[1] <= counts[0] + 4


@pytest.fixture
def world(spark, tmp_path):
    name = "all_" + tmp_path.name.replace("-", "_")
    return World(spark, tmp_path, shared_namespace=name, buckets=2)


def test_ingest_into_views(spark, world):
    a, b = user(world) + "a", user(world) + "b"
    for i, who in [("1", a), ("2", b), ("3", a)]:
        world.job(i, who, {f"{i}/quality_report.tsv": [line("K", i), line(f"only_{i}")]})
    world.job("lost", a, {"l/quality_report.tsv": None})
    world.job("head", a, {"h/quality_report.tsv": []})
    (world.path / "bucket" / "h" / "quality_report.tsv").write_text("Name\tother\n1\t2\n")
    world.complete("1", "2", "lost", "head")
    world.run()
    assert world.names(a) == {"K": "1", "only_1": "1"} and world.names(b) == {"K": "2", "only_2": "2"}
    assert world.table(a).schema.simpleString() == QUALITY_IMPORTER.schema.simpleString()
    world.complete("3")
    world.run()
    assert world.names(a) == {"K": "3", "only_1": "1", "only_3": "3"}
    assert world.names(b) == {"K": "2", "only_2": "2"}
    errors = {k[0]: v.error_dlq for k, v in world.letters().items()}
    assert errors == {
        "lost": "No such file: bucket/l/quality_report.tsv",
        "head": "The header of bucket/h/quality_report.tsv has 2 columns instead of 14"}


def test_a_failed_batch_leaves_no_trace_in_a_shared_table(world):
    who = user(world)
    world.job("a", who, {"a/quality_report.tsv": [line("K"), line("")]})
    world.complete("a")
    inner = world.ingest.process

    def failing(batch, batch_id):
        inner(batch, batch_id)
        raise RuntimeError("lost after the work was done")

    object.__setattr__(world.ingest, "process", failing)
    with pytest.raises(Exception, match="lost after"):
        world.run()
    world.spark.sql(f"DROP VIEW {QUALITY_IMPORTER.table_name(f'u_{who}__')}")
    object.__setattr__(world.ingest, "process", inner)
    world.run()
    assert sorted(map(str, (r.Name for r in world.table(who).collect()))) == ["K", "None"]
    assert world.status() == {"a": {"start", "complete"}}


def test_one_users_broken_table_fails_only_their_jobs_in_a_shared_table(spark, world):
    good, bad = user(world) + "g", user(world) + "b"
    world.job("1", good, {"1/quality_report.tsv": [line("K")]})
    world.job("2", bad, {"2/quality_report.tsv": [line("K")]})
    create_namespace(spark, f"u_{bad}__autoimport")
    spark.sql(f"CREATE TABLE u_{bad}__autoimport.checkm2 (Name STRING) USING parquet")
    world.complete("1", "2")
    world.run()
    assert world.names(good) == {"K": "1"}
    assert world.status() == {"1": {"start", "complete"}, "2": {"start", "error"}}
    assert "plain parquet table" in world.letters()["2", "dlq_import_error"].error_dlq


def test_a_shared_table_takes_no_provider(world):
    with pytest.raises(ValueError, match="no provider"):
        replace(world.ingest, provider="delta")


def test_only_parts_of_the_job_table_are_read(spark, tmp_path):
    heads = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    files = heads.select("id", F.concat(F.lit("f"), "id").alias("file"))
    for name, df in [("heads", heads), ("files", files)]:
        j.write_jobs(df, str(tmp_path / name))
    heads, files = (spark.read.parquet(str(tmp_path / n)) for n in ("heads", "files"))
    ids = staged(spark.createDataFrame([("7",), ("2999",), ("x",)], "job_id string"), str(tmp_path / "ids"))
    few = j.asked_for(heads, ids)
    assert sorted(r.id for r in few.collect()) == ["2999", "7"] and few.columns == ["id"]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "hashpartitioning" not in plan
    importer = replace(QUALITY_IMPORTER, accepts=lambda f: f.startswith("f"))
    owned = imp.owned_files(importer, ids, files)
    assert sorted(map(tuple, owned.collect())) == [("2999", "f2999"), ("7", "f7")]
    assert "dynamicpruning" in owned._jdf.queryExecution().executedPlan().toString()


def test_parts_of_the_job_table_can_be_written_alone(spark, tmp_path):
    path = str(tmp_path / "jobs")
    row = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("x"))
    j.write_jobs(row, path)
    part = row.filter(j.id_part(F.col("id")) < 10).withColumn("x", F.lit(2))
    n = part.count()
    j.write_jobs(part, path)
    assert Counter(r.x for r in spark.read.parquet(path).collect()) == {1: 500 - n, 2: n}


def test_outputs_keep_the_part(spark):
    jobs = spark.createDataFrame([("a", 3, [("f", "c")])], "id string, id_part int, "
                                 "outputs array<struct<file:string,crc64nvme:string>>")
    assert j.explode_outputs(jobs).columns == ["id", "id_part", "file", "crc64nvme"]
