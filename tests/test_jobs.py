import pytest
from pyspark.sql import functions as F

from jobloom.operators import jobs as j, route as r
from jobloom.operators.publish import staged
from jobloom.schemas import JOB
from jobloom.sources import registry as reg

STEP = "array<struct<state:string,time:string,trans_id:string,notif_sent:boolean>>"


def headers(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    body = {f.name: F.lit(None).cast(f.dataType) for f in JOB
            if f.name not in ("id", "output_file_count", "outputs_part", "outputs")}
    return df.withColumns(body)


@pytest.mark.parametrize("limit", [j.BROADCAST_JOBS, 0])
def test_hot_job_is_nested_in_parts_and_nothing_is_lost(spark, monkeypatch, limit):
    """One job owns most files; both ways of spreading them give the same whole."""
    monkeypatch.setattr(j, "BROADCAST_JOBS", limit)
    rows = [("hot", f"b/{n}", "c" * 12) for n in range(500)] + [("cold", "b/x", "c" * 12)]
    files = spark.createDataFrame(rows, "id string, file string, crc64nvme string")
    jobs = j.build_jobs(headers(spark, ["hot", "cold", "none"]), files, part_size=50)
    assert jobs.select(*JOB.names).schema.simpleString() == JOB.simpleString()
    got = jobs.select("id", "outputs_part", "output_file_count", F.size("outputs").alias("n"))
    by_id = {}
    for row in got.collect():
        by_id.setdefault(row.id, []).append(row)
    assert len(by_id["hot"]) == 10 and max(x.n for x in by_id["hot"]) < 100
    assert {x.output_file_count for x in by_id["hot"]} == {500}
    assert [(x.outputs_part, x.output_file_count, x.n) for x in by_id["none"]] == [(0, 0, 0)]
    out = j.explode_outputs(jobs)
    assert sorted(map(tuple, out.collect())) == sorted(rows)
    assert j.job_headers(jobs).count() == 3


def plain_plan(df):
    """The physical plan with no join broadcast for its size."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.autoBroadcastJoinThreshold")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def some_jobs(spark, sizes):
    rows = [(f"j{i}", f"b/{i}/{k}", f"{k:012d}") for i, n in enumerate(sizes) for k in range(n)]
    files = spark.createDataFrame(rows, "id string, file string, crc64nvme string")
    return rows, headers(spark, [f"j{i}" for i in range(len(sizes))]), files


def test_many_jobs_of_several_parts_are_exchanged_once(spark, monkeypatch):
    """However many jobs have more than one part: headers and files meet by job, no row is repeated."""
    monkeypatch.setattr(j, "BROADCAST_JOBS", 0)
    rows, heads, files = some_jobs(spark, [6] * 100)
    plan = plain_plan(j.build_jobs(heads, files, part_size=4))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Generate") == 1
    jobs = j.build_jobs(heads, files, part_size=4).select("id", "outputs_part", "outputs").collect()
    assert sorted((x.id, x.outputs_part) for x in jobs) == sorted(
        (f"j{i}", p) for i in range(100) for p in (0, 1))
    assert sorted((x.id, *o) for x in jobs for o in x.outputs) == sorted(rows)


@pytest.mark.parametrize("limit", [j.BROADCAST_JOBS, 0])
@pytest.mark.parametrize("spread", [1, 8])
def test_parts_do_not_depend_on_how_jobs_are_spread(spark, monkeypatch, limit, spread):
    """A file's part is its hash's; parts that no file falls into are there. Files without a job and
    headers that repeat change nothing."""
    monkeypatch.setattr(j, "BROADCAST_JOBS", limit)
    monkeypatch.setattr(j, "SPREAD_PARTS", spread)
    sizes = [0, 1, 4, 5, 8, 9, 33, 200]
    rows, heads, files = some_jobs(spark, sizes)
    lost = spark.createDataFrame([(None, "b", "c"), ("none", "b", "c")] * 20, files.schema)
    jobs = j.build_jobs(heads.union(heads.filter("id = 'j7'")), files.union(lost), part_size=4)
    n_parts = {f"j{i}": max(1, -(-n // 4)) for i, n in enumerate(sizes)}
    hashed = files.select("*", F.xxhash64("file", "crc64nvme").alias("h")).collect()
    want = {(i, p): [] for i, n in n_parts.items() for p in range(n)}
    for x in hashed:
        want[x.id, x.h % n_parts[x.id]].append((x.file, x.crc64nvme))
    got = [((x.id, x.outputs_part), x.output_file_count, [tuple(o) for o in x.outputs])
           for x in jobs.collect()]
    twice = [k for k in want if k[0] == "j7"]
    assert sorted(got) == sorted(
        (k, sizes[int(k[0][1:])], sorted(want[k])) for k in [*want, *twice])


def test_exploded_outputs_move_each_file_once(spark, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_JOBS", 0)
    rows, heads, files = some_jobs(spark, [6] * 100)
    out = j.explode_outputs(j.build_jobs(heads, files, part_size=4))
    plan = plain_plan(out)
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Generate") == 2
    assert sorted(map(tuple, out.collect())) == sorted(rows)


def test_salted_jobs_are_fewer_than_the_files(spark, monkeypatch):
    """Nor are they broadcast, however small Spark takes them to be."""
    seen, with_parts = [], j._with_parts
    monkeypatch.setattr(j, "BROADCAST_JOBS", 0)
    monkeypatch.setattr(j, "_with_parts", lambda files, large, salts: seen.append(
        large.count() * salts) or with_parts(files, large, salts))
    rows, heads, files = some_jobs(spark, [40] * 20)
    out = j.explode_outputs(j.build_jobs(heads, files, part_size=4))
    assert seen == [80] and len(rows) == 800
    plan = out._jdf.queryExecution().executedPlan().toString()
    salted = [x for x in plan.splitlines() if "Join" in x and "_salt" in x]
    assert salted and all("SortMergeJoin" in x for x in salted)
    assert sorted(map(tuple, out.collect())) == sorted(rows)


def test_completion_is_the_last_one(spark):
    df = spark.createDataFrame([
        ([("created", "t0", "a", True), ("complete", "t1", "b", True),
          ("complete", "t2", "c", True), ("error", "t3", "d", True)],),
        ([("created", "t0", "a", True)],), ([],), (None,)], f"t {STEP}")
    got = [x[0] for x in df.select(j.completion_time(F.col("t"))).collect()]
    assert got == ["t2", None, None, None]


def test_routes_after_the_joins(spark):
    time = "2025-05-08T01:02:03+00:00"
    heads = spark.createDataFrame([
        ("a", "u", ("img", "d"), 1, 2, [("complete", time)]),
        ("b", "u", ("img", "d"), 1, 2, [("created", time)]),
        ("c", "u", ("other", "d"), 1, 2, [("complete", time)]),
        ("d", None, ("img", "d"), 1, 2, [("complete", time)]),
    ], "id string, user string, image struct<name:string,digest:string>, input_file_count int, "
       "output_file_count bigint, transition_times array<struct<state:string,time:string>>")
    registry = spark.createDataFrame([("img", "m")], "image string, module string").withColumn(
        "meta", F.parse_json(F.lit("{}")))
    events = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), (None,), ("a",)],
                                   "job_id string")
    full = j.dispatch(j.enrich(events, heads), registry).select("job_id", r.job_route())
    assert sorted(map(tuple, full.collect()), key=repr) == sorted([
        ("a", r.IMPORT), ("a", r.IMPORT), ("b", r.BAD_JOB), ("c", r.NO_OPERATION),
        ("d", r.BAD_JOB), ("e", r.NO_JOB), (None, r.NO_JOB)], key=repr)
    lost = {x.job_id for x in j.missing_jobs(events, heads).collect()}
    assert lost == {"e", None}


def test_job_table_is_cut_to_a_small_set_of_ids(spark, tmp_path):
    """Few ids are broadcast to the scan of the job table; ids of unknown size are not."""
    heads = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    ids = spark.createDataFrame([("7",), ("x",)], "job_id string")
    assert j.asked_for(heads, ids) is heads
    few = j.asked_for(heads, staged(ids, str(tmp_path / "ids")))
    assert [r.id for r in few.collect()] == ["7"]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_registry_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"image": "i", "py_module": "m",\n "importer_meta": {"x": 1}}')
    (tmp_path / "b.json").write_text('{"image": "i", "py_module": "n"}')
    (tmp_path / "c.json").write_text('{"image": "", "py_module": null}')
    df = reg.read_registry(spark, str(tmp_path))
    got = sorted((x.image, x.module, x.m) for x in
                 df.filter("module is not null").withColumn("m", F.to_json("meta")).collect())
    assert got == [("i", "m", '{"x":1}'), ("i", "n", "{}")]
    bad = reg.invalid_rows(df).collect()
    assert [x.violations for x in bad] == [["image", "module"]]
    with pytest.raises(ValueError, match="a.json and .*b.json"):
        reg.require_sound(df)
    (tmp_path / "d.json").write_text('{"image": "j", "py_module": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        reg.read_registry(spark, str(tmp_path)).collect()
    twice = reg.conflicts(df).head()
    assert (twice.image, twice.n) == ("i", 2)
    assert twice.first_file.endswith("a.json") and twice.last_file.endswith("b.json")
