"""The whole stream on small files, with the golden tables and dead letters."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from jobloom.importers.quality import QUALITY_IMPORTER
from jobloom.operators import dlq, status as st
from jobloom.operators.decode import decode
from jobloom.operators.publish import (
    BASE, complete_versions, merge_and_publish, publish_version, put_json, staged, write_version,
)
from jobloom.operators.route import route
from jobloom.plans import importing as imp
from jobloom.schemas import EMPLOYEES, QUALITY, RECORD
from jobloom.sources import events as ev
from jobloom.sources.files import cast_to_schema
from jobloom.sources.registry import registry
from jobloom.sources.tables import create_namespace, literal_rows
from jobloom.streaming import flow
from jobloom.streaming.flow import Ingest

HEADER = "\t".join(n for n in QUALITY.names if n != "cts_job_id")
# Report files, the table before, and the table after the import.
RUN1 = ["GCA_replace 0.89 0.25 model3 7 0.47 148 0.48 44 0.91 34 3 14 hello",
        "GCA_ecoli 0.9 0.26 model4 8 0.48 149 0.49 45 0.92 35 4 15 "]
RUN2 = ["GCA_bsubtilis 0.91 0.27 mod 9 0.49 150 0.5 46 0.93 36 5 16 whoo"]
BEFORE = ["GCA_replace old_job 0.87 0.23 model1 5 0.45 146 0.46 42 0.89 32 1 12 None",
          "GCA_keep old_job2 0.88 0.24 model2 6 0.46 147 0.47 43 0.9 33 2 13 Lovely"]
AFTER = ["GCA_bsubtilis my_job_id 0.91 0.27 mod 9 0.49 150 0.5 46 0.93 36 5 16 whoo",
         "GCA_ecoli my_job_id 0.9 0.26 model4 8 0.48 149 0.49 45 0.92 35 4 15 ",
         "GCA_keep old_job2 0.88 0.24 model2 6 0.46 147 0.47 43 0.9 33 2 13 Lovely",
         "GCA_replace my_job_id 0.89 0.25 model3 7 0.47 148 0.48 44 0.91 34 3 14 hello"]
IMAGE = "ghcr.io/quality/reports"
TIME = "2025-05-08T01:02:03+00:00"


def quality_rows(spark, lines):
    rows = [[c or None for c in line.split(" ")] for line in lines]
    return cast_to_schema(
        spark.createDataFrame(rows, ", ".join(f"{n} string" for n in QUALITY.names)), QUALITY)


class World:
    """An ingest over files in one folder."""

    def __init__(self, spark, path, **changes):
        self.spark, self.path = spark, path
        self.jobs, self.outputs, self.offset = [], [], 0
        self.checkpoint = "checkpoint"
        self.topic = ev.Topic("file", str(path / "topic"), "jobs", max_files_per_trigger=1)
        self.ns = "control_" + path.name.replace("-", "_")
        images = spark.createDataFrame([(IMAGE, "quality_report"), ("img/unknown", "nowhere")],
                                       "image string, module string")
        known = registry(images, F.col("image"), F.col("module"), F.lit("f"),
                         F.lit(None).cast("string"))
        self.ingest = Ingest(
            headers=self.headers, registry=lambda: known,
            outputs=lambda: spark.createDataFrame(self.outputs, "id string, file string"),
            importers=[QUALITY_IMPORTER], work=str(path / "work"), tables=str(path / "tables"),
            files_root=f"{path}/", control_namespace=self.ns,
        )
        self.ingest = replace(self.ingest, **changes)

    def headers(self):
        return self.spark.createDataFrame(
            self.jobs, "id string, user string, image struct<name:string,digest:string>, "
            "input_file_count int, output_file_count bigint, "
            "transition_times array<struct<state:string,time:string>>")

    def job(self, id_, user, lines_by_file, image=IMAGE, state="complete"):
        self.jobs.append((id_, user, (image, "sha256:d"), 1, len(lines_by_file), [(state, TIME)]))
        for name, lines in lines_by_file.items():
            self.outputs.append((id_, f"bucket/{name}"))
            if lines is not None:
                file = self.path / "bucket" / name
                file.parent.mkdir(parents=True, exist_ok=True)
                file.write_text("\n".join([HEADER, *(x.replace(" ", "\t") for x in lines)]) + "\n")

    def send(self, *texts):
        rows = [(None, bytearray(t.encode()), "jobs", 0, self.offset + i, None, 0)
                for i, t in enumerate(texts)]
        self.offset += len(texts)
        ev.publish(self.spark.createDataFrame(rows, RECORD).coalesce(1), self.topic)

    def complete(self, *ids):
        self.send(*(json.dumps({"job_id": i, "state": "complete"}) for i in ids))

    def run(self):
        query = self.ingest.start(self.spark, self.topic, str(self.path / self.checkpoint),
                                  every=None)
        query.awaitTermination()

    def table(self, user):
        return self.spark.table(QUALITY_IMPORTER.table_name(f"u_{user}__"))

    def names(self, user):
        return {r.Name: r.cts_job_id for r in self.table(user).collect()}

    def status(self):
        out = {}
        for r in self.ingest.job_status(self.spark).collect():
            out.setdefault(r.job_id, set()).add(r.key.removeprefix("cse_event_processing_"))
        return out

    def letters(self):
        rows = dlq.read_dead_letters(self.spark, self.ingest.dlq).collect()
        return {(r.job_id, r.route): r for r in rows}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def user(world):
    """A user name of its own for each test, as the catalog is shared."""
    return "x" + world.path.name.replace("-", "_")


def line(name, note="n"):
    return f"{name} 0.89 0.25 m 7 0.47 148 0.48 44 0.91 34 3 14 {note}"


def test_golden_table(spark, world):
    who = user(world)
    create_namespace(spark, f"u_{who}__autoimport")
    place = f"{world.ingest.tables}/u_{who}__autoimport/checkm2"
    publish_version(quality_rows(spark, BEFORE), QUALITY_IMPORTER.table_name(f"u_{who}__"),
                    place, BASE)
    world.job("my_job_id", who, {"run1/quality_report.tsv": RUN1, "run2/quality_report.tsv": RUN2,
                                 "run1/other.tsv": ["not a report"]})
    world.complete("my_job_id")
    world.run()
    got = sorted(map(tuple, world.table(who).collect()))
    assert got == sorted(map(tuple, quality_rows(spark, AFTER).collect()))
    assert world.table(who).schema.simpleString() == QUALITY.simpleString()
    assert world.status() == {"my_job_id": {"start", "complete"}}
    assert not world.letters()


def test_outcomes(world):
    who = user(world)
    world.job("good", who, {"g/quality_report.tsv": [line("A")]})
    world.job("empty", who, {"e/other.tsv": []})
    world.job("lost", who, {"l/quality_report.tsv": None, "g2/quality_report.tsv": [line("L")]})
    world.job("twice", who, {"t/quality_report.tsv": [line("B"), line("B")]})
    world.job("cell", who, {"c/quality_report.tsv": [line("C").replace("148", "14.5x")]})
    world.job("user", "a`.b/../c", {"u/quality_report.tsv": [line("U")]})
    world.job("noop", who, {}, image="img/none")
    world.job("nowhere", who, {}, image="img/unknown")
    world.job("open", who, {}, state="created")
    world.complete("good", "empty", "lost", "twice", "cell", "user", "noop", "nowhere", "open",
                   "absent")
    world.send('{"job_id":"good","state":"running"}', "x", '{"job_id":"good"}')
    world.run()
    assert world.names(who) == {"A": "good"}
    error = {"start", "error"}
    assert world.status() == {
        "good": {"start", "complete"}, "empty": error, "lost": error, "twice": error,
        "cell": error, "user": error, "noop": {"start", "no_operation"}, "nowhere": error}
    letters = world.letters()
    assert {k: v.error_dlq for k, v in letters.items()} == {
        ("empty", "dlq_import_error"): "No checkm2 quality report files found",
        ("lost", "dlq_import_error"): "No such file: bucket/l/quality_report.tsv",
        ("twice", "dlq_import_error"): "A key repeats within the job: Name",
        ("cell", "dlq_import_error"): "A value does not fit column Contig_N50",
        ("user", "dlq_import_error"): "Not a valid namespace: u_a`.b/../c__autoimport",
        ("nowhere", "dlq_import_error"): "No importer is named nowhere",
        ("open", "dlq_bad_job"): "No complete event found for job open",
        ("absent", "dlq_no_job"): "No such job",
        (None, "dlq_malformed"): None,
        ("good", "dlq_missing_keys"): 'Message has missing required keys:\n{"job_id":"good"}',
    }
    value = json.loads(bytes(letters["empty", "dlq_import_error"].value))
    assert set(value) == {"job_id", "state", "error_dlq", "error_dlq_trace"}
    assert bytes(letters[None, "dlq_malformed"].value) == b"x"


def test_later_job_wins_within_and_across_batches(spark, world):
    who = user(world)
    for i in "abc":
        world.job(i, who, {f"{i}/quality_report.tsv": [line("K", i), line(f"only_{i}", i)]})
    world.complete("a", "b", "a")
    world.run()
    assert world.names(who) == {"K": "a", "only_a": "a", "only_b": "b"}
    world.complete("c", "b")
    world.run()
    assert world.names(who) == {"K": "b", "only_a": "a", "only_b": "b", "only_c": "c"}
    place = f"{world.ingest.tables}/u_{who}__autoimport/checkm2"
    assert complete_versions(spark, place) == [0, 1]


def test_insert_only_importer(spark, tmp_path):
    world = World(spark, tmp_path, importers=[replace(QUALITY_IMPORTER, mode="insert")])
    who = user(world)
    for i in "ab":
        world.job(i, who, {f"{i}/quality_report.tsv": [line("K", i), line("K", i + i)]})
    world.complete("b", "a")
    world.run()
    got = sorted((r.Name, r.cts_job_id, r.Additional_Notes) for r in world.table(who).collect())
    assert got == [("K", "b", "b"), ("K", "b", "bb")]


def test_old_versions_and_staged_batches_go(spark, tmp_path):
    world = World(spark, tmp_path, keep_versions=1)
    who = user(world)
    for i in "abc":
        world.job(i, who, {f"{i}/quality_report.tsv": [line(i)]})
        world.complete(i)
    world.run()
    assert world.names(who) == {"a": "a", "b": "b", "c": "c"}
    place = next((world.path / "tables").glob("u_*")) / "checkm2"
    assert sorted(p.name for p in place.glob("v=*")) == ["v=1", "v=2"]
    assert [p.name for p in (world.path / "work" / "stage").iterdir()] == ["batch=2"]


def test_rows_are_not_exchanged_by_job(spark, tmp_path):
    """One job may own most rows: they meet their job by broadcast."""
    jobs = staged(spark.createDataFrame(
        [("j", "u_x__", None, 0, 0)], "job_id string, namespace_prefix string, "
        "timestamp timestamp, partition int, offset bigint"), str(tmp_path / "jobs"))
    failed = staged(spark.createDataFrame([], "id string"), str(tmp_path / "failed"))
    typed = staged(quality_rows(spark, BEFORE).selectExpr("'j' id", "*", "'' _bad"),
                   str(tmp_path / "typed"))
    rows = imp.rows_to_merge(QUALITY_IMPORTER, jobs, typed, failed)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "hashpartitioning(id" not in plan


def test_namespaces_are_kept_apart(world):
    a, b = user(world) + "a", user(world) + "b"
    world.job("1", a, {"1/quality_report.tsv": [line("K")]})
    world.job("2", b, {"2/quality_report.tsv": [line("K")]})
    world.complete("1", "2")
    world.run()
    assert world.names(a) == {"K": "1"} and world.names(b) == {"K": "2"}


def test_a_failed_batch_is_replayed_without_trace(spark, world):
    """The batch fails after its merges; the next run gives each NULL-key row once."""
    who = user(world)
    world.job("a", who, {"a/quality_report.tsv": [line("K"), line("")]})
    world.complete("a")
    world.send("x")
    inner = world.ingest.process

    def failing(batch, batch_id):
        inner(batch, batch_id)
        raise RuntimeError("lost after the work was done")

    object.__setattr__(world.ingest, "process", failing)
    with pytest.raises(Exception, match="lost after"):
        world.run()
    object.__setattr__(world.ingest, "process", inner)
    world.run()
    assert sorted(map(str, (r.Name for r in world.table(who).collect()))) == ["K", "None"]
    assert world.status() == {"a": {"start", "complete"}}
    assert dlq.read_dead_letters(spark, world.ingest.dlq).count() == 1


def explode(rows, jobs):
    """A transform that fails for one job only, when it runs."""
    return rows.withColumn("cts_job_id", F.when(
        F.col("Additional_Notes") == "bomb", F.raise_error(F.lit("boom"))).otherwise(F.col("id")))


def test_the_job_that_makes_an_import_raise_is_found(spark, tmp_path):
    world = World(spark, tmp_path, importers=[replace(QUALITY_IMPORTER, transform=explode)])
    who = user(world)
    for i in "abc":
        world.job(i, who, {f"{i}/quality_report.tsv": [line(i, "bomb" if i == "c" else "n")]})
    world.complete(*"abc")
    world.run()
    assert world.names(who) == {i: i for i in "ab"}
    letter = world.letters()["c", "dlq_import_error"]
    assert "boom" in letter.error_dlq and "Traceback" in letter.error_dlq_trace
    assert world.status()["c"] == {"start", "error"}


def test_a_restart_clears_an_old_error(world):
    who = user(world)
    world.job("a", who, {"a/quality_report.tsv": None})
    world.complete("a")
    world.run()
    assert world.status() == {"a": {"start", "error"}}
    world.job("later", who, {"a/quality_report.tsv": [line("K")]})
    replay = dlq.as_events(dlq.read_dead_letters(world.spark, world.ingest.dlq))
    ev.publish(replay, world.topic)
    world.run()
    assert world.status() == {"a": {"start", "complete"}}
    assert world.names(who) == {"K": "a"}


def test_folded_status_goes_on(spark, world):
    who = user(world)
    world.job("a", who, {"a/quality_report.tsv": [line("K")]})
    world.job("n", who, {}, image="img/none")
    world.complete("a", "n")
    world.run()
    before = world.status()
    world.ingest.fold_status(spark, 0)
    assert world.status() == before
    world.outputs[:] = [("a", "bucket/gone/quality_report.tsv")]
    world.complete("a")
    world.run()
    after = {"a": {"start", "error"}, "n": {"start", "no_operation"}}
    assert world.status() == after
    world.ingest.fold_status(spark, 1)
    assert world.status() == after
    assert world.ingest.status_changes(spark).count() == 4


def test_decoding_and_routing_run_on_a_stream(spark, world):
    world.send('{"job_id":"a","state":"complete"}', "x", "{}")
    out = str(world.path / "routed")
    stream = route(decode(ev.stream_events(spark, world.topic))).select("offset", "route")
    query = (stream.writeStream.format("parquet").trigger(availableNow=True)
             .option("checkpointLocation", str(world.path / "cp")).start(out))
    query.awaitTermination()
    assert {r.offset: r.route for r in spark.read.parquet(out).collect()} == {
        0: "importable", 1: "dlq_malformed", 2: "dlq_missing_keys"}


def test_images_can_have_a_query_of_their_own(spark, tmp_path):
    heavy = World(spark, tmp_path / "heavy", images=[IMAGE])
    rest = World(spark, tmp_path / "rest", not_images=[IMAGE])
    for w in (heavy, rest):
        w.job("a", user(heavy) + tmp_path.name.replace("-", "_"),
              {"a/quality_report.tsv": [line("K")]})
        w.job("n", "who", {}, image="img/none")
        w.complete("a", "n", "absent")
        w.send("x")
        w.run()
    assert heavy.status() == {"a": {"start", "complete"}} and not heavy.letters()
    assert rest.status() == {"n": {"start", "no_operation"}}
    assert {k[1] for k in rest.letters()} == {"dlq_no_job", "dlq_malformed"}


def control(data, **more):
    return json.dumps({"special_event_type": "integration_test", "input_data": data} | more)


def employees(world):
    return {(r.employee_id, r.employee_name)
            for r in world.spark.table(f"{world.ns}.employees").collect()}


@pytest.mark.parametrize("mode, expected", [
    (None, {(1, "Alice"), (2, "Bobby"), (3, "Cy")}),
    ("insert", {(1, "Alice"), (2, "Bob"), (3, "Cy")})])
def test_employees(spark, world, mode, expected):
    create_namespace(spark, world.ns)
    publish_version(literal_rows(spark, [(1, "Alice"), (2, "Bob")], EMPLOYEES),
                    f"{world.ns}.employees", f"{world.ingest.tables}/{world.ns}/employees", BASE)
    world.send(control([[2, "Bobby"], [3, "Cy"]], **({"mode": mode} if mode else {})))
    world.run()
    assert employees(world) == expected
    assert not world.letters() and not world.status()


def test_control_events_one_by_one(spark, world):
    """Mixed modes in one batch; bad events leave no rows, only an audit entry."""
    world.send(
        control([[1, "a"]], mode="insert"), control([[1, "b"], [2, "b"]]),
        control([[1, "c"], [2, "c"], [3, "c"]], mode="insert"), control([[3, "d"]], mode=None),
        control([[4, None]]), control([[2147483648, "x"]]), control([["5", "x"]]),
        control([[6, "x", 1]]), control([[7, "x"], [7, "y"]]), control("no list"), control([]),
        control([[8, "p"], [8, "q"]], mode="insert"),
        '{"special_event_type":"integration_test"}',
    )
    world.run()
    assert employees(world) == {(1, "b"), (2, "b"), (3, "c"), (8, "p"), (8, "q")}
    failed = spark.read.parquet(world.ingest.audit)
    assert {r.offset for r in failed.collect()} == {4, 5, 6, 7, 8, 9, 12}


def test_status_keys_are_iso_times(world):
    world.job("n", "who", {}, image="img/none")
    world.complete("n")
    world.run()
    values = {r.key: r.value for r in world.ingest.job_status(world.spark).collect()}
    assert set(values) == {st.START, st.NO_OPERATION}
    assert all(v.endswith("+00:00") and "T" in v for v in values.values())


def test_a_new_checkpoint_on_the_same_folders_keeps_everything(spark, world):
    who = user(world)
    for i in "ab":
        world.job(i, who, {f"{i}/quality_report.tsv": [line(i)]})
    world.complete("a")
    world.send("x")
    world.run()
    world.checkpoint = "checkpoint-2"  # its batch ids start at 0 again, it reads all messages again
    world.complete("b")
    world.run()
    assert world.names(who) == {"a": "a", "b": "b"}
    assert world.status() == {i: {"start", "complete"} for i in "ab"}
    rows = dlq.read_dead_letters(spark, world.ingest.dlq).collect()
    assert len(rows) == 2 and len({r.batch_id for r in rows}) == 2


def test_missing_markers_lose_nothing(spark, world):
    who = user(world)
    for i in "ab":
        world.job(i, who, {f"{i}/quality_report.tsv": [line(i)]})
    world.complete("a")
    world.run()
    for marker in list((world.path / "tables").rglob("*_SUCCESS*")):
        marker.unlink()
    world.complete("b")
    world.run()
    assert world.names(who) == {"a": "a", "b": "b"}


def test_versions_without_state_stop_the_batch(spark, tmp_path):
    location, rows = str(tmp_path / "t"), literal_rows(spark, [(1, "a")], EMPLOYEES)
    write_version(rows, location, 0, None, "run/0")
    put_json(spark, f"{location}/state/0.json", {"version": 0, "done": False})
    # A version that was begun and not finished is no base and no obstacle.
    ns = "ns_" + tmp_path.name.replace("-", "_")
    create_namespace(spark, ns)
    merge_and_publish(spark, f"{ns}.t", location, EMPLOYEES, ["employee_id"], [(rows, "update")], "run/1")
    assert complete_versions(spark, location) == [1]
    (tmp_path / "t" / "state" / "1.json").unlink()
    with pytest.raises(ValueError, match="no state"):
        merge_and_publish(spark, f"{ns}.t", location, EMPLOYEES, ["employee_id"], [(rows, "update")], "run/2")


def test_a_batch_replayed_after_later_ones_leaves_them(spark, tmp_path):
    location = str(tmp_path / "t")
    ns = "ns_" + tmp_path.name.replace("-", "_")
    create_namespace(spark, ns)

    def publish(number, writer):
        rows = literal_rows(spark, [(number, writer)], EMPLOYEES)
        merge_and_publish(spark, f"{ns}.t", location, EMPLOYEES, ["employee_id"], [(rows, "update")], writer)

    for number, writer in enumerate(["a/0", "a/1", "b/0"]):
        publish(number, writer)
    publish(1, "a/1")
    assert sorted(r.employee_id for r in spark.table(f"{ns}.t").collect()) == [0, 1, 2]
    assert complete_versions(spark, location) == [0, 1, 2]


def test_numbers_go_on_across_runs(spark, world):
    number = lambda run, batch: world.ingest.number(spark, run, batch)
    assert [number("a", 0), number("a", 1), number("a", 1), number("b", 0), number("a", 1),
            number("a", 2), number("b", 0)] == [0, 1, 1, 2, 1, 3, 2]


def test_one_users_broken_table_fails_only_their_jobs(spark, world):
    good, bad = user(world) + "g", user(world) + "b"
    world.job("1", good, {"1/quality_report.tsv": [line("K")]})
    world.job("2", bad, {"2/quality_report.tsv": [line("K")]})
    create_namespace(spark, f"u_{bad}__autoimport")
    spark.sql(f"CREATE TABLE u_{bad}__autoimport.checkm2 (Name STRING) USING parquet")
    create_namespace(spark, world.ns)
    spark.sql(f"CREATE TABLE {world.ns}.employees (employee_id INT) USING parquet")
    world.complete("1", "2")
    world.send(control([[1, "a"]]))
    world.run()
    assert world.names(good) == {"K": "1"}
    assert world.status() == {"1": {"start", "complete"}, "2": {"start", "error"}}
    assert "plain parquet table" in world.letters()["2", "dlq_import_error"].error_dlq
    audit = spark.read.parquet(world.ingest.audit).collect()
    assert len(audit) == 1 and "plain parquet table" in audit[0].error


def test_an_outage_fails_the_batch_and_is_replayed(world, monkeypatch):
    who = user(world)
    world.job("a", who, {"a/quality_report.tsv": [line("K")]})
    world.complete("a")
    inner = flow.merge_and_publish

    def broken(*args, **options):
        raise OSError("the store is away")

    monkeypatch.setattr(flow, "merge_and_publish", broken)
    with pytest.raises(Exception, match="the store is away"):
        world.run()
    monkeypatch.setattr(flow, "merge_and_publish", inner)
    world.run()
    assert world.names(who) == {"K": "a"} and world.status() == {"a": {"start", "complete"}}
    assert not world.letters()


def test_a_registry_that_is_not_sound_is_refused(spark, tmp_path):
    twice = spark.createDataFrame([(IMAGE, "m", "a.yaml", None), (IMAGE, "n", "b.yaml", None),
                                   ("other", "m", "c.yaml", "{broken")],
                                  "image string, module string, file string, meta string")
    known = registry(twice, F.col("image"), F.col("module"), F.col("file"), F.col("meta"))
    world = World(spark, tmp_path, registry=lambda: known)
    world.job("a", "who", {})
    world.complete("a")
    with pytest.raises(Exception, match="in a.yaml and b.yaml") as e:
        world.run()
    assert "c.yaml: no meta" in str(e.value)


def test_each_fault_of_a_job_has_its_text(world):
    who = user(world)
    world.job("twice", who, {"t/quality_report.tsv": [line("K")]})
    world.jobs.append(world.jobs[-1])
    world.jobs += [("no_user", None, (IMAGE, "d"), 1, 0, [("complete", TIME)]),
                   ("no_image", who, (None, "d"), 1, 0, [("complete", TIME)]),
                   ("bad_time", who, (IMAGE, "d"), 1, 0, [("complete", "soon")]),
                   ("open", who, (IMAGE, "d"), 1, 0, [("created", TIME)])]
    world.complete("twice", "no_user", "no_image", "bad_time", "open")
    world.run()
    assert {k[0]: v.error_dlq for k, v in world.letters().items()} == {
        "twice": "More than one document of job twice",
        "no_user": "No user in the document of job no_user",
        "no_image": "No image in the document of job no_image",
        "bad_time": "Unreadable completion time of job bad_time: soon",
        "open": "No complete event found for job open"}
    assert world.status() == {}


def test_status_stays_bounded(spark, tmp_path):
    world = World(spark, tmp_path, fold_every=4)
    world.job("n", "who", {}, image="img/none")
    for _ in range(14):
        world.complete("n")
    world.run()
    assert world.status() == {"n": {"start", "no_operation"}}
    changes = list((world.path / "work" / "status_changes").glob("step=*/batch_id=*"))
    assert len(changes) <= 2 * 5 and len(list((world.path / "work" / "status_folds").glob("v=*"))) <= 2
