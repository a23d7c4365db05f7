"""The ingest stream: one micro-batch of events at a time, safe to replay."""

from __future__ import annotations

import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobloom.importers import employees
from jobloom.importers.base import Importer
from jobloom.operators import dlq, jobs as j, route as r, status as st
from jobloom.operators.decode import decode
from jobloom.operators.publish import (
    expire_versions, get_json, merge_and_publish, numbered, put_json, read_version, remove,
    remove_versions, staged, versions, write_version,
)
from jobloom.operators.sharedtable import SharedTable, claim, for_each, point_namespace
from jobloom.plans import importing as imp
from jobloom.schemas import EMPLOYEES, FAILURE, FOLDED, RECORD, STATUS_CHANGE
from jobloom.sources.events import Topic, stream_events
from jobloom.sources.registry import require_sound
from jobloom.sources.tables import create_namespace, create_table, empty_table, quoted
from jobloom.streaming.faults import is_outage

Table = Callable[[], DataFrame]

STATUS_ORDER = ["since", "seq"]
REJECTED = [r.MALFORMED, r.MISSING_KEYS, r.NO_JOB, r.BAD_JOB]


@dataclass(frozen=True)
class Ingest:
    """Tables and folders of an ingest.

    headers: one row per job, without outputs; outputs: (id, file); both are read anew for
    each batch. `work` holds what a batch stages, `tables` the published tables. With
    `images`, the query takes only events of these images; with `not_images`, all but these.
    `parallel_merges` namespaces are merged at a time. With a `shared_namespace` there is one table
    for all namespaces, which is merged at once and of which a batch rewrites only the key buckets
    that it touches; each namespace is then a view on it. Of a table kept as versions, the last
    `keep_versions` stay, for queries that still read them. With a row-level `provider` (delta,
    iceberg) tables are created in that format and merged in place. Every `fold_every` batches
    the status changes are folded.

    Batches are numbered on across checkpoints: a number belongs to a query's id and its batch
    id, so a new checkpoint overwrites nothing and a replay finds its own number.
    Give heavy images a query (and folders) of their own so that others need not wait.
    """

    headers: Table
    outputs: Table
    registry: Table
    importers: list[Importer]
    work: str
    tables: str
    files_root: str = ""
    images: list[str] | None = None
    not_images: list[str] = field(default_factory=list)
    parallel_merges: int = 8
    shared_namespace: str | None = None
    buckets: int = 16
    keep_versions: int = 3
    provider: str | None = None
    fold_every: int = 20
    control_namespace: str = "live_integration_test"
    dlq_servers: str | None = None
    dlq_topic: str | None = None

    def __post_init__(self):
        if self.shared_namespace and self.provider:
            raise ValueError("a shared table is kept as versions; it takes no provider")

    @property
    def dlq(self) -> str:
        return f"{self.work}/dead_letters"

    @property
    def status(self) -> str:
        return f"{self.work}/status_changes"

    @property
    def audit(self) -> str:
        return f"{self.work}/control_failures"

    @property
    def folds(self) -> str:
        return f"{self.work}/status_folds"

    def _run_file(self, run: str) -> str:
        return f"{self.work}/batches/{run}.json"

    def _last_numbers(self, spark: SparkSession) -> dict[str, dict]:
        """The last batch of each run (checkpoint) with its number."""
        runs = spark._jvm.org.apache.hadoop.fs.Path(f"{self.work}/batches")
        fs = runs.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(runs):
            return {}
        names = {s.getPath().getName().removesuffix(".new") for s in fs.listStatus(runs)}
        return {n.removesuffix(".json"): get_json(spark, f"{self.work}/batches/{n}")
                for n in names if n.endswith(".json")}

    def number(self, spark: SparkSession, run: str, batch_id: int) -> int:
        """The number of a batch of a run, the same when it is replayed."""
        last = self._last_numbers(spark)
        if run in last and last[run]["batch"] == batch_id:
            return last[run]["number"]
        number = max((x["number"] for x in last.values()), default=-1) + 1
        put_json(spark, self._run_file(run), {"batch": batch_id, "number": number})
        return number

    def _stage(self, batch_id: int, what: str) -> str:
        return f"{self.work}/stage/batch={batch_id}/{what}"

    def _mine(self, enriched: DataFrame) -> DataFrame:
        """This query's share; events without a usable job belong to the general query."""
        if self.images is not None:
            return enriched.filter(F.col("image").isin(self.images))
        if self.not_images:
            return enriched.filter(
                ~F.coalesce(F.col("image").isin(self.not_images), F.lit(False))
            )
        return enriched

    def stage_events(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Route a batch to the end and write it down, so that later steps agree on it even
        if the job table changes meanwhile. Discarded events are not kept."""
        routed = r.route(decode(batch)).select(*RECORD.names, "job_id", "route").persist()
        try:
            events = routed.filter(F.col("route") == r.IMPORTABLE)
            ids = staged(
                events.filter("job_id is not null").select("job_id").distinct(),
                self._stage(batch_id, "ids"),
            )
            headers = j.asked_for(self.headers(), ids)
            known = staged(self.registry(), self._stage(batch_id, "registry"))
            require_sound(known)
            full = j.dispatch(j.enrich(events, headers), known)
            full = self._mine(full.withColumn("route", r.job_route()))
            if self.images is None:
                rest = routed.filter(~F.col("route").isin(r.IMPORTABLE, r.DISCARD))
                full = full.unionByName(rest, allowMissingColumns=True)
            return staged(full, self._stage(batch_id, "events"))
        finally:
            routed.unpersist()

    def _stage_import(self, importer: Importer, events: DataFrame, batch_id: int,
                      attempt: str) -> tuple[DataFrame, DataFrame]:
        """Plan one importer's work and write down its rows and failures."""
        spark = events.sparkSession
        path = self._stage(batch_id, f"{importer.name}/{attempt}")
        jobs = staged(imp.winning_jobs(events, importer.mode), f"{path}/jobs")
        files = staged(imp.owned_files(importer, jobs, self.outputs()), f"{path}/files")
        typed, missing = imp.stage_typed(spark, importer, jobs, files, self.files_root, path)
        failed = staged(
            imp.failed_jobs(importer, jobs, files, typed, missing), f"{path}/failures")
        rows = imp.rows_to_merge(importer, jobs, typed, failed)
        # Few files for a small namespace, several for a large one.
        (rows.hint("rebalance", imp.PREFIX).write.mode("overwrite").partitionBy(imp.PREFIX)
         .option("partitionOverwriteMode", "static").parquet(f"{path}/merge"))
        return spark.read.schema(rows.schema).parquet(f"{path}/merge"), failed

    def _culprits(self, importer: Importer, events: DataFrame, batch_id: int,
                  parts: int = 1, part: int = 0) -> list[tuple[str, str, str]]:
        """Jobs that make an import raise, found by halving, with error and trace."""
        mine = events.filter(F.pmod(F.xxhash64("job_id"), F.lit(parts)) == part)
        try:
            if mine.isEmpty():
                return []
            self._stage_import(importer, mine, batch_id, f"probe-{parts}-{part}")
            return []
        except Exception as e:
            if is_outage(e):
                raise
            ids = mine.select("job_id").distinct().head(2)
            if len(ids) == 1:
                return [(ids[0].job_id, str(e), traceback.format_exc())]
            return (self._culprits(importer, events, batch_id, parts * 2, part)
                    + self._culprits(importer, events, batch_id, parts * 2, part + parts))

    def run_importer(self, importer: Importer, events: DataFrame, batch_id: int,
                     writer: str) -> DataFrame:
        """Import the jobs of one importer for all namespaces; returns (id, error, trace).

        What goes wrong with the data of a job or a namespace fails its jobs. An outage fails the
        batch, which is then replayed.
        """
        spark = events.sparkSession
        try:
            rows, failed = self._stage_import(importer, events, batch_id, "all")
            raised = empty_table(spark, FAILURE)
        except Exception as e:
            if is_outage(e):
                raise
            raised = spark.createDataFrame(self._culprits(importer, events, batch_id), FAILURE)
            sound = events.join(raised.select(F.col("id").alias("job_id")), "job_id", "left_anti")
            rows, failed = self._stage_import(importer, sound, batch_id, "sound")
        merge = self._merge_shared if self.shared_namespace else self._merge_each
        broken = merge(importer, rows, batch_id, writer)
        trace = F.concat(F.lit("ImportError: "), F.col("error"))
        out = failed.select("id", "error", trace.alias("trace")).unionByName(raised)
        if not broken:
            return out
        unmerged = spark.createDataFrame(broken, f"{imp.PREFIX} string, error string, trace string")
        jobs = events.select(F.col("job_id").alias("id"), imp.PREFIX).distinct()
        lost = jobs.join(F.broadcast(unmerged), imp.PREFIX).join(out.select("id"), "id", "left_anti")
        return out.unionByName(lost.select("id", "error", "trace"))

    def _merge_each(self, importer: Importer, rows: DataFrame, batch_id: int,
                    writer: str) -> list[tuple[str, str, str]]:
        """Merge into one table per namespace; returns (namespace, error, trace) of those that fail."""
        spark = rows.sparkSession
        prefixes = [row[0] for row in rows.select(imp.PREFIX).distinct().collect()]

        def merge_one(prefix: str) -> tuple[str, str, str] | None:
            try:
                create_namespace(spark, prefix + importer.namespace, self._place(prefix, importer))
                name = importer.table_name(prefix)
                if self.provider:
                    create_table(spark, name, importer.schema, self.provider)
                source = rows.filter(F.col(imp.PREFIX) == prefix).drop(imp.PREFIX)
                merge_and_publish(
                    spark, name, f"{self._place(prefix, importer)}/{importer.table}",
                    importer.schema, importer.keys, [(source, importer.mode)], writer,
                    self.keep_versions,
                )
            except Exception as e:
                if is_outage(e):
                    raise
                return prefix, str(e), traceback.format_exc()
            return None

        with ThreadPoolExecutor(self.parallel_merges) as pool:
            done = pool.map(inheritable_thread_target(spark)(merge_one), prefixes)
            return [x for x in done if x]

    def _merge_shared(self, importer: Importer, rows: DataFrame, batch_id: int,
                      writer: str) -> list[tuple[str, str, str]]:
        """Merge into the table of all namespaces; returns (namespace, error, trace) of those that
        cannot be set up."""
        spark = rows.sparkSession
        if rows.isEmpty():
            return []
        place, stage = f"{self.tables}/{self.shared_namespace}", self._stage(batch_id, f"{importer.name}/shared")
        create_namespace(spark, self.shared_namespace, place)
        table = SharedTable(spark, f"{place}/{importer.table}", importer.schema, importer.keys, imp.PREFIX,
                            self.buckets)
        # Also if the batch runs again, the namespaces that it brings are set up.
        known = table.current_pieces(table.newest(but=writer)).select(imp.PREFIX)
        new = staged(rows.select(imp.PREFIX).distinct().join(known, imp.PREFIX, "left_anti"), f"{stage}/new")

        def set_up(prefix: str) -> None:
            claim(spark, prefix + importer.namespace, self._place(prefix, importer), importer.table_name(prefix))

        def point(prefix: str) -> None:
            point_namespace(spark, importer.table_name(prefix), shared, imp.PREFIX, prefix,
                            importer.schema.names)

        broken = for_each(spark, new, set_up, is_outage, self.parallel_merges)
        if broken:
            without = spark.createDataFrame([x[:1] for x in broken], f"{imp.PREFIX} string")
            rows, new = (df.join(without, imp.PREFIX, "left_anti") for df in (rows, new))
            if rows.isEmpty():
                return broken
        number = table.merge([(rows, importer.mode)], writer, stage, max(self.keep_versions, 2))
        shared = f"{quoted(self.shared_namespace)}.{quoted(importer.table)}"
        table.point_view(shared, number)
        return broken + for_each(spark, new, point, is_outage, self.parallel_merges)

    def _place(self, prefix: str, importer: Importer) -> str:
        return f"{self.tables}/{prefix}{importer.namespace}"

    def run_control(self, events: DataFrame, batch_id: int, writer: str) -> None:
        """Apply control events; their failures only go to the audit table, also that of their
        merge, which is reported for all of them."""
        spark = events.sparkSession
        rows = staged(employees.parsed_rows(decode(events)), self._stage(batch_id, "control"))
        failed = staged(employees.failures(rows), self._stage(batch_id, "control_failed"))
        steps = [
            (staged(source, self._stage(batch_id, f"control_{mode}")), mode)
            for source, mode in employees.merge_steps(rows, failed)
        ]
        place = f"{self.tables}/{self.control_namespace}"
        name = f"`{self.control_namespace}`.`employees`"
        try:
            create_namespace(spark, self.control_namespace, place)
            if self.provider:
                create_table(spark, name, EMPLOYEES, self.provider)
            merge_and_publish(spark, name, f"{place}/employees", EMPLOYEES, employees.KEYS, steps,
                              writer, self.keep_versions)
        except Exception as e:
            if is_outage(e):
                raise
            rest = rows.select(*employees.EVENT).distinct().join(failed, employees.EVENT, "left_anti")
            failed = failed.unionByName(rest.withColumn("error", F.lit(str(e))))
        dlq.write_batch(failed, self.audit, batch_id)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Everything one micro-batch does. Each sink replaces what an earlier attempt at the
        same batch wrote. What earlier batches staged is no longer needed."""
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "no-query"
        writer = f"{run}/{batch_id}"
        batch_id = self.number(spark, run, batch_id)
        remove_versions(spark, f"{self.work}/stage", "batch=", batch_id)
        began = F.current_timestamp()
        events = self.stage_events(batch, batch_id)
        importable = events.filter(F.col("route") == r.IMPORT)
        starts = events.filter(F.col("route").isin(r.IMPORT, r.NO_OPERATION))
        start_rows = _changes(starts, F.lit(st.START), batch_id, 0, began)
        dlq.write_batch(start_rows, f"{self.status}/step=start", batch_id)

        failed = empty_table(spark, FAILURE)
        known = {i.name: i for i in self.importers}
        for row in importable.select("module").distinct().collect():
            mine = importable.filter(F.col("module") == row.module)
            if row.module in known:
                failed = failed.unionByName(
                    self.run_importer(known[row.module], mine, batch_id, writer))
            else:
                text = F.lit(f"No importer is named {row.module}")
                failed = failed.unionByName(mine.select(
                    F.col("job_id").alias("id"), text.alias("error"), text.alias("trace")
                ).distinct())
        failed = staged(failed, self._stage(batch_id, "failed"))

        control = events.filter(F.col("route") == r.CONTROL)
        if not control.isEmpty():
            self.run_control(control, batch_id, writer)

        outcome = (
            events.filter(F.col("route") != r.CONTROL)
            .join(failed.withColumnRenamed("id", "job_id"), "job_id", "left")
            .withColumn("route", F.when(F.col("error").isNotNull(), r.IMPORT_ERROR)
                        .otherwise(F.col("route")))
            .withColumn("error", F.coalesce("error", F.when(F.col("route") == r.BAD_JOB,
                                                            F.col("job_fault"))))
        )
        rejected = outcome.filter(F.col("route").isin(*REJECTED, r.IMPORT_ERROR))
        letters = dlq.dead_letters(
            decode(rejected.select(*RECORD.names, "route", "error", "trace")), batch_id
        )
        dlq.write_batch(letters, self.dlq, batch_id)
        if self.dlq_servers:
            written = dlq.read_dead_letters(spark, f"{self.dlq}/batch_id={batch_id}")
            dlq.publish_dead_letters(written, self.dlq_servers, self.dlq_topic)
        key = (
            F.when(F.col("route") == r.IMPORT, st.COMPLETE)
            .when(F.col("route") == r.NO_OPERATION, st.NO_OPERATION)
            .when(F.col("route") == r.IMPORT_ERROR, st.ERROR)
        )
        final = _changes(outcome.filter(key.isNotNull()), key, batch_id, 1,
                         F.current_timestamp())
        dlq.write_batch(final, f"{self.status}/step=final", batch_id)
        if batch_id % self.fold_every == self.fold_every - 1:
            # The last batch of each run may be replayed, so it stays as it is.
            last = self._last_numbers(spark).values()
            self.fold_status(spark, batch_id, sorted({x["number"] for x in last}))

    def _newest_fold(self, spark: SparkSession) -> tuple[int, dict] | None:
        done = [(n, x) for n, x in versions(spark, self.folds).items() if x["done"]]
        return done[-1] if done else None

    def status_changes(self, spark: SparkSession) -> DataFrame:
        """The changes of job statuses: the newest fold and what is not in it."""
        changes = spark.read.schema(STATUS_CHANGE).parquet(self.status).select(*FOLDED.names, "batch_id")
        if (fold := self._newest_fold(spark)) is None:
            return changes
        number, state = fold
        later = (F.col("batch_id") > state["writer"]["upto"]) | F.col("batch_id").isin(
            state["writer"]["open"])
        folded = read_version(spark, self.folds, number, FOLDED)
        return changes.filter(later).unionByName(folded, allowMissingColumns=True)

    def job_status(self, spark: SparkSession) -> DataFrame:
        """The current status of all jobs as rows (job_id, key, value)."""
        folded = st.current_status(self.status_changes(spark), STATUS_ORDER)
        return folded.select("job_id", "key", "value")

    def fold_status(self, spark: SparkSession, batch_id: int, open_: list[int] | None = None) -> None:
        """Fold the changes of all batches up to a finished one into one set and delete them, but
        those of the numbers in `open_`, so that neither the folder nor reading the status grows
        with the number of batches."""
        open_ = open_ or []
        kept = (F.col("batch_id") > batch_id) | F.col("batch_id").isin(open_)
        changes = self.status_changes(spark).filter(~F.coalesce(kept, F.lit(False)))
        folded = st.current_status(changes, STATUS_ORDER).select(*FOLDED.names)
        number = max(versions(spark, self.folds), default=-1) + 1
        write_version(folded, self.folds, number, None, {"upto": batch_id, "open": open_})
        expire_versions(spark, self.folds, 2)
        for step in ("start", "final"):
            for old in numbered(spark, f"{self.status}/step={step}", "batch_id="):
                if old <= batch_id and old not in open_:
                    remove(spark, f"{self.status}/step={step}/batch_id={old}")

    def start(self, spark: SparkSession, topic: Topic, checkpoint: str,
              every: str | None = "1 second") -> StreamingQuery:
        """Start the query; with `every` None it ends once it has caught up."""
        writer = (
            stream_events(spark, topic).writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
        )
        if every is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=every).start()


def _changes(events: DataFrame, key: Column, batch_id: int, seq: int, at: Column) -> DataFrame:
    """One status change per job."""
    return events.select(
        "job_id", key.alias("key"), st.iso_utc(at).alias("value"),
        F.lit(batch_id).cast("bigint").alias("since"), F.lit(seq).cast("bigint").alias("seq"),
    ).distinct()
