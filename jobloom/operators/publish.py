"""Publishing merged tables.

A table without a row-level format is kept as versions, one folder each, and a view that names the
newest. What a version is built on, which batch wrote it and whether it is whole stands in a state
file of its own, so nothing depends on the markers of a committer, and versions are numbered on
from the newest whatever the numbers of batches.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from jobloom.operators.merge import UPDATE, merge
from jobloom.sources.tables import empty_table

# Table formats that take row-level changes in place.
ROW_LEVEL = {"delta", "iceberg", "hudi"}

# Version of a table that was there before the first batch.
BASE = -1


def staged(df: DataFrame, path: str) -> DataFrame:
    """The frame written down and read back: computed once, of known size, and safe from
    lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def provider(spark: SparkSession, name: str) -> str | None:
    """Format of a catalog table, NULL for a view or an unknown name."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").head(1)
    return rows[0].data_type.lower() if rows else None


def merge_in_place(spark: SparkSession, name: str, source: DataFrame, keys: list[str],
                   mode: str = UPDATE) -> None:
    """Merge into a table whose format supports it."""
    match = [F.expr(f"{name}.`{k}` = source.`{k}`") for k in keys]
    on = match[0]
    for m in match[1:]:
        on = on & m
    writer = source.alias("source").mergeInto(name, on)
    if mode == UPDATE:
        writer = writer.whenMatched().updateAll()
    writer.whenNotMatched().insertAll().merge()


def _version_path(location: str, version: int) -> str:
    return f"{location.rstrip('/')}/v={version}"


def _state_path(location: str, version: int) -> str:
    return f"{location.rstrip('/')}/state/{version}.json"


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def put_json(spark: SparkSession, path: str, value: dict) -> None:
    """A small file, written aside and then moved, so that it is there whole or not at all."""
    fs, place = _place(spark, path)
    _, aside = _place(spark, f"{path}.new")
    stream = fs.create(aside, True)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(aside, place):
        raise OSError(f"could not write {path}")


def get_json(spark: SparkSession, path: str) -> dict | None:
    fs, place = _place(spark, path)
    if not fs.exists(place):
        # A writer may have been lost between deleting the old file and moving the new one.
        fs, place = _place(spark, f"{path}.new")
        if not fs.exists(place):
            return None
    stream = fs.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def numbered(spark: SparkSession, location: str, prefix: str) -> list[int]:
    """Numbers of the subfolders `prefix`<number>, in order."""
    fs, place = _place(spark, location)
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def versions(spark: SparkSession, location: str) -> dict[int, dict]:
    """The states of all versions by number. A version without a state raises: it may hold rows
    that the next version would lose."""
    out = {}
    for number in numbered(spark, location, "v="):
        state = get_json(spark, _state_path(location, number))
        if state is None:
            raise ValueError(f"{_version_path(location, number)} has no state; restore its file "
                             f"{_state_path(location, number)} or move the folder away")
        out[number] = state
    return out


def complete_versions(spark: SparkSession, location: str) -> list[int]:
    """Numbers of the versions that were written to the end, in order."""
    return [n for n, s in versions(spark, location).items() if s["done"]]


def remove_versions(spark: SparkSession, location: str, prefix: str, before: int) -> None:
    """Delete the folders `prefix`<number> with smaller numbers."""
    for number in numbered(spark, location, prefix):
        if number < before:
            remove(spark, f"{location.rstrip('/')}/{prefix}{number}")


def read_version(spark: SparkSession, location: str, version: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(_version_path(location, version))


def write_version(df: DataFrame, location: str, version: int, base: int | None = None,
                  writer: int | None = None) -> None:
    """Write a version; it counts once its state says that it is done."""
    spark = df.sparkSession
    state = {"version": version, "base": base, "writer": writer}
    put_json(spark, _state_path(location, version), state | {"done": False})
    df.write.mode("overwrite").parquet(_version_path(location, version))
    put_json(spark, _state_path(location, version), state | {"done": True})


def point_view(spark: SparkSession, name: str, location: str, version: int, columns: list[str]) -> None:
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} "
              f"FROM parquet.`{_version_path(location, version)}`")


def publish_version(df: DataFrame, name: str, location: str, version: int,
                    base: int | None = None, writer: int | None = None) -> None:
    """Write a table version and point the view `name` at it."""
    write_version(df, location, version, base, writer)
    point_view(df.sparkSession, name, location, version, df.columns)


def expire_versions(spark: SparkSession, location: str, keep: int) -> None:
    """Delete all but the last `keep` whole versions (the newest always stays) and what was begun
    before the newest and never finished."""
    states = versions(spark, location)
    done = [n for n, s in states.items() if s["done"]]
    kept = set(done[-max(keep, 1):])
    for number in states:
        if number not in kept and number < done[-1]:
            remove(spark, _version_path(location, number))
            remove(spark, _state_path(location, number))


def merge_and_publish(spark: SparkSession, name: str, location: str, schema: StructType,
                      keys: list[str], steps: list[tuple[DataFrame, str]],
                      batch: int, keep: int = 3) -> None:
    """Merge the sources of a batch, each with its mode, into a table.

    Row-level formats merge in place. Otherwise the batch becomes a new version, built on the
    newest one. A batch that is replayed finds its version and leaves it, so that rows with NULL
    keys come once and what later batches wrote stays. The last `keep` versions stay, at least two.
    """
    format_ = provider(spark, name)
    if format_ in ROW_LEVEL:
        for source, mode in steps:
            merge_in_place(spark, name, source, keys, mode)
        return
    if format_ is not None:
        raise ValueError(f"{name} is a plain {format_} table; publish its rows as version BASE first")
    states = versions(spark, location)
    done = [n for n, s in states.items() if s["done"]]
    if any(states[n]["writer"] == batch for n in done):
        point_view(spark, name, location, done[-1], schema.names)
        return
    base = done[-1] if done else None
    table = empty_table(spark, schema) if base is None else read_version(
        spark, location, base, schema)
    for source, mode in steps:
        table = merge(table, source, keys, mode)
    publish_version(table, name, location, max(states, default=BASE) + 1, base, batch)
    expire_versions(spark, location, max(keep, 2))
