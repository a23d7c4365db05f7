"""The importer contract."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from jobloom.operators.merge import UPDATE
from jobloom.sources.tables import quoted


def as_is(rows: DataFrame, jobs: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class Importer:
    """Loads output files of jobs into one table per namespace.

    transform gets all file rows of a batch (strings, plus the job's `id`) and the jobs they
    belong to (id, image_digest, counts, completion_time, meta), and returns rows with `id`
    and the columns of `schema`, still as strings or already typed. It works on all jobs and
    namespaces at once.
    """

    name: str
    namespace: str
    table: str
    schema: StructType
    keys: list[str]
    file_columns: list[str]
    accepts: Callable[[Column], Column]
    no_files_error: str
    mode: str = UPDATE
    sep: str = "\t"
    transform: Callable[[DataFrame, DataFrame], DataFrame] = as_is

    def table_name(self, prefix: str) -> str:
        return f"{quoted(prefix + self.namespace)}.{quoted(self.table)}"
