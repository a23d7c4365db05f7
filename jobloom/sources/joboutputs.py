"""Output files of jobs, read where the tasks run.

Spark's own file scans take the list of paths from the driver. Here paths stay in a table (id, file):
tasks look the files up, which gives sizes and faults, files are cut into ranges of bytes, and tasks
read the lines of their ranges. So the number of Spark jobs does not grow with the files, the driver
sees no path, a large file is read by many tasks, and a file that is not there or has another header
is a row.

Lines are found as Spark's text sources find them (ended by \\n, \\r or \\r\\n; a range owns the lines
that begin in it) and their cells by Spark's own CSV parser. Compressed files, told by their endings,
are one range each. A byte order mark at the start is dropped; bytes that are no UTF-8 are replaced.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.shipping import ship

RANGE_BYTES = 16 << 20
# Looking a file up is waiting for the store.
LOOKUPS, THREADS = 1000, 16
BATCH_BYTES = 4 << 20
MOST_TASKS = 20_000

LOCATED = "id string, file string, size bigint, body bigint, whole boolean, fault string"
# What Java's trim takes for blank.
BLANK = "".join(map(chr, range(33)))
LINE_END = re.compile(rb"\r\n|\r|\n")
COMPRESSED = (".gz", ".bz2", ".zst")
STORES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "hdfs": "hdfs"}


def split_uri(uri: str) -> tuple[str, str]:
    """Scheme and the rest without leading slashes but one, as it stands (nothing is decoded)."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(/.*)", uri)
    if not found:
        return "", uri
    scheme, rest = found[1].lower(), found[2]
    return scheme, rest[2:] if rest.startswith("//") else rest


def opens(spark: SparkSession, root: str) -> bool:
    """Whether tasks can open files below a root by themselves. Names without a scheme mean the
    cluster's default store, which only Spark knows."""
    scheme, _ = split_uri(root)
    local = spark.sparkContext.master.startswith("local")
    return scheme in STORES and (scheme != "" or local) and (scheme != "file" or local)


@lru_cache(maxsize=64)
def _store(kind: str, authority: str) -> fs.FileSystem:
    if kind == "file":
        return fs.LocalFileSystem()
    return fs.FileSystem.from_uri(f"{kind}://{authority}")[0]


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a file and its path there."""
    scheme, rest = split_uri(uri)
    kind = STORES[scheme]
    if kind == "file":
        return _store(kind, ""), rest
    authority, _, path = rest.partition("/")
    return _store(kind, authority), f"{authority}/{path}" if kind == "s3" else f"/{path}"


def _text(line: bytes) -> str:
    return line.decode("utf-8", errors="replace")


def first_line(stream, piece: int = 1 << 16) -> tuple[str | None, int]:
    """The first line that is not blank, and where the next one begins."""
    data, ended, at = b"", False, 0
    while not ended:
        more = stream.read(piece)
        ended = not more
        data += more
        while end := LINE_END.search(data, at):
            if end.end() == len(data) and end[0] == b"\r" and not ended:
                break  # \n may follow
            text = _text(data[at:end.start()].removeprefix(b"\xef\xbb\xbf"))
            at = end.end()
            if text.strip(BLANK):
                return text, at
    text = _text(data[at:].removeprefix(b"\xef\xbb\xbf"))
    return (text if text.strip(BLANK) else None), len(data)


def header_fault(line: str | None, columns: list[str], sep: str) -> str | None:
    """What is wrong with a header; an empty file has none and no rows."""
    if line is None:
        return None
    found = next(csv.reader([line], delimiter=sep))
    if len(found) != len(columns):
        return f"has {len(found)} columns instead of {len(columns)}"
    for n, (name, wanted) in enumerate(zip(found, columns)):
        if name.strip().lower() != wanted.lower():
            return f"names column {n + 1} {name!r} instead of {wanted!r}"
    return None


def _look_up(root: str, columns: list[str], sep: str):
    def one(file: str | None) -> tuple[int, int, bool, str | None]:
        if file is None:
            return -1, 0, False, "A file without a name"
        store, path = place(root + file)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            return -1, 0, False, f"No such file: {file}"
        if info.type != fs.FileType.File:
            return -1, 0, False, f"Not a file: {file}"
        with store.open_input_stream(path) as stream:
            header, body = first_line(stream)
        fault = header_fault(header, columns, sep)
        if fault:
            return info.size, 0, False, f"The header of {file} {fault}"
        whole = path.endswith(COMPRESSED)
        return info.size, 0 if whole else body, whole, None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(THREADS) as pool:
            for batch in batches:
                found = list(pool.map(one, batch.column(1).to_pylist()))
                size, body, whole, fault = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                     pa.array(body, pa.int64()), pa.array(whole, pa.bool_()),
                     pa.array(fault, pa.string())], ["id", "file", "size", "body", "whole", "fault"])
    return work


def locate(files: DataFrame, root: str, columns: list[str], sep: str) -> DataFrame:
    """(id, file) rows with size, where the rows begin, whether the file is one range, and its fault."""
    ship(files.sparkSession)
    tasks = min(max(1, -(-files.count() // LOOKUPS)), MOST_TASKS)
    return files.select("id", "file").repartition(tasks, "file", "id").mapInArrow(
        _look_up(root, columns, sep), LOCATED)


def range_lines(file, low: int, high: int, size: int, piece: int = 1 << 16) -> list[bytes]:
    """The lines that begin at bytes low .. high - 1 of a file."""
    # The byte before tells whether a line begins at `low`.
    at = max(low - 1, 0)
    file.seek(at)
    data = file.read(min(high, size) - at)
    start = 0
    if low:
        end = LINE_END.search(data)
        while end is None or (end[0] == b"\r" and end.end() == len(data)):
            # No line begins here, or whether \n follows is not yet known.
            if end is None and at + len(data) >= min(high, size):
                return []
            more = file.read(1)
            if not more:
                break
            data += more
            end = LINE_END.search(data)
        start = end.end()
    if at + start >= min(high, size):
        return []
    # The last line is read to its end.
    if not data.endswith((b"\n", b"\r")):
        while more := file.read(piece):
            end = LINE_END.search(more)
            if end:
                data += more[:end.start()]
                break
            data += more
    lines = LINE_END.split(data[start:])
    return lines if lines[-1] else lines[:-1]


def whole_lines(stream, piece: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """All lines of a stream, some at a time."""
    rest = b""
    while more := stream.read(piece):
        lines = LINE_END.split(rest + more)
        # A last \r may be half of an end.
        if more.endswith(b"\r"):
            rest = lines[-2] + b"\r"
            lines = lines[:-2]
        else:
            rest = lines.pop()
        yield lines
    if rest:
        yield [rest.removesuffix(b"\r")]


def _read(root: str):
    def batches_of(id_: str | None, lines: list[str]) -> Iterator[pa.RecordBatch]:
        first, held = 0, 0
        for n, line in enumerate(lines):
            held += len(line)
            if held >= BATCH_BYTES or n + 1 == len(lines):
                some = lines[first:n + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id_] * len(some), pa.string()), pa.array(some, pa.string())], ["id", "line"])
                first, held = n + 1, 0

    def lines_of(row: dict) -> Iterator[list[bytes]]:
        store, path = place(root + row["file"])
        if row["whole"]:
            with store.open_input_stream(path) as stream:
                yield from whole_lines(stream)
        else:
            with store.open_input_file(path) as file:
                yield range_lines(file, row["low"], row["high"], row["size"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                header = row["whole"]
                for some in lines_of(row):
                    if header and some:
                        some[0] = some[0].removeprefix(b"\xef\xbb\xbf")
                    texts = [t for t in map(_text, some) if t.strip(BLANK)]
                    if header and texts:
                        texts, header = texts[1:], False
                    yield from batches_of(row["id"], texts)
    return work


def read_rows(located: DataFrame, root: str, columns: list[str], sep: str,
              range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The rows of all files without a fault: `id` and the columns as strings.

    Give `located` as a written table.
    """
    sound = located.filter("fault is null and size > body")
    length = F.col("size") - F.col("body")
    pieces = F.when(F.col("whole"), 0).otherwise(F.floor((length - 1) / range_bytes)).cast("bigint")
    files, ranges = sound.agg(F.count("*"), F.coalesce(F.sum(pieces + 1), F.lit(0))).first()
    # Many small files make one task, each large one several.
    tasks = min(max(1, ranges - files + -(-files // 100)), MOST_TASKS)
    low = F.col("body") + F.col("piece") * range_bytes
    cut = sound.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces))).select(
        "id", "file", "size", "whole", low.alias("low"),
        F.when(F.col("whole"), F.col("size")).otherwise(low + range_bytes).alias("high"))
    lines = cut.repartition(tasks, "file", "low", "id").mapInArrow(_read(root), "id string, line string")
    cells = F.from_csv("line", ", ".join(f"`{c}` string" for c in columns), {"sep": sep})
    return lines.select("id", cells.alias("cells")).select(
        "id", *[F.col("cells")[c].alias(c) for c in columns])
