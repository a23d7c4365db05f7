"""WARC archives: writing pages as records, one gzip member each, and a sequential reader.

Writing: of records with equal payloads of at least `least` bytes, that with the smallest id is a
response; the others are revisits, which carry the HTTP header and refer to it. Each task writes
archives of about `archive_bytes` to a shared folder and reports them; the manifest, committed by
Spark, names only archives of tasks that ended well, so a lost executor leaves at most a stray
file that nobody reads. The folder is reached through Arrow's file systems (file, s3, hdfs, ...).

Reading: one pass over each archive. The bytes go through an incremental zlib decompressor, whose
end of member is the end of the record; the header gives the length of the block, and block and
payload digests are verified on the way. Memory is that of one record (without payloads, of its
header, of any length, and one piece of 64 KB). Archives are dealt out to the tasks.

Defined cases: a null payload is the empty one; an id of null is written as no id and read back as
null (it is a revisit if an equal payload has an id, else a response); rows that share the
smallest id are all responses; repeated rows give a record each; an empty table gives an archive
folder without archives. Columns other than those named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.session import shared_dir

LEAST = 100
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
ENDS = b"\r\n\r\n"
# In this order on writing, backwards on reading: characters that a header field would lose.
URL_CODES = [("%", "%25"), ("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")]
MANIFEST = "path string, records bigint, bytes bigint"
RECORD = ("path string, at bigint, id bigint, url string, record_type string, refers_to bigint, "
          "payload_bytes bigint, payload_digest string")


def planned_records(pages: DataFrame, least: int = LEAST, *, key: str = "page_id",
                    url: str = "url", payload: str = "html") -> DataFrame:
    """id, url, payload, digest and the id that a revisit refers to, else null."""
    content = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("bigint").alias("id"), F.col(url).alias("url"),
                        content.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (rows.filter(F.octet_length("payload") >= least).groupBy("digest")
             .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
             .select("digest", "first"))
    # Written first, so that Spark can split a frequent payload in the join.
    path = shared_dir(pages.sparkSession, "warc-repeats")
    first.write.parquet(path)
    first = pages.sparkSession.read.schema(first.schema).parquet(path)
    again = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("id", "url", "payload", "digest",
                                                     again.alias("refers_to"))


def _uri(number: int | None) -> str:
    return f"<urn:record:{'none:' + uuid.uuid4().hex if number is None else number}>"


def _number(uri: str | None) -> int | None:
    last = (uri or "").rstrip(">").rpartition(":")[2]
    return int(last) if uri and ":none:" not in uri else None


def record_bytes(number, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = [http] if refers_to is not None else [http, payload]
    seen = hashlib.sha256(http)
    if refers_to is None:
        seen.update(payload)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_uri(number)}", "WARC-Date: 1970-01-01T00:00:00Z",
             "Content-Type: application/http;msgtype=response",
             f"Content-Length: {sum(map(len, block))}",
             f"WARC-Block-Digest: sha256:{seen.hexdigest()}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        for plain, code in URL_CODES:
            url = url.replace(plain, code)
        lines.append(f"WARC-Target-URI: {url}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_uri(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = [packer.compress("\r\n".join(lines).encode() + ENDS)]
    out += [packer.compress(b) for b in block]
    return b"".join([*out, packer.compress(ENDS), packer.flush()])


def write_archives(records: DataFrame, folder: str,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records to archives in `folder`; returns the manifest, read from it."""
    spark = records.sparkSession

    def work(batches):
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        stream, done = None, []
        path, count, size = "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    path, count, size = f"{place}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = files.open_output_stream(path, compression=None)
                member = record_bytes(row["id"], row["url"], row["payload"], row["digest"],
                                      row["refers_to"])
                stream.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    stream.close()
                    stream, done = None, [*done, (path, count, size)]
        if stream is not None:
            stream.close()
            done.append((path, count, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)], ["path", "records", "bytes"])

    manifest = f"{folder}/manifest"
    records.mapInArrow(work, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


class Damaged(ValueError):
    """An archive that breaks the format, or a digest that does not match."""


class _Member:
    """The decompressed bytes of one gzip member after the other."""

    def __init__(self, stream):
        self.stream, self.packed, self.plain, self.at = stream, b"", b"", 0
        self.unpacker = None

    def open(self) -> bool:
        """Go to the next member; false at the end of the archive."""
        if not self.packed:
            self.packed = self.stream.read(PIECE)
        self.unpacker = zlib.decompressobj(31)
        return bool(self.packed)

    def more(self) -> bytes:
        """The next piece, empty at the end of the member."""
        while not self.unpacker.eof:
            if not self.packed:
                self.packed = self.stream.read(PIECE)
                if not self.packed:
                    raise Damaged("the archive ends within a record")
            packed = self.unpacker.unconsumed_tail or self.packed
            try:
                out = self.unpacker.decompress(packed, PIECE)
            except zlib.error as e:
                raise Damaged(f"not a gzip member: {e}") from e
            left = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            self.at += len(packed) - len(left)
            self.packed = left
            if out:
                return out
        return b""


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (x.decode("utf-8", "replace").partition(":") for x in lines)
    return {k.strip().lower(): v.strip(" \t") for k, _, v in pairs}


def _same_digest(said: str | None, seen) -> bool:
    """Compare with "algorithm:value", the value in hex or base 32."""
    if said is None:
        return True
    _, _, value = said.partition(":")
    raw = seen.digest()
    return value.lower() == raw.hex() or value.rstrip("=") == base64.b32encode(raw).decode().rstrip("=")


def _hasher(said: str | None):
    name = (said or "sha256:").partition(":")[0].lower().replace("-", "")
    if name not in hashlib.algorithms_available:
        raise Damaged(f"unknown digest {name}")
    return hashlib.new(name)


def read_records(stream, with_payload: bool = True) -> Iterator[dict]:
    """The records of one archive in order. `stream` has read(n)."""
    member = _Member(stream)
    while member.open():
        began = member.at
        try:
            yield {"at": began} | _record(member, with_payload)
        except Damaged as e:
            raise Damaged(f"at byte {began}: {e}") from e


def _record(member: _Member, with_payload: bool) -> dict:
    read, end = bytearray(), -1
    while end < 0:
        piece = member.more()
        if not piece:
            raise Damaged("no end of the header")
        # The end may begin in the piece before.
        seen = max(len(read) - len(ENDS) + 1, 0)
        read += piece
        end = read.find(ENDS, seen)
    head, rest = bytes(read[:end]), bytes(read[end + len(ENDS):])
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise Damaged("no WARC version")
    fields = _fields(lines)
    try:
        left = int(fields["content-length"])
    except (KeyError, ValueError) as e:
        raise Damaged("no content length") from e
    block = _hasher(fields.get("warc-block-digest"))
    payload = _hasher(fields.get("warc-payload-digest"))
    is_http = fields.get("content-type", "").startswith("application/http")
    http, size, kept, inside = b"", 0, [], not is_http
    http_fields: dict[str, str] = {}
    while left:
        piece = rest or member.more()
        if not piece:
            raise Damaged("the block is shorter than its content length")
        piece, rest = piece[:left], piece[left:]
        left -= len(piece)
        block.update(piece)
        if not inside:
            http += piece
            if ENDS not in http:
                continue
            head, _, piece = http.partition(ENDS)
            http_fields, inside = _fields(head.split(b"\r\n")[1:]), True
        payload.update(piece)
        size += len(piece)
        if with_payload:
            kept.append(piece)
    tail = rest
    while piece := member.more():
        tail += piece
        if len(tail) > len(ENDS):
            break
    if tail != ENDS:
        raise Damaged("the block is longer than its content length")
    kind = fields.get("warc-type")
    if not _same_digest(fields.get("warc-block-digest"), block):
        raise Damaged("the block digest differs")
    if kind != "revisit" and not _same_digest(fields.get("warc-payload-digest"), payload):
        raise Damaged("the payload digest differs")
    if kind == "revisit":
        size = int(http_fields.get("content-length", 0))
    return {"record_type": kind, "record_id": fields.get("warc-record-id"),
            "url": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
            "payload_bytes": size, "payload": b"".join(kept) if with_payload else None,
            "payload_digest": fields.get("warc-payload-digest")}


def _unescaped(url: str | None) -> str | None:
    for plain, code in reversed(URL_CODES):
        url = url and url.replace(code, plain)
    return url


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str,
                  with_payload: bool = True) -> DataFrame:
    """The records of all archives that the manifest names."""
    schema = RECORD + (", payload binary" if with_payload else "")
    names = schema.replace(" bigint", "").replace(" string", "").replace(" binary", "").split(", ")
    to_arrow = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [to_arrow[x.split(" ")[1]] for x in schema.split(", ")]

    def work(batches):
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(path, compression=None, buffer_size=PIECE) as stream:
                    for r in read_records(stream, with_payload):
                        r |= {"path": path, "id": _number(r["record_id"]),
                              "url": _unescaped(r["url"]), "refers_to": _number(r["refers_to"]),
                              "payload_digest": (r["payload_digest"] or "").partition(":")[2]}
                        rows.append(r)
                        size += r["payload_bytes"] if with_payload else 0
                        if len(rows) >= 1000 or size >= PIECE * 64:
                            yield _batch(rows, names, kinds)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    tasks = max(1, min(manifest.count(), 20_000))
    paths = manifest.select("path").repartition(tasks, "path")
    return paths.mapInArrow(work, schema)


def _batch(rows: list[dict], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)


def round_trip(pages: DataFrame, least: int = LEAST, with_payload: bool = False,
               **columns: str) -> DataFrame:
    """Archive all pages in a new shared folder and read the archives back."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    manifest = write_archives(planned_records(pages, least, **columns), folder)
    return read_archives(spark, manifest, folder, with_payload)
