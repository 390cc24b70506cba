"""WARC archives: writing, the monolithic gzip normaliser, and indexed reading (operator 1).

* ``write_monolithic`` writes one record per row into WARC files whose whole
  content is a single gzip stream, with Spark's own text writer, so it works on
  any file system that Spark can write to.
* ``normalise`` inflates each such stream once, front to back and in pieces, and
  rewrites every record as a gzip member of its own; the offsets of the members
  go into a sidecar index (a table ``archive, offset, length, ...``).
* ``read_records`` seeks to the members that an index names and inflates those
  alone; the members of one archive can be dealt out to many tasks.

Equal payloads are stored once: among records whose payload has at least
``least_bytes`` bytes, that with the largest id is the response and the others
are revisit records that name it.

Archives are binary files, which Spark cannot write, so tasks write them under a
name of their own attempt in the shared folder and the index names only files
that were closed: a lost or repeated task leaves a stray file that no index row
refers to.  The folder is reached through ``pyarrow.fs`` (local paths, HDFS,
object stores).

Defined results: a null payload is an empty one; a null id is stored as an empty
target and can't be referred to (an equal payload then takes the largest
non-null id; if all are null every record is a response); rows that repeat the
largest id are all responses, other repeats all revisits.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avionyx.session import materialize, scratch_path

PIECE = 1 << 20
RECORDS_PER_FILE = 50_000
LEVEL = 6
END = "\r\n\r\n"

INDEX = (
    "archive string, offset long, length long, page_id long, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def mark_revisits(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, sha1, payload_bytes, refers_to`` (null for responses)."""
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload"),
    ).withColumns({"sha1": F.sha1(F.col("payload").cast("binary")), "payload_bytes": F.octet_length("payload").cast("long")})
    # the larger ids of equal payloads, from narrow rows that are summed before the shuffle
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
    shared = materialize(first.where("n > 1 and newest is not null").select("sha1", "newest"), "shared-payloads")
    joined = rows.join(shared, "sha1", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("newest"))
    return joined.select(
        "page_id", "url", "payload", "sha1", "payload_bytes",
        F.when(F.col("newest").isNotNull() & other, F.col("newest")).alias("refers_to"),
    )


def _clean(value: str | None) -> str:
    """A header value: percent-encode what would end the line."""
    return "" if value is None else value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def render(page_id: int | None, url: str | None, payload: str, sha1: str, refers_to: int | None) -> str:
    """One WARC record without the two empty lines that end it."""
    body = "" if refers_to is not None else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
    ]
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(body.encode())}")
    return "\r\n".join(head) + "\r\n\r\n" + body


def write_monolithic(marked: DataFrame, path: str) -> str:
    """Write the marked rows as WARC text, every file one gzip stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                out.append(render(*row))
                held += len(out[-1])
                if held > 8 * PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    records = marked.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, "value string")
    writer = records.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.mode("overwrite").text(path)
    return path


def inflated(stream, piece: int = PIECE) -> Iterator[bytes]:
    """The inflated bytes of a gzip stream (one or more members), in pieces of bounded size."""
    z = zlib.decompressobj(31)
    data = stream.read(piece)
    while data:
        out = z.decompress(data, 4 * piece)
        if out:
            yield out
        data = z.unconsumed_tail or (z.unused_data if z.eof else b"")
        if z.eof:
            z = zlib.decompressobj(31)
        if not data:
            data = stream.read(piece)


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """``(headers, head bytes, body)`` of each record of an inflated stream."""
    held = bytearray()
    pieces = iter(pieces)

    def more() -> bool:
        part = next(pieces, None)
        if part is None:
            return False
        held.extend(part)
        return True

    while True:
        looked = 0
        while (at := held.find(b"\r\n\r\n", max(0, looked - 3))) < 0:
            looked = len(held)
            if not more():
                if held.strip():
                    raise ValueError("the archive ends inside a header")
                return
        head = bytes(held[:at])
        fields = parse_head(head)
        size = int(fields["content-length"])
        stop = at + 4 + size
        while len(held) < stop + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        if held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        body = bytes(held[at + 4 : stop])
        del held[: stop + 4]
        yield fields, head, body


def member(head: bytes, body: bytes) -> bytes:
    """One record as a gzip member of its own."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(head + b"\r\n\r\n") + z.compress(body) + z.compress(b"\r\n\r\n") + z.flush()


def _number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _index_row(archive: str, offset: int, length: int, fields: dict[str, str], body: bytes) -> tuple:
    kind = fields["warc-type"]
    stored = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest(body) != stored:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return (
        archive, offset, length, _number(fields["warc-record-id"]), kind,
        _number(fields.get("warc-refers-to")), stored, len(body) if kind == "response" else None,
    )


_INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(_INDEX_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _INDEX_TYPES, strict=True)], names=_INDEX_NAMES)


def archive_list(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of the gzip files of a folder, one row and one task each (no content is read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path")
    n = max(1, files.count())
    return files.repartitionByRange(n, "path")


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every gzip file of ``source`` under ``target`` with one member per record.

    Returns the sidecar index, which is also written to ``target`` as Parquet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                read_fs, read_path = filesystem(name)
                write_fs, folder = filesystem(target)
                write_fs.create_dir(folder, recursive=True)
                file = f"{os.path.basename(read_path).split('.')[0]}-{uuid.uuid4().hex}.warc.gz"
                rows: list[tuple] = []
                closed: list[tuple] = []
                offset = 0
                with read_fs.open_input_stream(read_path, compression=None) as raw, write_fs.open_output_stream(f"{folder}/{file}", compression=None) as out:
                    for fields, head, body in records(inflated(raw)):
                        packed = member(head, body)
                        out.write(packed)
                        rows.append(_index_row(f"{target}/{file}", offset, len(packed), fields, body))
                        offset += len(packed)
                closed, rows = rows, []  # only a closed file is named
                for i in range(0, len(closed), 10_000):
                    yield _index_batch(closed[i : i + 10_000])

    index = archive_list(spark, source).mapInArrow(run, INDEX)
    index.write.mode("overwrite").parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


def read_records(index: DataFrame, payloads: bool = False) -> DataFrame:
    """The records that an index names, read by seeking to their members.

    Every payload is checked against its digest.  ``payloads`` adds the column
    ``payload`` (null for revisits).
    """
    kinds = INDEX + (", payload string" if payloads else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, object] | None = None
        for batch in batches:
            rows, bodies, held = [], [], 0
            for name, offset, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if opened is None or opened[0] != name:
                    if opened is not None:
                        opened[1].close()
                    where, path = filesystem(name)
                    opened = (name, where.open_input_file(path))
                data = opened[1].read_at(length, offset)
                ((fields, _, body),) = records(iter([zlib.decompress(data, 31)]))
                rows.append(_index_row(name, offset, length, fields, body))
                bodies.append(body.decode() if payloads and fields["warc-type"] == "response" else None)
                held += len(body) if payloads else 0
                if held > 8 * PIECE:
                    yield _with_payloads(_index_batch(rows), bodies, payloads)
                    rows, bodies, held = [], [], 0
            yield _with_payloads(_index_batch(rows), bodies, payloads)
        if opened is not None:
            with suppress(OSError):
                opened[1].close()

    return index.select("archive", "offset", "length").mapInArrow(run, kinds)


def _with_payloads(batch: pa.RecordBatch, bodies: list[str | None], payloads: bool) -> pa.RecordBatch:
    if not payloads:
        return batch
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.string())], names=[*batch.schema.names, "payload"])


def round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as monolithic WARC, normalise, and read the records back.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; the
    payload size of a revisit is that of the response it refers to.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_monolithic(mark_revisits(pages, least_bytes), f"{folder}/monolithic")
    index = normalise(spark, f"{folder}/monolithic", f"{folder}/records")
    found = materialize(read_records(index), "records")
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes")
    asked = revisits.select(F.col("refers_to").alias("target")).distinct()
    sizes = (
        found.where("record_type = 'response'")
        .join(asked, F.col("page_id") == F.col("target"), "left_semi")
        .groupBy(F.col("page_id").alias("target"), F.col("payload_digest").alias("same"))
        .agg(F.max("payload_bytes").alias("payload_bytes"))
    )
    sized = revisits.join(sizes, (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("same")), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.where("record_type = 'response'").select(*columns).unionByName(sized.select(*columns))
