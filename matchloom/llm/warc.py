"""WARC archives: write, normalise and read back.

Pages are first written as monolithic archives: one gzip stream over a whole file. The normaliser inflates such a
stream once, piece by piece, writes every record as a gzip member of its own, and beside the archive an index with each
member's offset and length, so that readers can seek. Records are read back through the index, one member at a time.

Files go below the checkpoint folder, through Arrow's file systems (local paths, hdfs, s3, gs). Their names carry the
task attempt; a manifest table holds those of the attempts that counted, so a lost executor leaves only files that
nobody reads. An archive that reaches ``archive_bytes`` is closed and the next one begun.

Defined results. A null html is an empty payload. A null url is left out of the record. Payloads are equal when their
SHA-1 and length are; the row with the largest id is the response, and so is every row that shares that id; a null id
is smaller than all others, and rows with it are only responses when no copy has an id. Extra columns are not read.
An empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings, partitions
from matchloom.storage import materialize, new_path

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = b"\r\n\r\n"
CHUNK = 1 << 20
MANIFEST = "archive string, records long, bytes long"
Batches = Iterator[pa.RecordBatch]


def resolve(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to; revisits have no payload any more."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    key = ["payload_digest", "payload_bytes"]
    tops = rows.where(F.col("payload_bytes") >= least).groupBy(*key).agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = rows.join(tops, key, "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return rows.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), *key, F.when(revisit, F.col("top")).alias("refers_to"))


def record(row: dict) -> bytes:
    revisit = row["payload"] is None
    body = HTTP + (row["payload"] or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{row['page_id']}>"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in row["url"]))
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {row['payload_bytes']}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{row['refers_to']}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + END + body + END


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns.values()], list(columns))


def _manifest(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    names, records, sizes = zip(*rows) if rows else ([], [], [])
    return _batch({"archive": (list(names), pa.string()), "records": (list(records), pa.int64()), "bytes": (list(sizes), pa.int64())})


def _task_name() -> str:
    from pyspark import TaskContext

    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


def _writer(folder: str, archive_bytes: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, done, out = _task_name(), [], None

        def close() -> None:
            out.write(packer.flush())
            out.close()
            done.append((path, records, size))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, records, size = f"{root}/{name}-{len(done):04d}.warc.gz", 0, 0
                    out, packer = store.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                piece = packer.compress(record(row))
                out.write(piece)
                records, size = records + 1, size + len(piece)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield _manifest(done)

    return run


def write_monolithic(records: DataFrame, archive_bytes: int = 1 << 30) -> DataFrame:
    """The manifest of the archives that the partitions of ``records`` were written to."""
    batch_settings(records.sparkSession)
    folder = new_path(records.sparkSession, "warc")
    return materialize(records.mapInArrow(_writer(folder, archive_bytes), MANIFEST), "manifest")


def inflated(stream) -> Iterator[bytes]:
    """Pieces of what a gzip file holds, of however many members."""
    unpack = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            piece = unpack.decompress(data, CHUNK)
            if piece:
                yield piece
            data = unpack.unconsumed_tail
            if unpack.eof:
                data, unpack = unpack.unused_data, zlib.decompressobj(31)
    if piece := unpack.flush():
        yield piece


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(head, whole record) of each record of a WARC stream; no more than one record is held."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        seen = 0
        while (at := held.find(END, seen)) < 0:
            seen = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                raise ValueError("archive ends inside a record's head")
        head = bytes(held[:at])
        size = at + 4 + int(headers(head)["content-length"]) + 4
        if not fill(size):
            raise ValueError("archive ends inside a record")
        yield head, bytes(held[:size])
        del held[:size]


def _normaliser(folder: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, done = _task_name(), []
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                path, offset, records = f"{root}/{name}-{len(done):04d}.warc.gz", 0, 0
                with store.open_input_stream(archive, compression=None) as source, store.open_output_stream(path, compression=None) as out, store.open_output_stream(f"{path}.index", compression=None) as index:
                    for head, whole in split_records(inflated(source)):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(whole) + packer.flush()
                        out.write(member)
                        named = headers(head)
                        entry = {"offset": offset, "length": len(member), "id": named["warc-record-id"], "type": named["warc-type"], "digest": named.get("warc-payload-digest"), "uri": named.get("warc-target-uri")}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, records = offset + len(member), records + 1
                done.append((path, records, offset))
        yield _manifest(done)

    return run


def normalise(manifest: DataFrame) -> DataFrame:
    """The manifest of the normalised archives; beside each archive lies ``<archive>.index``, one JSON line a record."""
    spark = manifest.sparkSession
    folder = new_path(spark, "members")
    spread = manifest.select("archive").repartition(partitions(spark))
    return materialize(spread.mapInArrow(_normaliser(folder), MANIFEST), "manifest")


def member_at(stream, offset: int, length: int) -> bytes:
    stream.seek(offset)
    return zlib.decompress(stream.read(length), 31)


def parse(whole: bytes) -> dict:
    head, _, rest = whole.partition(END)
    named = headers(head)
    body = rest[: int(named["content-length"])]
    payload = body.partition(END)[2]
    page = lambda urn: None if urn is None or urn[10:-1] == "None" else int(urn[10:-1])
    digest = base64.b32decode(named["warc-payload-digest"].removeprefix("sha1:")).hex()
    if named["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {named['warc-record-id']} doesn't have its digest")
    return {
        "page_id": page(named["warc-record-id"]), "url": named.get("warc-target-uri"), "payload": payload if named["warc-type"] == "response" else None,
        "payload_bytes": int(named["x-payload-length"]), "payload_digest": digest, "record_type": named["warc-type"], "refers_to": page(named.get("warc-refers-to")),
    }


RECORD = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}


def _reader(folder: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        store, _ = fs.FileSystem.from_uri(folder)
        rows: list[dict] = []
        size = 0
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with store.open_input_file(archive) as source, store.open_input_stream(f"{archive}.index", compression=None) as index:
                    for line in _lines(index):
                        entry = json.loads(line)
                        rows.append(parse(member_at(source, entry["offset"], entry["length"])))
                        size += rows[-1]["payload_bytes"]
                        if size >= 8 * CHUNK or len(rows) >= 2000:
                            yield _batch({c: ([r[c] for r in rows], kind) for c, kind in RECORD.items()})
                            rows, size = [], 0
        yield _batch({c: ([r[c] for r in rows], kind) for c, kind in RECORD.items()})

    return run


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while data := stream.read(CHUNK):
        *lines, held = (held + data).split(b"\n")
        yield from lines


def read_records(manifest: DataFrame) -> DataFrame:
    """A row per record of normalised archives, found by their indexes; digests of responses are checked."""
    spark = manifest.sparkSession
    batch_settings(spark)
    spread = manifest.select("archive").repartition(partitions(spark))
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread.mapInArrow(_reader(new_path(spark, "members")), schema)
