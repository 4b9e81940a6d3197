"""WARC archives as a chunked record table.

A record is rows of (archive, record, chunk, place in the archive) with at most ``chunk_bytes`` of
payload each, so no row of the table and no step of writing or reading it holds a whole oversized
record.  Every row carries the SHA-1 of the payload up to its end: a reader checks while it streams
and knows at which chunk a record broke.  An archive's rows in order of their place are the bytes of
a WARC/1.1 file; ``export`` writes that file.

``write`` makes of records with equal payloads one response, that with the smallest page_id; the
others are revisits without payload that refer to it.  ``read`` streams each record's chunks in
order, parses the header and returns a row per record.

Edge cases: a null payload is empty; a null url has no target header; line breaks in a url are
percent-encoded in it; rows that repeat a page_id are responses of their own; a row without page_id
is a record without a page, and never what a revisit refers to; an empty table gives an empty
archive; other columns are ignored, whatever their names.
"""

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.tables import materialise

CHUNK_BYTES = 1 << 20
FLUSH_BYTES = 8 << 20

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CHUNKS = "archive int, place long, record string, chunk int, last boolean, digest string, payload_bytes long, data binary"
RECORDS = (
    "page_id long, record string, record_type string, target string, payload_bytes long, payload_digest string, "
    "refers_to long, n_chunks long, intact boolean"
)


def bare_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_uri(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def _header(row: dict, number: str) -> bytes:
    """The header of a record, up to where its block begins."""
    kind = "revisit" if row["refers_to"] is not None else "response"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}",
        f"WARC-Record-ID: {_record_uri(row['page_id']) if row['page_id'] is not None else f'<urn:x-row:{number}>'}",
    ]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{row['digest']}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_uri(row['refers_to'])}"]
    length = len(HTTP) + (0 if kind == "revisit" else row["size"])
    lines += [f"X-Payload-Length: {row['size']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP


def _typed(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, size, sha1, refers_to and payload (null for revisits)."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"))
    # only digests that repeat are joined; written first, so that their size decides how
    several = rows.filter((F.col("size") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("sha1", "size")
    several = materialise(several.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "copies")
    joined = rows.join(several, ["sha1", "size"], "left")
    again = F.col("first").isNotNull() & (F.col("page_id") > F.col("first"))
    return joined.select(
        "page_id", "url", "size", "sha1", F.when(again, F.col("first")).alias("refers_to"),
        F.when(~F.coalesce(again, F.lit(False)), F.col("payload")).alias("payload"),
    )


def write(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, least_bytes: int = 0) -> None:
    """A record for each row of ``pages`` (page_id, url, html), one archive for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        archive, place, number, held = TaskContext.get().partitionId(), 0, 0, 0
        names = ["archive", "place", "record", "chunk", "last", "digest", "payload_bytes", "data"]
        types = [pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.binary()]
        out: list[list] = [[] for _ in names]

        def flushed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(v, t) for v, t in zip(out, types)], names=names)

        for batch in batches:
            payloads = batch.column("payload")
            for k, row in enumerate(batch.select(["page_id", "url", "size", "sha1", "refers_to"]).to_pylist()):
                record = f"{archive}-{number}"
                number += 1
                row["digest"] = bare_digest(bytes.fromhex(row["sha1"]))
                value = payloads[k].as_buffer()  # no copy of the payload
                view = memoryview(value) if value is not None else memoryview(b"")
                state, sent, begin = hashlib.sha1(), 0, _header(row, record)
                for chunk in range(max(1, -(-len(view) // chunk_bytes))):
                    part = view[chunk * chunk_bytes : (chunk + 1) * chunk_bytes]
                    state.update(part)
                    sent += len(part)
                    last = (chunk + 1) * chunk_bytes >= len(view)
                    data = b"".join((begin if chunk == 0 else b"", part, b"\r\n\r\n" if last else b""))
                    values = (archive, place, record, chunk, last, bare_digest(state.copy().digest()), sent, data)
                    for column, v in zip(out, values):
                        column.append(v)
                    place += len(data)
                    held += len(data)
                    if held >= FLUSH_BYTES:
                        yield flushed()
                        out, held = [[] for _ in names], 0
        yield flushed()

    _typed(pages, least_bytes).mapInArrow(run, CHUNKS).write.parquet(path)


class _Record:
    """One record while its chunks stream by."""

    def __init__(self) -> None:
        self.head, self.fields, self.sha1 = b"", None, hashlib.sha1()
        self.bytes = self.chunks = self.block = 0
        self.intact = True

    def add(self, chunk: int, last: bool, digest: str, so_far: int, data: memoryview) -> None:
        self.intact &= chunk == self.chunks
        self.chunks += 1
        if last:
            self.intact &= bytes(data[-4:]) == b"\r\n\r\n"
            data = data[:-4]
        if self.fields is None:
            self.head += bytes(data)
            warc, found, rest = self.head.partition(b"\r\n\r\n")
            http, both, payload = rest.partition(b"\r\n\r\n")
            if not both:
                return
            self.fields = dict(x.split(": ", 1) for x in warc.decode().split("\r\n")[1:])
            self.block = len(http) + 4
            data, self.head = memoryview(payload), b""
        self.sha1.update(data)
        self.bytes += len(data)
        self.intact &= bare_digest(self.sha1.copy().digest()) == digest and self.bytes == so_far

    def row(self, record: str) -> tuple:
        f = self.fields or {}
        page = f.get("WARC-Record-ID", "")
        refers, kind = f.get("WARC-Refers-To"), f.get("WARC-Type")
        digest, size = bare_digest(self.sha1.digest()), self.bytes
        told = f.get("WARC-Payload-Digest", "").removeprefix("sha1:")
        intact = self.intact and self.block + self.bytes == int(f.get("Content-Length", -1))
        if kind == "revisit":  # the payload is the other record's
            digest, size = told, int(f.get("X-Payload-Length", 0))
        else:
            intact = intact and digest == told
        target = f.get("WARC-Target-URI")
        if target is not None:
            target = target.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
        number = lambda uri: int(uri[len("<urn:x-page:") : -1])
        return (
            number(page) if page.startswith("<urn:x-page:") else None, record, kind, target, size, digest,
            number(refers) if refers else None, self.chunks, intact,
        )


def read(spark: SparkSession, path: str) -> DataFrame:
    """RECORDS of the archives under ``path``; memory holds one batch of chunks and a digest."""
    names = [x.split(" ")[0] for x in RECORDS.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[x.split(" ")[1]] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, state = None, _Record()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.record_batch([pa.array(v, t) for v, t in zip(columns, types)], names=names)

        for batch in batches:
            done: list[tuple] = []
            keys = [batch.column(c).to_pylist() for c in ("record", "chunk", "last", "digest", "payload_bytes")]
            data = batch.column("data")
            for k, (own, chunk, last, digest, so_far) in enumerate(zip(*keys)):
                if own != record:
                    if record is not None:
                        done.append(state.row(record))
                    record, state = own, _Record()
                state.add(chunk, last, digest, so_far, memoryview(data[k].as_buffer()))
            yield batch_of(done)
        if record is not None:
            yield batch_of([state.row(record)])

    chunks = spark.read.schema(CHUNKS).parquet(path)
    ordered = chunks.repartition("record").sortWithinPartitions("record", "chunk")
    return ordered.select("record", "chunk", "last", "digest", "payload_bytes", "data").mapInArrow(run, RECORDS)


def export(chunks: DataFrame, folder: str) -> DataFrame:
    """Write each archive as ``folder``/NNNNN.warc, chunk after chunk; returns (archive, bytes).

    ``folder`` is one that all executors have mounted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        archive, file = None, None
        sizes: dict[int, int] = {}
        for batch in batches:
            for own, data in zip(batch.column("archive").to_pylist(), batch.column("data")):
                if own != archive:
                    if file:
                        file.close()
                        os.replace(file.name, file.name.removesuffix(".part"))  # whole or not at all
                    archive, file = own, open(f"{folder}/{own:05d}.warc.part", "wb")
                sizes[own] = sizes.get(own, 0) + file.write(memoryview(data.as_buffer()))
        if file:
            file.close()
            os.replace(file.name, file.name.removesuffix(".part"))
        yield pa.record_batch({"archive": pa.array(sizes.keys(), pa.int32()), "bytes": pa.array(sizes.values(), pa.int64())})

    ordered = chunks.repartition("archive").sortWithinPartitions("archive", "place")
    return ordered.select("archive", "data").mapInArrow(run, "archive int, bytes long")
