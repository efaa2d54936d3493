"""WARC archives: captures are written as linked records, read back and put together as transactions.

Writing: each capture becomes a request, a response (or a revisit) and a metadata record. The request and the metadata
record name the response by WARC-Concurrent-To. Of captures with equal payloads the one with the largest id is the
response; the others revisit it (WARC-Refers-To). Payloads shorter than `revisit_from` bytes are always responses.
Every record is a gzip member of its own; a task starts a new archive when the present one reaches its size limit.
An archive is written under a name of the attempt and then renamed, and only archives that a finished task reports
are listed, so a repeated task leaves no half of an archive behind.

Reading: archives are parsed record by record, a bounded piece of the file at a time. `transactions` joins requests
and metadata to responses by their concurrent-to identifiers and gives one nested row per capture.

Defined results: a null payload is empty, a null url gives a record without a target, a null id counts as the smallest
and is told apart from every number. Rows with the same id and payload are separate captures; those with the largest
id of a payload are all responses and share one record id. An empty table gives no archive and no row. Only the named
columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import file_store, shipped
from lakelens.session import scratch_path

ARCHIVE_BYTES = 64 << 20
PIECE_BYTES = 1 << 20
#: Reading tasks; beyond this number a task reads several archives.
MOST_READERS = 50_000
CAPTURED_AT = "2024-01-01T00:00:00Z"

RECORDS = (
    "record_id string, type string, concurrent_to string, refers_to string, target string, digest string, "
    "capture_id long, payload_bytes long, payload binary"
)


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hex (20 bytes, so no padding): four groups of 40 bits."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = []
    for start in range(1, 41, 10):
        bits = F.conv(hex_digest.substr(start, 10), 16, 10).cast("long")
        places = [F.pmod(F.shiftright(bits, shift), F.lit(32)).cast("int") + 1 for shift in range(35, -1, -5)]
        digits += [letters.substr(place, F.lit(1)) for place in places]
    return F.concat(*digits)


def record_id(kind: str, capture_id: Column, url: Column, digest: Column, nth: Column) -> Column:
    """A name-based uuid, the same in every run."""
    parts = [F.lit(kind), F.coalesce(capture_id.cast("string"), F.lit("null")), F.coalesce(url, F.lit("")), digest, nth.cast("string")]
    name = F.md5(F.concat_ws("|", *parts))
    version, variant = F.concat(F.lit("3"), name.substr(14, 3)), F.concat(F.lit("8"), name.substr(18, 3))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", name.substr(1, 8), name.substr(9, 4), version, variant, name.substr(21, 12)))


class ArchiveWriter:
    """Archives of one task: gzip members, one per record, renamed into place when full."""

    def __init__(self, folder: str):
        self.store, self.folder = file_store(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.out, self.size, self.records = None, 0, 0

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = uuid.uuid4().hex
            self.out = self.store.open_output_stream(f"{self.folder}/.{self.name}.partial", compression=None)
        member = gzip.compress(record, 6, mtime=0)
        self.out.write(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> list[tuple[str, int, int]]:
        if self.out is None:
            return []
        self.out.close()
        self.store.move(f"{self.folder}/.{self.name}.partial", f"{self.folder}/{self.name}.warc.gz")
        done = [(f"{self.name}.warc.gz", self.records, self.size)]
        self.out, self.size, self.records = None, 0, 0
        return done


def _record(kind: str, identifier: str, fields: list[tuple[str, str | None]], content: str, body: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{identifier}>"), ("WARC-Date", CAPTURED_AT), *fields]
    lines += [("Content-Type", content), ("Content-Length", str(len(body)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def _one_line(text: str | None) -> str | None:
    """Header values hold no line ends; those of an url are percent-encoded and stay so."""
    return text if text is None else text.replace("\r", "%0D").replace("\n", "%0A")


def write_archives(
    pages: DataFrame, folder: str, capture_id: str = "page_id", url: str = "url", payload: str = "html", revisit_from: int = 0
) -> DataFrame:
    """Writes a WARC archive set under `folder`; returns (archive, records, bytes), one row per archive."""
    shipped(pages.sparkSession)
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    captures = pages.select(
        F.col(capture_id).cast("long").alias("capture_id"),
        F.col(url).alias("url"),
        body.alias("body"),
        F.sha2(body, 256).alias("same"),
        F.sha1(body).alias("sha1"),
        F.monotonically_increasing_id().alias("nth"),
    )
    keyed = pages.select(F.col(capture_id).cast("long").alias("capture_id"), body.alias("body"))
    shared = (
        keyed.where(F.octet_length("body") >= revisit_from)
        .groupBy(F.sha2("body", 256).alias("same"))
        .agg(F.max("capture_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    later = F.col("copies").isNotNull() & ~F.col("capture_id").eqNullSafe(F.col("first_id"))
    linked = captures.join(written(shared, "warc-shared"), "same", "left").withColumn("revisits", later)
    digest = base32(F.col("sha1"))
    shared_name = record_id("payload", F.col("first_id"), F.lit(""), F.col("same"), F.lit(0))
    own = [F.col("capture_id"), F.col("url"), F.col("same"), F.col("nth")]
    named = linked.select(
        "capture_id",
        "url",
        F.when(~F.col("revisits"), F.col("body")).alias("body"),
        F.octet_length("body").alias("n"),
        "revisits",
        digest.alias("digest"),
        record_id("response", *own).alias("main"),
        record_id("request", *own).alias("asked"),
        record_id("metadata", *own).alias("about"),
        F.when(F.col("revisits"), shared_name).alias("origin"),
        F.when(F.col("copies").isNotNull() & ~F.col("revisits"), shared_name).alias("first"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, done = ArchiveWriter(folder), []
        for batch in batches:
            for row in batch.itertuples(index=False):
                url = _one_line(row.url)
                # The first response of a shared payload goes by the payload's name, so that revisits can point to it.
                main = row.first or row.main
                target = [("WARC-Target-URI", url)]
                linked_to = [*target, ("WARC-Concurrent-To", f"<{main}>")]
                path = "/" if url is None else url.split("://", 1)[-1].partition("/")[2]
                writer.add(_record("request", row.asked, linked_to, "application/http; msgtype=request", f"GET /{path} HTTP/1.1\r\n\r\n".encode()))
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {row.n}\r\n\r\n".encode()
                fields = [*target, ("WARC-Payload-Digest", f"sha1:{row.digest}")]
                if row.revisits:
                    fields += [
                        ("WARC-Refers-To", f"<{row.origin}>"),
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ]
                writer.add(
                    _record("revisit" if row.revisits else "response", main, fields, "application/http; msgtype=response", head + (row.body or b""))
                )
                about = "" if row.capture_id is None else f"capture-id: {row.capture_id}\r\n"
                writer.add(_record("metadata", row.about, linked_to, "application/warc-fields", about.encode()))
                if writer.size >= ARCHIVE_BYTES:
                    done += writer.close()
        done += writer.close()
        yield pd.DataFrame(done, columns=["archive", "records", "bytes"])

    as_text = named.withColumn("capture_id", F.col("capture_id").cast("string"))
    return written(as_text.mapInPandas(write, "archive string, records long, bytes long"), "warc-list")


def _members(source) -> Iterator[bytes]:
    """The records of an archive: its gzip members, inflated one after the other."""
    inflate, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        rest = rest or source.read(PIECE_BYTES)
        if not rest:
            if parts:
                raise ValueError("The archive ends inside a record.")
            return
        parts.append(inflate.decompress(rest))
        rest = b""
        if inflate.eof:
            rest = inflate.unused_data
            yield b"".join(parts)
            inflate, parts = zlib.decompressobj(31), []


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


def _parsed(record: bytes, keep_payload: bool) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    body = rest[: int(fields.get("content-length", 0))]
    kind, digest, capture, length, payload = fields.get("warc-type"), None, None, None, None
    if kind in ("response", "revisit"):
        http, _, payload = body.partition(b"\r\n\r\n")
        if kind == "response":
            length = len(payload)
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            length = int(_fields(http).get("content-length", 0))
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            payload = None
    elif kind == "metadata":
        about = _fields(b"\r\n" + body).get("capture-id")
        capture = int(about) if about else None
    strip = lambda name: (fields.get(name) or "").strip("<>") or None
    links = [strip("warc-record-id"), kind, strip("warc-concurrent-to"), strip("warc-refers-to")]
    return (*links, fields.get("warc-target-uri"), digest, capture, length, payload if keep_payload else None)


def read_records(archives: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """One row per record of the listed archives. Without payloads only their length and digest are kept."""

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = file_store(folder)
        names = [part.split()[0] for part in RECORDS.split(", ")]
        for batch in batches:
            for archive in batch["archive"]:
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{archive}", compression=None) as source:
                    for member in _members(source):
                        rows.append(_parsed(member, keep_payload))
                        held += len(member) if keep_payload else 512
                        if held > 8 * PIECE_BYTES:
                            yield _frame(rows, names)
                            rows, held = [], 0
                yield _frame(rows, names)

    shipped(archives.sparkSession)
    listed = archives.select("archive").repartition(min(max(1, archives.count()), MOST_READERS))
    return listed.mapInPandas(read, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"capture_id": "Int64", "payload_bytes": "Int64"})


def transactions(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, response, request, metadata (structs), refers_to (the revisited capture's id).

    Requests and metadata meet their response by concurrent-to. A response without them keeps nulls there; requests and
    metadata whose response is not in the records belong to no capture. Several metadata records of one response
    give one row: the smallest record id stands for them.
    """
    whole = F.struct("record_id", "type", "concurrent_to", "refers_to", "target", "digest", "capture_id", "payload_bytes", "payload")
    main = records.where("type IN ('response', 'revisit')")
    beside = (
        records.where("type IN ('request', 'metadata') AND concurrent_to IS NOT NULL")
        .groupBy(F.col("concurrent_to").alias("to_id"))
        .agg(
            F.min(F.when(F.col("type") == "request", F.struct("record_id", "target"))).alias("request"),
            F.min(F.when(F.col("type") == "metadata", F.struct("record_id", "target", "capture_id"))).alias("metadata"),
        )
    )
    captures = main.select(F.col("record_id").alias("main_id"), whole.alias("response")).join(beside, F.col("main_id") == F.col("to_id"), "left")
    return captures.select(F.col("metadata.capture_id").alias("capture_id"), "main_id", "response", "request", "metadata")


def with_revisited(captures: DataFrame) -> DataFrame:
    """Adds refers_to: the capture id of the response that a revisit points to; null for responses."""
    origin = captures.where("response.type = 'response'").groupBy(F.col("main_id").alias("origin_id")).agg(F.max("capture_id").alias("refers_to"))
    # Responses join themselves: a key of their own spreads them, where null would gather them in one task.
    keyed = captures.withColumn("key", F.coalesce("response.refers_to", "main_id"))
    joined = keyed.join(origin, F.col("key") == F.col("origin_id"), "left").drop("key", "origin_id")
    return joined.withColumn("refers_to", F.when(F.col("response.refers_to").isNotNull(), F.col("refers_to")))


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared scratch folder."""
    return scratch_path(spark, "warc")
