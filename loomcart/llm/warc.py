"""WARC archives compressed record by record with a dictionary of their own kind of record.

An archive begins with a skippable frame that holds the Zstandard dictionary (magic 0x184D2A5D), followed by one frame
for each record, so any record can be read alone. Of records with equal payloads that with the smallest page id is a
response, the others are revisits that refer to it.

A folder of archives has a listing, a table written by Spark with the names of the archives that belong to it. What an
attempt left behind that failed or came second is not in the listing and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.session import ship_package

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 * 1024
#: Bound of the sample that the dictionary is made from: records, and bytes of each.
SAMPLE_RECORDS, SAMPLE_BYTES = 1000, 8192
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
LISTING, LISTED = "listing", "archive string, records long, bytes long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:x-page:(null|-?\d+)>")


def make_dictionary(pages: DataFrame, html: str) -> bytes:
    """A dictionary from the payloads with the smallest hashes; a plain run of them where too few are there to train."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    hashed = pages.select(F.xxhash64(payload).alias("h"), F.substring(payload, 1, SAMPLE_BYTES).alias("part"))
    # Hashes small enough to hold about four times the sample, so that tasks do not each send a whole sample.
    few = hashed.where((F.col("h") / 2.0**64 + 0.5) * pages.count() < 4 * SAMPLE_RECORDS).where(F.length("part") > 0)
    rows = few.groupBy("h").agg(F.min("part").alias("part")).orderBy("h").limit(SAMPLE_RECORDS).collect()
    parts = [bytes(r["part"]) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[:DICTIONARY_BYTES]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if len(content) >= 8 else None


def _record_id(page: int | None) -> str:
    return f"<urn:x-page:{'null' if page is None else page}>"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    """The record of one decided page."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or _record_id(row["page_id"])[1:-1])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    headers = [
        ("WARC-Record-ID", _record_id(row["page_id"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(row["digest"]).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["payload"] is not None:
        return _record("response", headers, http + row["payload"])
    headers += [("WARC-Refers-To", _record_id(row["first"])), ("WARC-Profile", PROFILE)]
    return _record("revisit", headers, http)


def _decide(pages: DataFrame, min_payload: int, page_id: str, url: str, html: str) -> DataFrame:
    """Responses with their payload, revisits with the page they refer to. Only the narrow rows of revisits meet at a
    frequent payload; payloads are joined by page."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).select(
        "page_id",
        "url",
        "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.unhex(F.sha1("payload")).alias("digest"),
    )
    large = F.col("payload_bytes") >= min_payload
    narrow = rows.drop("payload").where(large)
    # Null ids come last: they are a group's response only where it has no other id.
    first = narrow.groupBy("digest", "payload_bytes").agg(F.min("page_id").alias("first"))
    same = (F.col("r.digest") == F.col("f.digest")) & (F.col("r.payload_bytes") == F.col("f.payload_bytes"))
    responses = (
        rows.where(large).alias("r").join(first.alias("f"), same & F.col("r.page_id").eqNullSafe(F.col("f.first")))
        .select("r.page_id", "url", "payload", "r.payload_bytes", "r.digest", F.lit(None).cast("long").alias("first"))
    )
    revisits = (
        narrow.alias("r").join(first.alias("f"), same).where(~F.col("r.page_id").eqNullSafe(F.col("f.first")))
        .select("r.page_id", "url", F.lit(None).cast("binary").alias("payload"), "r.payload_bytes", "r.digest", "first")
    )
    small = rows.where(~large).withColumn("first", F.lit(None).cast("long"))
    return responses.unionByName(revisits).unionByName(small) if min_payload > 0 else responses.unionByName(revisits)


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    min_payload: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Writes a record for every row into archives under ``folder``; returns ``archive, records, bytes`` of each.

    Null html is an empty payload; a null url becomes a name made from the id. Equal payloads below ``min_payload``
    bytes are all responses. Rows that repeat the smallest id of a payload are each a response; a null id is larger than
    any other. Extra columns are ignored; an empty table writes no archive and an empty listing. Every attempt of a task
    writes under names of its own, and the listing names those of the attempts that count. ``folder`` must be new and
    reachable from all executors.
    """
    spark = pages.sparkSession
    ship_package(spark)
    dictionary = make_dictionary(pages, html)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        task, number, held, size, records = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", 0, [], 0, 0
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        store.create_dir(root, recursive=True)

        def close() -> pa.RecordBatch:
            name = f"pages-{task}-{number:05d}.warc.zst"
            info = _record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"software: loomcart\r\nformat: WARC File Format 1.1\r\n")
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                out.write(compressor.compress(info))
                for frame in held:
                    out.write(frame)
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [records], "bytes": [size]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                frame = compressor.compress(page_record(row, date))
                held.append(frame)
                size, records = size + len(frame), records + 1
                if size >= ARCHIVE_BYTES:
                    yield close()
                    number, held, size, records = number + 1, [], 0, 0
        if held:
            yield close()

    decided = _decide(pages, min_payload, page_id, url, html)
    decided.mapInArrow(write, LISTED).write.parquet(f"{folder}/{LISTING}")
    return read_listing(spark, folder)


def read_listing(spark: SparkSession, folder: str) -> DataFrame:
    """``archive, records, bytes`` of the archives that belong to a folder."""
    return spark.read.schema(LISTED).parquet(f"{folder}/{LISTING}")


def read_records(content: bytes) -> Iterator[dict]:
    """Records of one archive: headers, and the HTTP headers and payload of its block."""
    magic, length = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(content[8 : 8 + length]))
    stream = io.BufferedReader(decompressor.stream_reader(io.BytesIO(content[8 + length :]), read_across_frames=True), 1 << 16)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield {"headers": headers, "http": http.decode(), "payload": payload}


def _page_of(value: str) -> int | None:
    found = _ID.fullmatch(value)[1]
    return None if found == "null" else int(found)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Page records of all listed archives of a folder: ``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload``; a response's digest is verified, a revisit has no payload. A folder without archives gives no
    row; files that are not listed are not read."""
    ship_package(spark)
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as archive:
                    content = archive.read()
                for record in read_records(content):
                    head = record["headers"]
                    if head["WARC-Type"] == "warcinfo":
                        continue
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = head["WARC-Type"] == "response"
                    if response and base64.b32encode(hashlib.sha1(record["payload"]).digest()).decode() != digest:
                        raise ValueError(f"damaged payload of {head['WARC-Record-ID']}")
                    out.append(
                        {
                            "page_id": _page_of(head["WARC-Record-ID"]),
                            "url": head["WARC-Target-URI"],
                            "payload_bytes": int(re.search(r"Content-Length: (\d+)", record["http"])[1]),
                            "payload_digest": digest,
                            "record_type": head["WARC-Type"],
                            "refers_to": _page_of(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None,
                            "payload": record["payload"] if response else None,
                        }
                    )
                    size += len(record["payload"])
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    listed = read_listing(spark, folder).select("archive")
    return listed.repartition("archive").mapInArrow(
        read,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )
