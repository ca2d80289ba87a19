"""Operator 2, WARC archives of individually compressed records with a shared dictionary.

Writer: a Zstandard dictionary is trained on a bounded sample of the records
(``SAMPLE_RECORDS`` records, the least by a hash, of at most ``SAMPLE_BYTES``
bytes each). Each partition becomes one archive: a skippable frame that holds
the dictionary, a warcinfo record, then one frame per record. Spark's own text
writer commits the files, so retries and lost executors leave no half archive
and any path that Spark can write will do: a row is the raw bytes of a frame,
and the line separator is an empty skippable frame, which every Zstandard
reader passes over.

Records of equal payload (at least ``MIN_REVISIT`` bytes) are written once as
response, by the smallest page_id; others are revisit records that refer to it.

Defined cases: null html is an empty payload; a null url is left out; rows
that repeat the smallest page_id of a payload are all response; a null page_id
comes last; an empty table makes an archive folder without records; other
columns are not archived.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.store import Store

MIN_REVISIT = 100
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 1 << 14, 1 << 16
LEVEL = 3
#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_STEP = 1 << 14


def payloads(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) per page."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    return p.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})


def plan_records(pages: DataFrame) -> DataFrame:
    """``payloads`` with record_type and refers_to."""
    p = payloads(pages)
    first = p.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest") \
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1 and first_id is not null").drop("copies")
    # written first: where few payloads repeat, Spark sees that and need not shuffle the payloads to join
    first = Store(pages.sparkSession, "warc").keep(first)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.join(first, "payload_digest", "left").withColumns({
        "record_type": F.when(revisit, "revisit").otherwise("response"),
        "refers_to": F.when(revisit, F.col("first_id"))}).drop("first_id")


def train_dictionary(records: DataFrame) -> bytes:
    """A dictionary of at most DICTIONARY_BYTES from a bounded sample of the payloads; empty without any."""
    full = records.where("payload_bytes > 0").withColumn("h", F.xxhash64("page_id", "payload_digest"))
    # the hashes alone are ranked, so that no task sends more payloads than are in the sample
    last = full.select("h").orderBy("h").limit(SAMPLE_RECORDS).agg(F.max("h")).first()[0]
    sample = full.where(F.col("h") <= F.lit(last)).select(F.substring("payload", 1, SAMPLE_BYTES).alias("head")).limit(SAMPLE_RECORDS)
    heads = sorted(bytes(r[0]) for r in sample.collect()) if last is not None else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, heads).as_bytes()
    except (zstandard.ZstdError, ValueError):      # too little to train on: the heads themselves serve
        return b"".join(heads)[:DICTIONARY_BYTES]


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}/{digest}'.encode()).digest())}>"


def _head(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def warc_record(row: dict, date: str) -> bytes:
    """One WARC record, uncompressed."""
    uri = None if row["url"] is None else "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"])
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http if revisit else http + row["payload"]
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", _record_id(row["page_id"], row["payload_digest"])), ("WARC-Date", date),
              ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
              ("WARC-Profile", REVISIT_PROFILE if revisit else None),
              ("WARC-Refers-To", _record_id(row["refers_to"], row["payload_digest"]) if revisit else None),
              ("X-Page-Id", row["page_id"]), ("X-Refers-To-Page", row["refers_to"]),
              ("Content-Type", "application/http; msgtype=response")]
    return _head(fields, len(block)) + block + b"\r\n\r\n"


def write_warc(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes the records of ``plan_records`` as archives under ``path``, one a partition."""
    shared = records.sparkSession.sparkContext.broadcast(train_dictionary(records))

    def frames(batches):
        data = shared.value
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        info = b"software: skyfold\r\nformat: WARC File Format 1.1\r\n"
        head = _head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, hashlib.sha256(data).hexdigest())),
                      ("WARC-Date", date), ("Content-Type", "application/warc-fields")], len(info))
        out = [struct.pack("<II", DICTIONARY_FRAME, len(data)) + data, packer.compress(head + info + b"\r\n\r\n")]
        for batch in batches:
            for row in batch.to_pylist():
                out.append(packer.compress(warc_record(row, date)))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                out = []

    bk.map_batches(records, frames, "value binary").select(F.col("value").cast("string").alias("value")) \
      .write.text(path, lineSep=EMPTY_FRAME)


def archive_records(content: memoryview):
    """The uncompressed records of one archive, one at a time, by a standard parse of its frames."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    while at < len(content):
        magic, length = struct.unpack("<II", content[at:at + 8])
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            if magic == DICTIONARY_FRAME:
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(content[at + 8:at + 8 + length])))
            at += 8 + length
            continue
        frame, out = unpacker.decompressobj(), []
        while not frame.eof:
            step = content[at:at + _STEP]
            if not len(step):
                raise ValueError("archive ends inside a frame")
            out.append(frame.decompress(step))
            at += len(step)
        at -= len(frame.unused_data)
        yield b"".join(out)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (by lower-case name) and block of one WARC record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


_READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record of the archives under ``path``. A response's length and
    digest are taken from its payload, which must agree with the header; a revisit has no payload."""
    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                cols: list[list] = [[] for _ in range(7)]
                size = 0
                for record in archive_records(memoryview(content.as_buffer())):
                    fields, block = parse_record(record)
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["warc-payload-digest"].partition(":")[2]
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {fields['warc-record-id']} doesn't agree with its header")
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
                    for c, v in zip(cols, (page and int(page), fields.get("warc-target-uri"), kind, refers and int(refers), length, digest, payload if kind == "response" else None)):
                        c.append(v)
                    size += len(payload)
                    if size > bk.SLICE_BYTES:
                        yield batch_of(cols)
                        cols, size = [[] for _ in range(7)], 0
                yield batch_of(cols)

    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _READ.split(", ")]

    def batch_of(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return bk.map_batches(files, rows, _READ)
