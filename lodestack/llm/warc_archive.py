"""WARC archives compressed with Zstandard: one frame per record, dictionary in the leading skippable frame.

Writing: tasks write archives, rolled over by size, to shared storage, each under a name of its own, and list them; the
list of the tasks that Spark took is the manifest. Reading: the archives of a manifest come back through Spark's binary
file source, so what a lost or repeated attempt has left is not read; the dictionary is loaded from the leading skippable
frame, each frame is decoded by itself, and header lines, lengths, block and payload digests are validated.

Duplicate payloads: of records with equal payloads of at least ``least`` bytes the one with the greatest page_id
is the response, others are revisits of it without a payload; smaller ones are all responses.

Defined results: a null html is an empty payload; a page with a null id has an empty one in the archive and is read
back null, and equal payloads have it revisit a page with an id; repeated rows stay repeated; an empty table gives no archive and no rows; a record that fails validation
ends the read with an error that names the archive and offset.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle

#: Fixed values of the formats.
VERSION = "WARC/1.1"
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
LEAST = 1000
ROLL_BYTES = 16 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLES = 400


def train_dictionary(pages: DataFrame, html: str = "html") -> bytes:
    """A raw-content dictionary from a bounded sample of pages: beginnings, which share most."""
    rows = pages.where(F.length(html) > 200).select(F.left(html, F.lit(2000)).alias("h")).limit(SAMPLES).collect()
    return "".join(sorted(r["h"] for r in rows)).encode("utf-8", "replace")[-DICTIONARY_BYTES:]


def record(kind: str, page_id: int | None, url: str, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest if kind == 'response' else hashlib.sha1(payload).hexdigest()}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record after checks of its version, header lines, length, end and digests."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or lines[0] != VERSION:
        raise ValueError("no WARC version line or no end of the header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon:
            raise ValueError(f"bad header line {line!r}")
        fields[name.lower()] = value
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-block-digest"):
        if name not in fields:
            raise ValueError(f"no {name}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content length {n} does not fit the record")
    payload = rest[:n]
    if fields["warc-block-digest"] != "sha1:" + hashlib.sha1(payload).hexdigest():
        raise ValueError("the block does not have its digest")
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != fields["warc-block-digest"]:
        raise ValueError("the payload does not have its digest")
    return fields | {"payload": payload}


def with_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Adds payload_digest, payload_bytes, record_type and refers_to, all before any archive is written."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), body.alias("payload"))
    own = own.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # Only digests that occur again are joined, so most pages meet no partner and move once at most.
    again = own.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    own = own.join(again, "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return own.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("first_id")


def write(typed: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Writes the archives and returns (name, records) of each; ``folder`` is a URI of storage all tasks share."""
    level, place = 3, folder.replace("s3a://", "s3://", 1)

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(place)
        store.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None)
        lead = struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary
        task, parts, size, count, roll = TaskContext.get().partitionId(), [lead], len(lead), 0, 0
        done = []

        def close() -> None:
            nonlocal parts, size, count, roll
            name = f"part-{task:06d}-{roll:04d}-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                for p in parts:
                    out.write(p)
            done.append((name, count))
            parts, size, count, roll = [lead], len(lead), 0, roll + 1

        for pdf in batches:
            for r in zip(pdf["record_type"], pdf["page_id"], pdf["url"], pdf["payload_digest"], pdf["payload"], pdf["refers_to"], strict=True):
                page, refers = r[1], r[5]
                frame = packer.compress(record(r[0], page, " ".join(r[2].split()), r[3], b"" if refers is not None else bytes(r[4]), refers))
                parts.append(frame)
                size, count = size + len(frame), count + 1
                if size >= ROLL_BYTES:
                    close()
        if count:
            close()
        yield pd.DataFrame(done, columns=["name", "records"])

    columns = ("record_type", "page_id", "url", "payload_digest", "payload", "refers_to")
    # Sorted, so a task that runs again rolls over at the same records. Ids go as text: pandas keeps a whole number beside a
    # null as a fraction, which changes large ones.
    ordered = typed.select(*columns).sortWithinPartitions("page_id", "payload_digest", "url")
    return ordered.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).mapInPandas(save, "name string, records long")


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and decoded bytes of each record of an archive, one frame at a time."""
    magic, n = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a skippable frame")
    at, dictionary = 8 + n, data[8 : 8 + n]
    if dictionary[:4] == FRAME:  # a dictionary may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None)
    view = memoryview(data)
    while at < len(data):
        if data[at : at + 4] != FRAME:
            raise ValueError(f"no frame at {at}")
        one = unpacker.decompressobj()
        out, start, step = [], at, 1 << 16
        while not one.eof:
            if at >= len(data):
                raise ValueError(f"the frame at {start} is cut short")
            out.append(one.decompress(view[at : at + step]))
            at += step
        at = min(at, len(data)) - len(one.unused_data)
        yield start, b"".join(out)


def read(spark: SparkSession, folder: str, payloads: bool = True, manifest: DataFrame | None = None) -> DataFrame:
    """(page_id, url, record_type, payload_digest, block_bytes, payload, refers_to) of every record, validated, of the
    archives that a written ``manifest`` (name) lists, or of all; without ``payloads`` they are decoded and checked but
    left null."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                rows, at = [], 0
                try:
                    for at, raw in frames(bytes(data)):
                        f = parse(raw)
                        page = lambda v: v[len("<urn:page:") : -1] or None
                        rows.append((page(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"], f["warc-payload-digest"][5:], len(f["payload"]), f["payload"] if payloads else None, page(f["warc-refers-to"]) if "warc-refers-to" in f else None))
                        if len(rows) >= 2000:
                            yield frame(rows)
                            rows = []
                except ValueError as e:
                    raise ValueError(f"{path}, at {at}: {e}") from e
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["page_id", "url", "record_type", "payload_digest", "block_bytes", "payload", "refers_to"])

    schema = "page_id string, url string, record_type string, payload_digest string, block_bytes long, payload binary, refers_to string"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    if manifest is not None:
        files = files.withColumn("name", F.substring_index("path", "/", -1)).join(manifest.select("name"), "name", "left_semi").select("path", "content")
    return files.mapInPandas(load, schema).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def resolve(records: DataFrame) -> DataFrame:
    """Per record the digest columns; a revisit has the length of the payload it refers to."""
    slim = settle(records.select("page_id", "record_type", "payload_digest", "block_bytes", "refers_to"), "warc-records")
    first = slim.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("block_bytes").alias("full_bytes"))
    revisits = slim.where("record_type = 'revisit'").join(first, "payload_digest", "left")
    whole = slim.where("record_type != 'revisit'").withColumn("full_bytes", F.col("block_bytes"))
    return whole.unionByName(revisits).select("page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Writes all pages to archives in ``folder``, reads the archives back and resolves revisits."""
    manifest = settle(write(with_types(pages), folder, train_dictionary(pages)), "warc-manifest")
    if manifest.isEmpty():
        return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return resolve(read(pages.sparkSession, folder, payloads=False, manifest=manifest))
