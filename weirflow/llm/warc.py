"""WARC archives in Zstandard: one frame per record, the dictionary in a skippable frame in front.

Each partition of pages is one archive in the shared folder. Its dictionary is trained on the first payloads of the
partition, ``SAMPLE`` bytes at most; too little text for that, and the archive has none. An archive is written under a
name of its attempt and then given its own, so a task that runs again replaces what it wrote.
"""

from __future__ import annotations

import struct
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import batch, saved, ship
from weirflow.session import work_dir

#: Fixed values of the formats: magic numbers, version line, names of header fields, identical-payload profile.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TYPE, ID, DATE, URI, LENGTH = "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "Content-Length"
DIGEST, REFERS_TO, PROFILE_FIELD, CONTENT = "WARC-Payload-Digest", "WARC-Refers-To", "WARC-Profile", "Content-Type"

SAMPLE, DICTIONARY = 4 << 20, 32 << 10
#: Records carry this date: an archive of the same pages is the same archive.
WRITTEN = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def record(kind: str, page_id, url: str | None, payload: bytes, payload_digest: str, refers_to=None) -> bytes:
    """One record. A revisit has no block; its digest is that of the payload it stands for."""
    fields = [(TYPE, kind), (ID, f"<urn:page:{'' if page_id is None else page_id}>"), (DATE, WRITTEN)]
    if url is not None:
        fields.append((URI, " ".join(url.split())))
    fields.append((DIGEST, f"sha1:{payload_digest}"))
    if kind == "revisit":
        fields += [(PROFILE_FIELD, PROFILE), (REFERS_TO, f"<urn:page:{refers_to}>")]
    else:
        fields.append((CONTENT, "text/html; charset=utf-8"))
    fields.append((LENGTH, str(len(payload))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + payload + b"\r\n\r\n"


def dictionary_for(payloads: list[bytes]) -> bytes:
    """A trained dictionary, or nothing where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, [p[: 64 << 10] for p in payloads if p]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archive(out, records: Iterator[tuple[bytes, bytes]]) -> int:
    """Write (record, payload) pairs; how many there were."""
    held, size = [], 0
    for item in records:
        held.append(item)
        size += len(item[1])
        if size >= SAMPLE:
            break
    known = dictionary_for([payload for _, payload in held])
    if known:
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(known)) + known)
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(known) if known else None)
    n = 0
    for group in (held, records):
        for whole, _ in group:
            out.write(packer.compress(whole))
            n += 1
    return n


def _check(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(f"not a valid archive: {what}")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one decoded frame; its version, fields, length and digest must hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    _check(bool(gap) and version == VERSION, "version")
    fields = {}
    for line in lines:
        name, colon, value = line.decode().partition(": ")
        _check(bool(colon) and name not in fields, "header field")
        fields[name] = value
    _check(all(fields.get(k) for k in (TYPE, ID, DATE, DIGEST, LENGTH)), "missing header field")
    _check(fields[LENGTH].isdigit() and len(rest) == int(fields[LENGTH]) + 4 and rest.endswith(b"\r\n\r\n"), "length")
    block = rest[:-4]
    if fields[TYPE] == "revisit":
        _check(not block and fields.get(PROFILE_FIELD) == PROFILE and bool(fields.get(REFERS_TO)), "revisit")
    else:
        _check(fields[TYPE] == "response" and fields[DIGEST] == f"sha1:{digest(block)}", "payload digest")
    return fields, block


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an open archive, frame by frame; no more than one record and a read's worth of bytes is held."""
    data = source.read(8)
    known = None
    if len(data) == 8 and struct.unpack("<II", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<II", data)[1]
        raw = source.read(size)
        _check(len(raw) == size, "dictionary")
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be packed
            raw = zstandard.ZstdDecompressor().decompress(raw)
        known, data = zstandard.ZstdCompressionDict(raw), b""
    unpack = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    frame, parts = unpack.decompressobj(), []
    while data or (data := source.read(1 << 20)):
        parts.append(frame.decompress(data))
        data = b""
        if frame.eof:
            yield parse_record(b"".join(parts))
            data = frame.unused_data
            frame, parts = unpack.decompressobj(), []
    _check(not parts, "a frame is cut off")


def with_first(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, first): first is the smallest page_id of the pages with an equal payload.

    It is null for payloads below ``least`` bytes and where no page of the group has an id. Pages meet their group by the digest;
    only groups of more than one page take part, so without copies no payload is moved.
    """
    pages = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")
    )
    pages = pages.withColumn("digest", F.sha1("payload"))
    groups = pages.where(F.length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return pages.join(groups.where("n > 1").drop("n"), "digest", "left")


def write_pages(pages: DataFrame, least: int = 0) -> tuple[str, DataFrame]:
    """Write the pages (page_id, url, html) to archives; their folder, and (path, records) of each archive.

    A task that is lost or repeated leaves a file that no row names.

    A null html is an empty payload. Of pages with equal payloads of ``least`` bytes or more that with the smallest page_id is a response, and so are
    rows that repeat its id; the others revisit it. A page without an id is a response. An empty table gives no archive with records.
    """
    spark = ship(pages.sparkSession)
    folder = work_dir(spark, "warc")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def rows(batches):
        for part in batches:
            for page_id, url, payload, first in zip(*(part.column(i).to_pylist() for i in range(4))):
                hashed = digest(payload)
                if page_id is None or first is None or first == page_id:
                    yield record("response", page_id, url, payload, hashed), payload
                else:
                    yield record("revisit", page_id, url, b"", hashed, first), payload

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root)
        # Every attempt has a file of its own. Spark commits the rows of one attempt per task, so the manifest names whole archives only.
        path = f"{root}/pages-{TaskContext.get().partitionId():06d}-{uuid4().hex}.warc.zst"
        with store.open_output_stream(path, compression=None) as out:
            n = write_archive(out, rows(batches))
        yield batch(schema, [path], [n])

    written = with_first(pages, least).select("page_id", "url", "payload", "first").mapInArrow(write, "path string, records long")
    manifest = f"{folder}-manifest"
    written.write.parquet(manifest)  # this writes the archives
    return folder, spark.read.schema(written.schema).parquet(manifest)


def read_pages(folder: str, manifest: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, payload_digest) of every record of the archives; a revisit's payload is null.

    The archives are read one by one, each in one task; their number of records must be that of the manifest.
    """
    spark = ship(manifest.sparkSession)
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema([*kinds, ("payload", pa.binary()), ("payload_digest", pa.string())])

    def page(value: str | None):
        number = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def read(batches):
        store, _ = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for part in batches:
            for path, expected in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                n, held, size = 0, [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for fields, block in read_archive(source):
                        kind = fields[TYPE]
                        held.append((page(fields[ID]), fields.get(URI), kind, page(fields.get(REFERS_TO)), block if kind == "response" else None, fields[DIGEST][5:]))
                        n, size = n + 1, size + len(block)
                        if size >= 4 << 20:
                            yield batch(schema, *zip(*held))
                            held, size = [], 0
                _check(n == expected, f"{n} of {expected} records in {path}")
                if held:
                    yield batch(schema, *zip(*held))

    spread = manifest.repartition(max(1, manifest.count()), "path")
    fields = "page_id long, url string, record_type string, refers_to long, payload binary, payload_digest string"
    return spread.mapInArrow(read, fields)


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """What the archives of the pages hold, read back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    A revisit's payload is that of the record it refers to, found by the digest both carry.
    """
    records = read_pages(*write_pages(pages, least)).select(
        "page_id", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
    records = saved(records, "warc-records")  # the archives are read once
    whole = records.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("known"))
    revisits = records.where("record_type = 'revisit'").join(whole, "payload_digest")
    return records.where("record_type = 'response'").unionByName(revisits.withColumn("payload_bytes", F.col("known")).drop("known"))
