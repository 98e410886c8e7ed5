"""WARC archives: writing, normalising monolithic gzip, reading back by offset (operator 2).

A monolithic archive is one gzip stream over all its records: nothing in it can be reached without
inflating what stands before. The normaliser inflates such a file once, front to back, in bounded
blocks, writes every record as a gzip member of its own to a new archive, and a sidecar index
with a line per record: its offset, length, id and type. A reader then opens any record at its offset.

Archives are plain files in a folder that all executors reach, given as a URI that pyarrow opens.
Each task writes under a name of its own attempt and renames the finished file, and only
finished tasks report theirs, so attempts of lost executors leave nothing that is read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shipping import ship
from corpusloom.sources.store import stage

GZIP = 31
BLOCK = 1 << 18
ARCHIVE_BYTES = 256 << 20
RECORD_BATCH = 2_000
LEVEL = 6
MANIFEST = "path string, records bigint"
INDEX = "path string, offset bigint, length bigint, record_id string, record_type string"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# -- records -------------------------------------------------------------------------------------


def record_bytes(page: str, url: str | None, payload: bytes, digest: str, size: int, refers: str | None) -> bytes:
    """A response, or, with ``refers``, a revisit: a record that names the response and has no block."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers is not None else 'response'}", f"WARC-Record-ID: <urn:page:{page}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}"]
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def read_records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record in an inflated stream; holds one record at a time."""
    held = bytearray()
    need_head, wanted, headers = True, 0, {}
    for block in blocks:
        held += block
        while True:
            if need_head:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                headers = parse_head(bytes(held[:end]))
                wanted = end + 4 + int(headers["Content-Length"]) + 4
                need_head = False
            if len(held) < wanted:
                break
            yield headers, bytes(held[:wanted])
            del held[:wanted]
            need_head = True
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(stream) -> Iterator[bytes]:
    """The content of a gzip file, of one member or many, in bounded blocks."""
    unzip = zlib.decompressobj(GZIP)
    while data := stream.read(BLOCK):
        while data:
            yield unzip.decompress(data, BLOCK * 4)
            data = unzip.unconsumed_tail
            if unzip.eof:
                data = unzip.unused_data
                unzip = zlib.decompressobj(GZIP)
    yield unzip.flush()


# -- deciding, writing, normalising, reading -------------------------------------------------------


def revisits(pages: DataFrame, page: str, digest: str, size: str, least_bytes: int, salts: int = 32) -> DataFrame:
    """``pages`` with ``first_page``: the smallest page id among equal payloads of ``least_bytes`` at least.

    Payloads that occur once need no look-up. The others' first pages come back by a join on (digest,
    salt), so that a payload with a large share of all rows is spread over many tasks.
    """
    large = F.col(size) >= least_bytes
    firsts = (
        pages.where(large)
        .groupBy(F.col(digest).alias("f_digest"))
        .agg(F.min(page).alias("first_page"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("f_digest", "first_page")
    )
    firsts = stage(firsts, "first-pages").withColumn("f_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = pages.withColumn("salt", F.coalesce(F.pmod(F.xxhash64(page), F.lit(salts)).cast("int"), F.lit(0)))
    met = (F.col(digest) == F.col("f_digest")) & (F.col("salt") == F.col("f_salt")) & large
    return salted.join(firsts, met, "left").drop("salt", "f_digest", "f_salt")


@dataclass
class _Writer:
    """One archive under way: a temporary name until it is finished."""

    folder: str

    def __post_init__(self) -> None:
        self.files, root = open_folder(self.folder)
        self.files.create_dir(root, recursive=True)
        self.name = f"{root}/{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(f"{self.name}.part")
        self.offset = 0
        self.records = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def finish(self) -> str:
        self.out.close()
        self.files.move(f"{self.name}.part", f"{self.name}.warc.gz")
        return f"{self.name.rsplit('/', 1)[1]}.warc.gz"


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page, url, payload, digest, size, refers) rows as archives of one gzip stream each;
    returns their manifest. A task begins a new archive after ``archive_bytes``."""
    ship(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = packer = None

        def close() -> pa.RecordBatch:
            writer.write(packer.flush())
            return pa.RecordBatch.from_pylist([{"path": writer.finish(), "records": writer.records}])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    writer, packer = _Writer(folder), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                page, url, payload, digest, size, refers = row
                writer.write(packer.compress(record_bytes(str(page), url, payload or b"", digest, size, refers)))
                writer.records += 1
                if writer.offset >= archive_bytes:
                    yield close()
                    writer = None
        if writer is not None:
            yield close()

    return pages.mapInArrow(run, MANIFEST)


def normalise(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each archive of ``manifest`` (path) from folder ``source`` into ``target``, a gzip
    member per record, with a sidecar ``.idx`` of JSON lines; returns the index.

    An archive is one task's work, as a gzip stream can only be read from its start. Archives with
    several members, empty archives and records of any length are read alike.
    """
    ship(manifest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(source)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                writer, index = _Writer(target), []
                with files.open_input_stream(f"{root}/{path}", compression=None) as stream:
                    for headers, record in read_records(inflate(stream)):
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        member = packer.compress(record) + packer.flush()
                        index.append((writer.offset, len(member), headers["WARC-Record-ID"], headers["WARC-Type"]))
                        writer.write(member)
                name = writer.finish()
                keys = ("offset", "length", "record_id", "record_type")
                with writer.files.open_output_stream(f"{writer.name}.idx", compression=None) as out:
                    for entry in index:
                        out.write((json.dumps(dict(zip(keys, entry))) + "\n").encode())
                for i in range(0, len(index), RECORD_BATCH):
                    yield pa.RecordBatch.from_pylist(
                        [{"path": name, **dict(zip(keys, entry))} for entry in index[i : i + RECORD_BATCH]]
                    )

    # Archives are dealt out by name: one row each.
    return manifest.select("path").repartition(max(1, manifest.count()), "path").mapInArrow(run, INDEX)


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Open every indexed record at its offset: page, what its headers say, and what its payload is.

    ``payload_bytes`` and ``payload_digest`` of a response are taken from the payload itself and
    checked against its headers; a revisit has those of the payload that it stands for.
    """
    ship(index)
    schema = "page string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        opened, name = None, None
        kind = pa.schema([("page", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                          ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                          ("payload", pa.binary())])
        for batch in batches:
            rows, held = [], 0
            for path, offset, length, record_id, record_type in zip(*(c.to_pylist() for c in batch.columns)):
                if path != name:
                    opened, name = files.open_input_file(f"{root}/{path}"), path
                record = zlib.decompress(opened.read_at(length, offset), GZIP)
                head, _, rest = record.partition(b"\r\n\r\n")
                headers, payload = parse_head(head), rest[:-4]
                found = {
                    "page": record_id[len("<urn:page:") : -1],
                    "url": headers.get("WARC-Target-URI"),
                    "payload_bytes": int(headers["WARC-Payload-Length"]),
                    "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                    "record_type": record_type,
                    "refers_to": headers["WARC-Refers-To"][len("<urn:page:") : -1] if record_type == "revisit" else None,
                    "payload": payload if record_type == "response" else None,
                }
                if record_type == "response":
                    digest = hashlib.sha256(payload).hexdigest()
                    if (len(payload), digest) != (found["payload_bytes"], found["payload_digest"]):
                        raise ValueError(f"record {record_id} of {path} is damaged")
                rows.append(found)
                held += len(payload)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, kind)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kind)

    return index.mapInArrow(run, schema)


def archive_pages(
    pages: DataFrame, page: str, url: str, html: str, folder: str, least_bytes: int = 100
) -> DataFrame:
    """Write a record per page to monolithic archives under ``folder``, normalise them, and return the index.

    Payload: ``html`` in UTF-8, null as empty. Among equal payloads of ``least_bytes`` at least, the
    smallest page id is the response and other ids are revisits of it; rows that repeat that page id are
    responses too; a null page id is a response unless a page with an id has its payload. Smaller
    payloads are responses. Null urls are left out. No rows give an empty index.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page).alias("page"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("size"),
    )
    decided = revisits(rows, "page", "digest", "size", least_bytes)
    refers: Column = F.when(~F.col("page").eqNullSafe(F.col("first_page")), F.col("first_page")).cast("string")
    records = decided.select(
        F.col("page").cast("string").alias("page"),
        "url",
        F.when(refers.isNull(), F.col("payload")).alias("payload"),
        "digest",
        "size",
        refers.alias("refers"),
    )
    manifest = stage(write_monolithic(records, f"{folder}/monolithic"), "archives")
    return stage(normalise(manifest, f"{folder}/monolithic", f"{folder}/records"), "index")
