"""WARC records in seekable Zstandard bundles: independent frames, a seek table as footer, and an index of records.

A bundle is one file. Records are grouped into frames of about ``FRAME`` bytes that decompress on their own; the last
frame is a skippable one with the sizes of all others, so a reader finds any frame from the end of the file. The index
maps a record to its bundle, frame, and place within the frame's plain bytes.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard import workspace

FRAME = 1 << 20  # plain bytes from which on a frame is closed; a larger record is a frame of its own
BUNDLE = 256 << 20  # plain bytes from which on a file is closed
READ_BYTES = 16 << 20  # plain bytes that a reading task gets
LEVEL = 3
COPIES_BROADCAST = 200_000  # so many repeated payloads are broadcast; more meet their pages in a shuffle

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"  # the records describe a table without a fetch time


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value) -> str:
    """A header value: control characters would end the header, so they are escaped like in a URL."""
    return "".join(c if c >= " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in str(value))


def _plain(value: str) -> str:
    from urllib.parse import unquote

    return unquote(value)


def record_name(number: int) -> str:
    return f"urn:uuid:{uuid.UUID(int=number)}"


def record(number: int, page_id, url, payload: bytes, refers_to) -> bytes:
    """A WARC 1.1 record; ``refers_to`` makes it a revisit, whose payload is that of the page it names."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_name(number)}>",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}",
    ]
    if page_id is not None:
        head.append(f"X-Page: {_line(page_id)}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {_line(refers_to)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + body + b"\r\n\r\n"


def read_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers, body, and where the next record starts."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    start, size = end + 4, int(head["Content-Length"])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut off")
    return head, data[start:start + size], start + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: compressed and plain size of each frame, their number, and the magic number at the very end."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(read_at, size: int) -> list[tuple[int, int, int]]:
    """``(offset, compressed, plain)`` of each frame; ``read_at(offset, length)`` reads the file of ``size`` bytes."""
    count, flags, magic = struct.unpack("<IBI", read_at(size - 9, 9))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    rows = struct.iter_unpack("<II", read_at(size - 9 - 8 * count, 8 * count))
    out, offset = [], 0
    for packed, plain in rows:
        out.append((offset, packed, plain))
        offset += packed
    return out


def arrow_uri(folder: str, environ: dict[str, str] | None = None) -> str:
    """The folder under the name that Arrow's file systems know it by: ``s3a://`` is ``s3://`` there, with the endpoint that
    the environment gives for both."""
    scheme, rest = folder.split("://", 1) if "://" in folder else ("", folder)
    if scheme not in ("s3a", "s3n"):
        return folder
    host = (os.environ if environ is None else environ).get("OBJECT_STORE_ENDPOINT")
    if not host:
        return f"s3://{rest}"
    kind, _, name = host.rpartition("://")
    return f"s3://{rest}?scheme={kind or 'https'}&endpoint_override={name}"


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(arrow_uri(folder))


class _Bundle:
    """One file being written: under a name of its own, so that a repeated task never touches another's file."""

    def __init__(self, folder: str):
        self.fs, path = opened(folder)
        self.fs.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.file = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.plain, self.offset = 0, 0

    def frame(self, data: bytes) -> tuple[int, int]:
        packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(data)
        self.file.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.plain += len(data)
        self.offset += len(packed)
        return len(self.sizes) - 1, self.offset - len(packed)

    def close(self) -> None:
        self.file.write(seek_table(self.sizes))
        self.file.close()


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, page_type: pa.DataType):
    names = ["record_id", "page_id", "bundle", "frame", "frame_offset", "at", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, held, held_bytes, ids, record_ids, number = None, [], 0, [], [], 0
        base = uuid.uuid4().int & ~((1 << 48) - 1)

        def close_frame():
            frame, offset = bundle.frame(b"".join(held))
            ends, at = [], 0
            for part in held:
                ends.append(at)
                at += len(part)
            return pa.RecordBatch.from_arrays([
                pa.array(record_ids, pa.string()), pa.array(ids, page_type), pa.array([bundle.name] * len(held), pa.string()), pa.array([frame] * len(held), pa.int32()),
                pa.array([offset] * len(held), pa.int64()), pa.array(ends, pa.int64()), pa.array([len(p) for p in held], pa.int64())], names=names)

        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                bundle = bundle or _Bundle(folder)
                held.append(record(base + number, page_id, url, (html or "").encode("utf-8"), refers))
                ids.append(page_id)
                record_ids.append(record_name(base + number))
                held_bytes += len(held[-1])
                number += 1
                if held_bytes >= frame_bytes:
                    yield close_frame()
                    held, held_bytes, ids, record_ids = [], 0, [], []
                    if bundle.plain >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if held:
            yield close_frame()
        if bundle:
            bundle.close()

    return run


def responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``digest`` and ``largest`` page id of payloads that more than one page has; smaller ones than ``min_bytes`` have none."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    narrow = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    return (
        narrow.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "largest")
    )


def write(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
          frame_bytes: int = FRAME, bundle_bytes: int = BUNDLE) -> DataFrame:
    """Write a record per row of ``pages`` into bundles in ``folder``; return the index of the records.

    The index (``record_id``, page id, ``bundle``, ``frame``, ``frame_offset``, ``at`` and ``length`` within the frame) is stored as a
    table below ``folder`` and names all files that count: what a lost or repeated task left behind is not in it. Of rows
    with equal payloads of at least ``min_bytes`` those with the largest id are responses, the others revisits that refer
    to it; where no such row has an id, all are responses. Null html is an empty payload. ``folder`` is a URI that all
    executors reach.
    """
    rows = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    spark, kind = pages.sparkSession, dict(rows.dtypes)["page_id"]
    copies = workspace.write_table(responses(rows, min_bytes), workspace.new_path(spark, "copies"))
    small = copies.limit(COPIES_BROADCAST + 1).count() <= COPIES_BROADCAST
    keyed = rows.withColumn("digest", F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256))
    joined = keyed.join(F.broadcast(copies) if small else copies, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("largest")), None).otherwise(F.col("largest")).alias("refers_to"))
    from pyspark.sql.pandas.types import to_arrow_type

    index = joined.mapInArrow(
        _writer(arrow_uri(folder), frame_bytes, bundle_bytes, to_arrow_type(rows.schema["page_id"].dataType)),
        f"record_id string, page_id {kind}, bundle string, frame int, frame_offset long, at long, length long")
    return workspace.write_table(index, f"{folder}/index")


def _frames_of(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                size = fs.get_file_info(f"{path}/{name}").size
                with fs.open_input_file(f"{path}/{name}") as file:
                    frames = read_seek_table(lambda at, n: file.read_at(n, at), size)  # noqa: B023
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(frames), pa.string()), pa.array(range(len(frames)), pa.int32()),
                    pa.array([f[0] for f in frames], pa.int64()), pa.array([f[1] for f in frames], pa.int64()),
                    pa.array([f[2] for f in frames], pa.int64())], names=["bundle", "frame", "offset", "packed", "plain"])

    return run


def _reader(folder: str):
    names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['bundle']}") as file:
                    data = zstandard.ZstdDecompressor().decompress(file.read_at(row["packed"], row["offset"]))
                if len(data) != row["plain"]:
                    raise ValueError(f"frame {row['frame']} of {row['bundle']} has a wrong size")
                out, at = [], 0
                while at < len(data):
                    head, body, following = read_record(data, at)
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response" and (base32_sha1(body) != digest or len(body) != size):
                        raise ValueError(f"payload at {at} of frame {row['frame']} of {row['bundle']} does not fit its digest")
                    page, url, refers = head.get("X-Page"), head.get("WARC-Target-URI"), head.get("X-Refers-To-Page")
                    out.append((None if page is None else _plain(page), None if url is None else _plain(url), size, digest,
                                head["WARC-Type"], None if refers is None else _plain(refers), row["bundle"], row["frame"], at))
                    at = following
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def read(spark: SparkSession, folder: str, page_type: str = "bigint") -> DataFrame:
    """All records of the bundles that the index names, each frame read on its own and checked against its digests."""
    index = spark.read.parquet(f"{folder}/index")
    frames = index.select("bundle").distinct().mapInArrow(
        _frames_of(arrow_uri(folder)), "bundle string, frame int, offset long, packed long, plain long")
    # Frames of a crowded bundle spread over tasks, as many as the records' bytes ask for: the rows here only name them.
    plain = index.agg(F.sum("length")).first()[0] or 0
    dealt = frames.repartition(max(1, -(-plain // READ_BYTES)), "bundle", "frame")
    found = dealt.mapInArrow(
        _reader(arrow_uri(folder)), "page string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
                         "bundle string, frame int, at long")
    return found.select(
        F.col("page").cast(page_type).alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(page_type).alias("refers_to"), "bundle", "frame", "at")


def fetch(folder: str, bundle: str, frame_offset: int, at: int) -> tuple[dict, bytes]:
    """One record by its index entry: only its frame is read and decompressed."""
    fs, path = opened(folder)
    with fs.open_input_file(f"{path}/{bundle}") as file:
        file.seek(frame_offset)
        data = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=False).read()
    head, body, _ = read_record(data, at)
    return head, body


def fetch_record(spark: SparkSession, folder: str, record_id: str) -> tuple[dict, bytes] | None:
    """One record by its identifier, by way of the index; None if there is none. Also records without a page id have one."""
    entry = spark.read.parquet(f"{folder}/index").where(F.col("record_id") == record_id).first()
    return None if entry is None else fetch(folder, entry["bundle"], entry["frame_offset"], entry["at"])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all ``pages`` into a new folder below the shared root, then read every record back."""
    spark = pages.sparkSession
    folder = workspace.new_path(spark, "warc")
    write(pages, folder)
    return read(spark, folder, dict(pages.dtypes)["page_id"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
