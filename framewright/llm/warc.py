"""WARC archives compressed by Zstandard: one frame a record, a shared dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import KeyFilter, materialise, scratch, spread_join
from .shingles import slices

#: Fixed values of the formats: the magic numbers of the dictionary's skippable frame, of any such frame and of a Zstandard frame.
DICTIONARY_MAGIC, SKIPPABLE_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is closed at about so many compressed bytes; a dictionary is trained on samples of so many bytes.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLE_ROWS = 32 << 20, 64 << 10, 16 << 10, 200


class WarcError(ValueError):
    """An archive or record that breaks the format, or whose lengths or digests don't hold."""


def sha1_base32(payload: bytes) -> str:
    return base32(hashlib.sha1(payload).digest())


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the samples, or their plain text where there is too little to train on."""
    samples = [s[:SAMPLE_BYTES] for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n"


def _compression(dictionary: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(dictionary)


def render(record_id: str, kind: str, uri: str, payload: bytes | None, refers_to: str | None, size: int = 0, digest: str = "") -> bytes:
    """A record: response with its payload, or revisit that has the headers of the response only.

    A revisit needs no payload if `size` and `digest`, in base32, are given.
    """
    if payload is not None:
        size, digest = len(payload), sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Bytes of one archive: the dictionary, itself compressed, in a skippable frame, then a frame a record."""

    def __init__(self, dictionary: bytes, level: int = 3):
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        self.out = io.BytesIO()
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        self.frames = zstandard.ZstdCompressor(level=level, dict_data=_compression(dictionary), write_checksum=True, write_content_size=True)

    def add(self, record: bytes) -> None:
        self.out.write(self.frames.compress(record))

    def __len__(self) -> int:
        return self.out.tell()


def _parse_headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"bad header line {line[:80]!r}")
        if name.lower() in fields:
            raise WarcError(f"header {name} is there twice")
        fields[name.lower()] = value.strip()
    return first, fields


def parse_record(data: bytes) -> dict:
    """A record's fields and payload; raises WarcError if headers, lengths or digests don't hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("no end of the headers")
    version, fields = _parse_headers(head)
    if not re.fullmatch(r"WARC/1\.[01]", version):
        raise WarcError(f"bad version line {version[:40]!r}")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"no {name}")
    if not re.fullmatch(r"[0-9]+", fields["content-length"]):
        raise WarcError("bad Content-Length")
    block, end = rest[: int(fields["content-length"])], rest[int(fields["content-length"]) :]
    if len(block) != int(fields["content-length"]) or end != b"\r\n\r\n":
        raise WarcError("the block doesn't have the length stated")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise WarcError("the block digest doesn't hold")
    out = {"type": fields["warc-type"], "fields": fields, "payload": None, "payload_bytes": None}
    if out["type"] in ("response", "revisit"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        status, http_fields = _parse_headers(http)
        if not gap or not status.startswith("HTTP/"):
            raise WarcError("no HTTP headers")
        out["payload_bytes"] = int(http_fields.get("content-length", len(payload)))
        if out["type"] == "response":
            if out["payload_bytes"] != len(payload):
                raise WarcError("the payload doesn't have the length stated")
            if fields.get("warc-payload-digest") != f"sha1:{sha1_base32(payload)}":
                raise WarcError("the payload digest doesn't hold")
            out["payload"] = payload
        elif payload or "warc-refers-to" not in fields or "warc-payload-digest" not in fields:
            raise WarcError("a revisit needs a digest and a record to refer to, and no payload")
    return out


def frame_length(view: memoryview, at: int) -> int:
    """Bytes of the frame at `at`. Its block headers say where each block ends, so nothing is decoded or copied."""
    def number(size: int) -> int:
        if at + length + size > len(view):
            raise WarcError(f"the frame at {at} is cut off")
        return int.from_bytes(view[at + length : at + length + size], "little")

    length = 0
    if number(4) & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
        length = 4
        length = 8 + number(4)
    else:
        head = bytes(view[at : at + 18])
        try:
            length, checksum = zstandard.frame_header_size(head), zstandard.get_frame_parameters(head).has_checksum
        except zstandard.ZstdError as error:
            raise WarcError(f"bad frame at {at}: {error}") from error
        last = False
        while not last:
            block = number(3)
            last = bool(block & 1)
            length += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run of one byte is kept as that byte
        length += 4 * checksum
    if at + length > len(view):
        raise WarcError(f"the frame at {at} is cut off")
    return length


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of an archive, one frame at a time, in time proportional to its bytes."""
    at, dictionary, view = 0, None, memoryview(data)
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        at = frame_length(view, 0)
        packed = data[8:at]
        if packed[:4] == struct.pack("<I", FRAME_MAGIC):
            try:
                packed = zstandard.ZstdDecompressor().decompress(packed, max_output_size=64 << 20)
            except zstandard.ZstdError as error:
                raise WarcError(f"bad dictionary: {error}") from error
        dictionary = _compression(packed)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        end = at + frame_length(view, at)
        if struct.unpack_from("<I", data, at)[0] & 0xFFFFFFF0 != SKIPPABLE_MAGIC:
            frame = decoder.decompressobj()
            try:
                record = frame.decompress(view[at:end])
            except zstandard.ZstdError as error:
                raise WarcError(f"bad frame at {at}: {error}") from error
            if not frame.eof:
                raise WarcError(f"the frame at {at} is cut off")
            yield parse_record(record)
        at = end


def _store(uri: str, name: str, data: bytes) -> str:
    """Write a hidden file under a name that no other attempt has; returns the name."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_output_stream(f"{path}/.{name}", compression=None) as out:  # by default it goes by the suffix
        out.write(data)
    return name


def _publish(uri: str):
    """Give the archives that count their names; to do so again changes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if fs.get_file_info(f"{path}/{name}").type == pafs.FileType.NotFound:
                    fs.move(f"{path}/.{name}", f"{path}/{name}")
            yield batch

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> tuple[str, DataFrame]:
    """Write a record a row into archives in a folder of their own; returns it, and (archive, records, bytes).

    Of rows with equal payloads the largest id is the response and the others are revisits of it. Payloads
    are equal if SHA-1, length and a second hash are. They are hashed in the scan; a key filter over what
    occurs twice tells there which rows are written at once. The others are judged without their payloads
    (`spread_join`), and revisits need none; only a repeated payload's one response travels, and what the
    second filter lets pass besides.

    Each task writes archives under hidden names of its own. When all are done those of finished attempts get
    their names, so what a lost attempt left behind is never read, and no list of archives is on the driver.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("body"))
    rows = rows.withColumns({"digest": F.sha1(F.encode("body", "UTF-8")), "size": F.octet_length("body").cast("long"), "mark": F.xxhash64("body")})
    same = ["digest", "size", "mark"]
    copies = rows.groupBy(*same).agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = materialise(copies, "copies")
    flagged = KeyFilter(copies.select(F.xxhash64(*same).alias("key")), "key").flag(rows, F.xxhash64(*same), "again")
    again = flagged.where("again").drop("again")
    placed = materialise(spread_join(again.select("id", "url", *same), copies, same, "n", "left"), "revisits")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    originals = placed.where(~revisit).select("id", *same).distinct()
    person = F.xxhash64("id", *same)
    wanted = KeyFilter(originals.select(person.alias("key")), "key").matching(again, person)
    there = originals.select(*(F.col(c).alias(f"__fw_{c}") for c in ("id", *same)))
    wanted = wanted.join(there, F.col("id").eqNullSafe(F.col("__fw_id")) & F.expr(" AND ".join(f"{c} = __fw_{c}" for c in same)), "left_semi")

    sample = [r.body.encode() for r in rows.select(F.substring("body", 1, SAMPLE_BYTES).alias("body")).limit(SAMPLE_ROWS).collect()]
    dictionary = pages.sparkSession.sparkContext.broadcast(train_dictionary(sample))
    to = scratch(pages.sparkSession, "warc")
    fs, path = pafs.FileSystem.from_uri(to)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, records = None, 0

        def close() -> pa.RecordBatch:
            name = _store(to, f"{uuid.uuid4().hex}.warc.zst", writer.out.getvalue())
            return pa.RecordBatch.from_pylist([{"archive": name, "records": records, "bytes": len(writer)}])

        for batch in slices(batches):
            for i, uri, body, size, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer = writer or ArchiveWriter(dictionary.value)
                writer.add(render(
                    f"urn:page:{'' if i is None else i}", "revisit" if body is None else "response", quote(uri, safe=":/?#[]@!$&'()*+,;=%~"),
                    None if body is None else body.encode(), f"urn:page:{first}", size, base32(bytes.fromhex(digest))))
                records += 1
                if len(writer) >= ARCHIVE_BYTES:
                    yield close()
                    writer, records = None, 0
        if records:
            yield close()

    none = F.lit(None).cast(pages.schema[id_col].dataType)
    responses = flagged.where("not again").drop("again").unionByName(wanted).select("id", "url", "body", "size", "digest", none.alias("first"))
    revisits = placed.where(revisit).select("id", "url", F.lit(None).cast("string").alias("body"), "size", "digest", "first")
    kind = "archive string, records long, bytes long"
    written = materialise(responses.unionByName(revisits).mapInArrow(run, kind), "written")
    return to, materialise(written.mapInArrow(_publish(to), kind), "archives")


def read_records(spark: SparkSession, uri: str, id_type, payloads: bool = True) -> DataFrame:
    """The records of the archives in a folder: id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    Spark lists and reads the files, so any store that it can open will do. The dictionary is loaded from
    the leading skippable frame, each frame is decoded by itself and its headers, lengths and digests are
    checked; a file that breaks the format fails the job with its name.
    """
    arrow_type = to_arrow_type(id_type)
    schema = f"id {id_type.simpleString()}, url string, record_type string, refers_to {id_type.simpleString()}, payload_bytes long, payload_digest string, payload binary"

    def number(urn: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?[0-9]*)>", urn)
        if not found:
            raise WarcError(f"not a record of this kind: {urn[:60]!r}")
        return int(found[1]) if found[1] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            types = [arrow_type, pa.string(), pa.string(), arrow_type, pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[tuple] = []
                try:
                    for record in read_archive(content.as_py()):
                        fields, kind = record["fields"], record["type"]
                        rows.append((
                            number(fields["warc-record-id"]), fields.get("warc-target-uri"), kind,
                            number(fields["warc-refers-to"]) if kind == "revisit" else None, record["payload_bytes"],
                            fields["warc-payload-digest"].removeprefix("sha1:"), record["payload"] if payloads else None))
                        if len(rows) == 500:
                            yield batch_of(rows)
                            rows = []
                except WarcError as error:
                    raise WarcError(f"{path}: {error}") from error
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(uri).select("path", "content")
    return files.mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", payloads: bool = True) -> DataFrame:
    """Write `pages` as archives, read them back: a row a page, with payload unless `payloads` is false.

    Nulls: a null html is an empty payload, a null url an empty one; a null id is written as such and
    counts below all others. Equal payloads of no bytes are copies like any. Rows that repeat id and
    payload are all responses if the id is the largest. A very long payload is one record and closes its
    archive; it has to fit in a worker's memory. Empty tables make no archive and give no rows. Columns besides
    the three are not looked at, whatever their names.
    """
    folder, _ = write_archives(pages, id_col, url, html)
    return read_records(pages.sparkSession, folder, pages.schema[id_col].dataType, payloads).withColumnRenamed("id", id_col)


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
 g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p),
 bits AS (
  SELECT page_id, html, first, list_transform(range(0, 32), lambda i:
    list_sum(list_transform(range(0, 5), lambda j:
      (strpos('0123456789abcdef', substr(hex, (i * 5 + j) // 4 + 1, 1)) - 1) // (8 >> ((i * 5 + j) % 4)::INT) % 2 * (16 >> j::INT)))) AS fives FROM g)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(fives, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits
"""
