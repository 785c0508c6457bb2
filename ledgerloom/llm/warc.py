"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame per record.

Writing: of records with equal payloads of at least ``least_bytes`` bytes the one with the largest id is the
response, the others become revisit records without a payload. The group's maximum is found by an aggregate, and a
page learns it by a join that spreads the pages of a frequent payload over many tasks. Each task packs its pages
into archives of bounded size, with a dictionary trained on a bounded sample of the first of them; an archive is a
row with the bytes of a ``.warc.zst`` file, so it can be kept in any store that Spark writes to.

Reading: a table with the bytes of archives in ``content``, as Spark's ``binaryFile`` source gives them. The
dictionary is loaded from the leading skippable frame (if there is one; stored plain or compressed), each frame is
decoded to one record, and version, headers, lengths and digest are validated.

Defined results: a null html is an empty payload, a null url is left out; a null id never names a group unless all
its ids are null; rows that share the largest id of a group are all responses; a record or frame that is not valid
is returned with what is wrong in ``problem``, and what follows an undecodable frame is given up; an empty table
gives no archive. Columns other than those named are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import frequent_keys, spread_join

# Fixed values of the formats: the dictionary's frame, frames that are skipped, and the zstandard magic number.
DICTIONARY_MAGIC, SKIPPABLE, ZSTD_MAGIC = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000
# Payload bytes of an archive, about; bytes and records that its dictionary is trained on, and its size.
ARCHIVE_BYTES = 8 << 20
SAMPLE_BYTES, SAMPLE_RECORDS, DICTIONARY_BYTES = 1 << 19, 400, 16 << 10
CHUNK = 1 << 14
ID = "urn:page:"

RECORD = (
    "record_type string, record_id string, url string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to string, problem string"
)


def with_revisits(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = REVISIT_BYTES
) -> DataFrame:
    """``(key, url, html, digest, first)``; ``first`` is the response's id for pages of a repeated payload."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    sized = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest")
    ).withColumn("repeatable", F.when(F.octet_length("payload") >= least_bytes, F.col("digest")))
    digests = sized.select("key", "repeatable").where("repeatable IS NOT NULL")
    groups = (
        digests.groupBy("repeatable")
        .agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("repeatable", "first")
    )
    joined = spread_join(sized, groups, "repeatable", frequent_keys(digests, "repeatable"), ["key"])
    return joined.select("key", "url", "payload", "digest", "first")


# Writing


def record(key: object, url: str | None, payload: bytes, digest: str, first: object, date: str) -> bytes:
    """One record: a response with its payload, or a revisit with the response's HTTP header only."""
    revisit = first is not None and first != key
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID}{'' if key is None else key}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        headers.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    headers.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        headers += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{first}>"]
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the beginnings of some records; empty if they are too few or too alike."""
    some = records[:: max(1, len(records) // SAMPLE_RECORDS)]
    each = SAMPLE_BYTES // max(1, len(some))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r[:each] for r in some]).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes]) -> bytes:
    trained = dictionary(records)
    parts = []
    if trained:
        packed = zstandard.ZstdCompressor().compress(trained)
        parts.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
    using = zstandard.ZstdCompressionDict(trained) if trained else None
    compressor = zstandard.ZstdCompressor(level=3, dict_data=using, write_checksum=True)
    return b"".join([*parts, *map(compressor.compress, records)])


def write_archives(pages: DataFrame, date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``(records, content)``: one row per archive, from the rows of :func:`with_revisits`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(records: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([len(records)], pa.int64()), pa.array([archive(records)], pa.binary())], ["records", "content"]
            )

        held: list[bytes] = []
        size = 0
        for batch in batches:
            for columns in zip(*batch.columns, strict=True):
                held.append(record(*(c.as_py() for c in columns), date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield row(held)
                    held, size = [], 0
        if held:
            yield row(held)

    return pages.select("key", "url", "payload", "digest", "first").mapInArrow(run, "records bigint, content binary")


# Reading


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, one by one; raises ``ValueError`` where one can't be decoded."""
    view, at, using = memoryview(content), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_MAGIC:
        (size,) = struct.unpack_from("<I", view, 4)
        stored = bytes(view[8 : 8 + size])
        if len(stored) < size:
            raise ValueError("cut dictionary")
        if struct.unpack_from("<I", stored.ljust(4, b"\0"))[0] == ZSTD_MAGIC:
            stored = zstandard.ZstdDecompressor().decompressobj().decompress(stored)
        using, at = zstandard.ZstdCompressionDict(stored), 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=using)
    while at < len(view):
        if len(view) - at >= 8 and struct.unpack_from("<I", view, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        frame, parts = decompressor.decompressobj(), []
        # In small steps, as what follows the frame is handed back as a copy.
        while not frame.eof and at < len(view):
            step = view[at : at + CHUNK]
            try:
                parts.append(frame.decompress(step))
            except zstandard.ZstdError as error:
                raise ValueError(f"bad frame: {error}") from error
            at += len(step)
        if not frame.eof:
            raise ValueError("cut frame")
        at -= len(frame.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple:
    """The fields of :data:`RECORD` of one decoded frame."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    try:
        version, *lines = head.decode("utf-8").split("\r\n")
        headers = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines)}
        if not mark or version != VERSION or any(":" not in x for x in lines):
            raise ValueError("bad header")
        kind, length = headers["warc-type"], int(headers["content-length"])
        if len(rest) != length + 4 or not rest.endswith(b"\r\n\r\n"):
            raise ValueError("bad length")
        http, mark, payload = rest[:length].partition(b"\r\n\r\n")
        status, *lines = http.decode("latin-1").split("\r\n")
        fields = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        if not mark or not status.startswith("HTTP/") or len(payload) != (0 if kind == "revisit" else size):
            raise ValueError("bad payload length")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        if kind != "revisit" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("bad digest")
    except (KeyError, ValueError) as error:
        return None, None, None, None, None, None, None, f"{type(error).__name__}: {error}"
    url = headers.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return (
        kind,
        headers.get("warc-record-id", "").strip("<>"),
        url,
        None if kind == "revisit" else payload,
        size,
        digest,
        headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
        None,
    )


def read_archives(archives: DataFrame, content: str = "content", payloads: bool = True) -> DataFrame:
    """One row of :data:`RECORD` per record; ``payloads=False`` validates the payloads but leaves them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for bytes_ in batch.column(0):
                rows, size = [], 0
                try:
                    for frame in frames(bytes_.as_py() or b""):
                        row = parse(frame)
                        rows.append(row if payloads else (*row[:3], None, *row[4:]))
                        size += len(frame) if payloads else 0
                        if size > ARCHIVE_BYTES or len(rows) >= 10_000:
                            yield table(rows)
                            rows, size = [], 0
                except (ValueError, zstandard.ZstdError) as error:
                    rows.append((None,) * 7 + (str(error),))
                if rows:
                    yield table(rows)

    return archives.select(content).mapInArrow(run, RECORD)
