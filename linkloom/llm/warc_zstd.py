"""WARC archives compressed with Zstandard: one frame a record, a dictionary in front."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.words import sliced

# Fixed values of the formats: magic numbers of a data frame and of the dictionary's frame.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

#: Payload bytes of an archive, and of the payloads that a dictionary is trained on.
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES, DICTIONARY_ROWS, DICTIONARY_TEXT = 64 << 10, 256, 64 << 10
#: Payloads below this many bytes never become revisits.
LEAST_REVISIT = 100


class BadRecord(ValueError):
    """What is wrong with a frame or the record in it."""


# --- writing ---------------------------------------------------------------------


def _header_value(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """The bytes of a response, or of a revisit when ``refers_to`` is given.

    The block holds the HTTP headers, and the payload unless it is a revisit.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to is not None else payload)
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def trained_dictionary(pages: DataFrame, html: str = "html") -> bytes:
    """A compression dictionary from a few whole payloads, those with the smallest hash.

    At most ``DICTIONARY_ROWS`` payloads of ``DICTIONARY_TEXT`` characters at most reach the
    driver. Empty when there is too little to learn from.
    """
    fit = (F.length(html) > 0) & (F.length(html) <= DICTIONARY_TEXT)
    rows = pages.where(fit).select(F.xxhash64(html).alias("h"), F.col(html).alias("t"))
    # Hashes first, so that no task returns more texts than are chosen in all; copies count once.
    hashes = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(DICTIONARY_ROWS).collect()]
    chosen = rows.where(F.col("h").isin(hashes)).groupBy("h").agg(F.min("t").alias("t"))
    samples = [r["t"].encode() for r in chosen.orderBy("h").collect()] if hashes else []
    if len(samples) < 8 or sum(map(len, samples)) < 16 << 10:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _digest() -> Column:
    return F.sha2(F.coalesce("html", F.lit("")), 256)


def _refers_to(pages: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to``: payloads of a page that an earlier page has, and that page."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select("page_id", _digest().alias("digest"), size.alias("n"))
    rows = rows.where((F.col("n") >= LEAST_REVISIT) & F.col("page_id").isNotNull())
    first = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    repeated = rows.join(first.where("copies > 1"), "digest").where("page_id > refers_to")
    return repeated.select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame) -> DataFrame:
    """``archive, content``: archives that hold a record for each row of ``page_id, url, html``.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes the smallest ``page_id`` is the
    response, larger ones are revisits; rows that repeat that id are responses too,
    as are rows without an id. A NULL html is an empty payload, a NULL URL no target.
    Each ``content`` is the bytes of one ``.warc.zst`` file of bounded size.
    """
    pages = pages.select("page_id", "url", "html")
    shared = pages.sparkSession.sparkContext.broadcast(trained_dictionary(pages))
    # A page's id may come with several payloads, so the digest decides as well.
    rows = pages.withColumn("digest", _digest()).join(_refers_to(pages), ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, front = None, b""
        if shared.value:
            dictionary = zstandard.ZstdCompressionDict(shared.value)
            front = DICTIONARY_MAGIC + struct.pack("<I", len(shared.value)) + shared.value
        compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        for batch in sliced(batches, "html", ARCHIVE_BYTES):
            parts = [front]
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
            for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
                payload = (html or "").encode()
                parts.append(compressor.compress(record(page_id, url, payload, digest, refers_to)))
            content = b"".join(parts)
            name = hashlib.sha256(content).hexdigest()[:32] + ".warc.zst"
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content])], ["archive", "content"])

    return rows.mapInArrow(run, "archive string, content binary")


# --- reading ---------------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> int:
    """Where the data frame that starts at ``at`` ends, from its block headers."""
    if bytes(data[at : at + 4]) != FRAME_MAGIC:
        raise BadRecord("no frame")
    if at + 5 > len(data):
        raise BadRecord("frame cut off")
    flags = data[at + 4]
    single, content_size = flags >> 5 & 1, flags >> 6
    size = 1 - single + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[content_size]
    end = at + 5 + size
    while True:
        if end + 3 > len(data):
            raise BadRecord("frame cut off")
        head = data[end] | data[end + 1] << 8 | data[end + 2] << 16
        # A repeated byte takes one, whatever its block's length.
        end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    end += 4 * (flags >> 2 & 1)
    if end > len(data):
        raise BadRecord("frame cut off")
    return end


def parsed(raw: bytes) -> dict:
    """Headers and block of a record, checked against one another."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadRecord("no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadRecord("malformed header line")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadRecord(f"no {name}")
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit():
        raise BadRecord("content-length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadRecord("content-length does not fit the record")
    return {"headers": headers, "block": rest[:length]}


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value.removeprefix("-").isascii() and value.removeprefix("-").isdigit() else None


def page_record(raw: bytes) -> dict:
    """The fields of a page's record; payload length and digest are checked."""
    got = parsed(raw)
    headers = got["headers"]
    http, gap, payload = got["block"].partition(b"\r\n\r\n")
    size = None
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            size = int(value)
    if not gap or size is None:
        raise BadRecord("no HTTP header")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = headers["warc-type"]
    if kind == "response":
        if len(payload) != size:
            raise BadRecord("payload length does not fit")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise BadRecord("payload digest does not fit")
    elif kind != "revisit" or payload or _page(headers.get("warc-refers-to")) is None:
        raise BadRecord("neither a response nor a whole revisit")
    return {
        "page_id": _page(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page(headers.get("warc-refers-to")) if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
        "error": None,
    }


def records(content: bytes) -> Iterator[dict]:
    """Every record of an archive in turn.

    A frame that can't be decoded, or whose record is malformed, gives one row with
    ``error``; reading goes on at the next frame.
    """
    data, at, dictionary = memoryview(content), 0, None
    if content[:4] == DICTIONARY_MAGIC and len(content) >= 8:
        size = struct.unpack("<I", content[4:8])[0]
        raw = content[8 : 8 + size]
        if len(raw) < size:
            yield {"error": "dictionary cut off", "offset": 0}
            return
        if raw[:4] == FRAME_MAGIC:  # a dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        start = at
        try:
            at = frame_end(data, start)
            try:
                raw = reader.decompressobj().decompress(data[start:at])
            except zstandard.ZstdError as error:
                raise BadRecord(f"frame can't be decoded: {error}") from None
            yield page_record(raw) | {"offset": start}
        except BadRecord as error:
            yield {"error": str(error), "offset": start}
            if at == start:
                at = content.find(FRAME_MAGIC, start + 1)
                if at < 0:
                    return


RECORD = (
    "offset long, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)


def read_archives(archives: DataFrame, *, content: str = "content", payloads: bool = True) -> DataFrame:
    """A row per record of the archives in a binary column, such as ``spark.read.format("binaryFile")`` gives.

    NULL and empty archives have no records. Without ``payloads`` these are checked and dropped.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def emitted(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                rows, held = [], 0
                for row in records(value.as_py() or b""):
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 200
                    if held > ARCHIVE_BYTES:
                        yield emitted(rows)
                        rows, held = [], 0
                if rows:
                    yield emitted(rows)

    return archives.select(content).mapInArrow(run, RECORD)
