"""WARC archives: written from pages, revisits resolved by payload digest, written anew and read back.

*Archives.* A record is its headers, an HTTP head, and the payload, in a gzip member of its own. Tasks join members to
chunks of about ``FILE_BYTES`` of records; each chunk is a file of Spark's text writer, so archives may lie in any store that
Spark reaches. Bytes pass as they are, so payloads may hold anything; the writer's line end behind a file is one zero byte, which gzip
takes for padding.

*Reading.* Archives come as binary files, packed or plain, and are cut by Content-Length; header names match in any case. Records of
other types than response and revisit are passed over, and a response need not be HTTP. A file is one row, so it has to fit into a task's memory.

*Resolution.* Archives are parsed once, into a written table of headers and packed payloads. Only headers move: by payload digest, with
map-side minima, the record with the smallest page id among equal payloads of ``LEAST_BYTES`` or more becomes the response, and all others
refer to it. A revisit already in the input is joined to the response of the digest it declares, of whichever kind. Revisits meet the payloads by
record id (sent to all tasks while they are few bytes, else by a shuffle), and deduplicated archives are written with fresh headers: revisits
name the record, address and date that they refer to, keep digest and length of the full payload, and hold no payload.

Defined results: a null payload is empty; small payloads are all responses; equal page ids are ordered by record id, null
ids last; repeated rows get a record each; line breaks in a URL are written in percent form; a revisit without its response in the
archives stays as it is, and refers to no page; a record without an id gets one from its headers; no pages, no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotloom.session import broadcast_if_small, stage

FILE_BYTES = 8 << 20
LEAST_BYTES = 100
# Levels of gzip in archives and of zstd in the parsed table.
LEVEL, PARSED_LEVEL = 5, 5
# Bytes of an archive that are unpacked at a time; of a member's last piece, what follows is copied.
STEP = 1 << 14
# Fixed values of the format.
VERSION = b"WARC/1.0"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
TYPE, RECORD_ID, TARGET, WHEN, DIGEST, REFERS, LENGTH, CONTENT = (
    "WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest", "WARC-Refers-To", "Content-Length", "Content-Type")
REFERS_TARGET, REFERS_DATE = "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date"
PAGE, FULL = "X-Page-ID", "X-Full-Payload-Length"

# ``declared`` is the digest as its header gives it, with the name of its kind in lower case; ``payload_digest`` is SHA-256 of what is there.
HEADERS = ("page_id long, record_id string, record_type string, url string, date string, payload_digest string, declared string, payload_bytes long, "
           "refers_to_id string")


def _line(text: str | None) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", text or "")


def record(
    page_id, record_id: str, kind: str, url: str | None, payload: bytes, declared: str, size: int, refers_to: str | None, date: str,
    refers_url: str | None = None, refers_date: str | None = None,
) -> bytes:
    """One record with the line ends behind it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if kind == "response" else b"")
    head = [(TYPE, kind), (RECORD_ID, f"<{record_id}>"), (TARGET, _line(url)), (WHEN, date), (DIGEST, declared), (FULL, size)]
    if page_id is not None:
        head.append((PAGE, page_id))
    if refers_to:
        head += [(REFERS, f"<{refers_to}>"), ("WARC-Profile", PROFILE)]
        head += [(name, _line(value)) for name, value in ((REFERS_TARGET, refers_url), (REFERS_DATE, refers_date)) if value]
    head += [(CONTENT, "application/http; msgtype=response"), (LENGTH, len(block))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes):
    """(headers by lower-case name, block) of each record of an archive's bytes."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            if data[at:].strip(b"\r\n\x00"):
                raise ValueError(f"no record at byte {at}")
            return
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        begin = end + 4
        stop = begin + int(head[LENGTH.lower()])
        yield head, data[begin:stop]
        at = stop
        while data.startswith(b"\r\n", at):
            at += 2


def unpack(data: bytes) -> bytes:
    """The bytes of all gzip members; zeros between and behind them are padding. Takes time by their bytes, however many members there are."""
    view, out, at = memoryview(data), [], 0
    while at < len(data):
        if not data[at]:
            at += 1
            continue
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(data):
                raise EOFError("an archive ends within a gzip member")
            piece = view[at:at + STEP]
            out.append(member.decompress(piece))
            at += len(piece)
        at -= len(member.unused_data)
    return b"".join(out)


def _entry(head: dict[str, str], block: bytes) -> tuple[tuple, bytes] | None:
    """A record's columns of ``HEADERS`` and its payload; None for types other than response and revisit."""
    get = lambda name: head.get(name.lower())
    kind = (get(TYPE) or "").lower()
    if kind not in ("response", "revisit"):
        return None
    cut = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
    payload = block[cut + 4:] if cut >= 0 else block
    declared = get(DIGEST) or ""
    algorithm, _, value = declared.partition(":")
    declared = f"{algorithm.lower()}:{value}" if value else ""
    if kind == "response":
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
        declared = declared or f"sha256:{digest}"
    else:
        digest = declared.removeprefix("sha256:")
        told = re.search(rb"(?im)^content-length:\s*(\d+)", block[:cut + 2]) if cut >= 0 else None
        size = int(get(FULL) or (told[1] if told else 0))
        payload = b""
    name = lambda x: x.strip("<>") if x else None
    own = name(get(RECORD_ID)) or f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(sorted(head.items())))}"
    page = get(PAGE)
    return (int(page) if page else None, own, kind, get(TARGET), get(WHEN), digest, declared, size, name(get(REFERS))), payload


def _chunks(records):
    """Records, each a gzip member, joined to files of about FILE_BYTES of records."""
    held, size = [], 0
    for r in records:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        held.append(packer.compress(r) + packer.flush())
        size += len(r)
        if size >= FILE_BYTES:
            yield b"".join(held)
            held, size = [], 0
    if held:
        yield b"".join(held)


def _write(chunks: DataFrame, folder: str) -> None:
    # the cast leaves the bytes as they are
    chunks.select(F.col("value").cast("string")).write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(folder)


def _batches(records):
    for chunk in _chunks(records):
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.binary())], ["value"])


def write_pages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """A response record per page; a payload may be a string or binary."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def build(batches):
        def records():
            for batch in batches:
                for page, where, body in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "body"))):
                    body = body or b""
                    declared = f"sha256:{hashlib.sha256(body).hexdigest()}"
                    yield record(page, f"urn:uuid:{uuid.uuid4()}", "response", where, body, declared, len(body), None, date)
        yield from _batches(records())

    _write(pages.select(
        F.col(f"`{key}`").cast("long").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{payload}`").cast("binary").alias("body"),
    ).mapInArrow(build, "value binary"), folder)


def read(spark: SparkSession, folder: str, payloads: bool = False, files: str = "part-*") -> DataFrame:
    """The response and revisit records of archives: ``HEADERS``, and the zstd payload if asked for."""
    kinds = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in HEADERS.split(", ")] + [pa.binary()] * payloads
    names = [x.split()[0] for x in HEADERS.split(", ")] + ["payload"] * payloads

    def rows(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=PARSED_LEVEL)
        for batch in batches:
            for data in batch.column("content"):
                raw = data.as_py()
                out = []
                for head, block in parse(unpack(raw) if raw.startswith(b"\x1f\x8b") else raw):
                    found = _entry(head, block)
                    if found:
                        out.append((*found[0], *([press.compress(found[1])] if payloads else [])))
                columns = zip(*out) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names)

    found = spark.read.format("binaryFile").option("pathGlobFilter", files).load(folder).select("content")
    return found.mapInArrow(rows, HEADERS + ", payload binary" * payloads)


def resolve(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """What changes: (record_id, first_id, first_url, first_date) of each record that is to refer to another, from headers alone.

    Only records with a payload of ``least`` bytes or more, and only digests that several records have, take part.
    """
    large = headers.where(F.col("payload_bytes") >= least)
    own = F.concat(F.lit("sha256:"), "payload_digest")
    is_response = F.col("record_type") == "response"
    digests = F.when(is_response, F.array_distinct(F.array(own, "declared"))).otherwise(F.array("declared"))
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id", "url", "date")
    first = large.select(F.explode(digests).alias("digest"), F.when(is_response, order).alias("response")).groupBy("digest").agg(
        F.min("response").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select(
        "digest", F.col("first.record_id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.date").alias("first_date"))
    joined = large.select("record_id", F.when(is_response, own).otherwise(F.col("declared")).alias("digest")).join(
        broadcast_if_small(stage(first, "firsts"), "first_url"), "digest")
    return joined.where("first_id <> record_id").drop("digest")


def write_resolved(spark: SparkSession, source: str, folder: str, least: int = LEAST_BYTES, files: str = "part-*") -> None:
    """The archives of ``source`` without payloads that another record holds."""
    def build(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor()

        def records():
            for batch in batches:
                for r in batch.to_pylist():
                    refers = r["first_id"] or r["refers_to_id"]
                    kind = "revisit" if r["first_id"] else r["record_type"]
                    body = open_.decompress(r["payload"]) if kind == "response" else b""
                    declared = f"sha256:{r['payload_digest']}" if r["record_type"] == "response" else r["declared"]
                    yield record(r["page_id"], r["record_id"], kind, r["url"], body, declared, r["payload_bytes"], refers, r["date"] or "",
                                 r["first_url"], r["first_date"])
        yield from _batches(records())

    parsed = stage(read(spark, source, payloads=True, files=files), "records")
    revisits = stage(resolve(parsed.drop("payload"), least), "revisits")
    _write(parsed.join(broadcast_if_small(revisits, "first_url"), "record_id", "left").mapInArrow(build, "value binary"), folder)


def report(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of resolved archives: page_id, payload_bytes, payload_digest, record_type, refers_to (a page id)."""
    records = stage(read(spark, folder), "headers")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    alone, revisits = (records.where(F.col("refers_to_id").isNull() == gone) for gone in (True, False))
    wanted = revisits.select(F.col("refers_to_id").alias("record_id")).distinct()
    pages = records.select("record_id", F.col("page_id").alias("refers_to")).join(broadcast_if_small(stage(wanted, "wanted"), "record_id"), "record_id")
    named = revisits.join(broadcast_if_small(stage(pages, "pages").withColumnRenamed("record_id", "refers_to_id"), "refers_to_id"), "refers_to_id", "left")
    return alone.select(*names, F.lit(None).cast("long").alias("refers_to")).unionByName(named.select(*names, "refers_to"))
