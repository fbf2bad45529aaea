"""WARC archives with segmented records, written and reassembled.

Writing: each page is an HTTP response with chunked transfer framing. A block over
SEGMENT bytes is cut into a first record and `continuation` records that name it
in WARC-Segment-Origin-ID and count up in WARC-Segment-Number; the last one holds
WARC-Segment-Total-Length. Of pages with one payload only that with the largest
page_id is stored whole, the others are `revisit` records that refer to it.

Reading: the records of all files are parsed, continuations are grouped by their
origin, ordered by number and joined, the total length is verified, the chunked
framing is decoded, and the payload's digest is verified against the header.

Files are written by Spark's text writer (a record per row, the record separator
as line separator, gzip) and read by its binary reader, so any file system that
Spark knows will do, and a lost task is simply run again.

Defined results: a null html is an empty payload; rows with one page_id are
records of their own; an empty table gives no rows; further columns of the input
are ignored. A record whose segments are not complete, whose length or whose
digest is wrong gets `error` instead of a payload when it is read. So does what is
no record, or is cut off: reading goes on at the next line that begins a record.
Files may be one gzip stream or one for each record; they are inflated and parsed
in parts, so that beside a file's compressed bytes one record is held.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, written

SEGMENT = 16 << 10
CHUNK = 4 << 10
#: Bytes of payload in one archive file, about.
FILE_BYTES = 16 << 20
#: Bytes that are inflated at a time, and that a record's header may have.
PART, HEADER = 1 << 20, 1 << 20
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def urn(uid: str) -> str:
    h = hashlib.md5(uid.encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def pieces(text: str, most: int) -> Iterator[str]:
    """text in pieces of at most `most` UTF-8 bytes, cut between code points."""
    raw, a = text.encode(), 0
    while a < len(raw):
        b = min(a + most, len(raw))
        while b < len(raw) and b > a and raw[b] & 0xC0 == 0x80:
            b -= 1
        yield raw[a:b].decode()
        a = b


def chunked(text: str, most: int = CHUNK) -> str:
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in pieces(text, most)) + "0\r\n\r\n"


def dechunked(raw: bytes) -> bytes:
    out, at = [], 0
    while True:
        eol = raw.index(b"\r\n", at)
        n = int(raw[at:eol].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        if raw[eol + 2 + n : eol + 4 + n] != b"\r\n":
            raise ValueError("chunk length")
        out.append(raw[eol + 2 : eol + 2 + n])
        at = eol + 4 + n


def record(head: list[tuple[str, str]], block: str) -> str:
    lines = [f"{k}: {v}" for k, v in head if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block.encode())}"]) + END + block


def records_of(uid: str, page_id, url: str, digest: str, html: str | None, refers: str | None, segment: int) -> list[str]:
    """The records of one page: a revisit, or a response with its continuations."""
    page = None if page_id is None else str(page_id)
    url = None if url is None else "".join(c for c in url if c >= " ")
    head = [("WARC-Record-ID", urn(uid)), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page)]
    if refers is not None:
        return [record([("WARC-Type", "revisit"), *head, ("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(refers))], "HTTP/1.1 200 OK" + END)]
    block = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END + chunked(html or "")
    parts = list(pieces(block, segment))
    if len(parts) == 1:
        return [record([("WARC-Type", "response"), *head], block)]
    out = [record([("WARC-Type", "response"), *head, ("WARC-Segment-Number", "1")], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        last = str(len(block.encode())) if k == len(parts) else None
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", urn(f"{uid}/{k}")), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", urn(uid)), ("WARC-Segment-Number", str(k)), ("WARC-Segment-Total-Length", last)], part))
    return out


def write_archives(pages: DataFrame, path: str, min_revisit: int = 0, segment: int = SEGMENT, file_bytes: int = FILE_BYTES) -> None:
    """Writes all pages as .gz archives under path. Payloads of fewer than min_revisit bytes are never revisits.

    Digests and row ids are written to a table first, so an id is one row's whatever becomes of a task. Rows meet by digest in
    that table only, with partial aggregation first. The html is shuffled once, by page and digest, to as many partitions
    as there are to be files; rows that are equal in both have equal html, so any of them serves.
    """
    slim = written(pages.select("page_id", "url", F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"), F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"), F.monotonically_increasing_id().alias("uid")), "digests")
    owner = slim.groupBy("digest").agg(F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "uid")).alias("owner"), F.max("size").alias("size"))
    owner = owner.where(F.col("size") >= min_revisit).select("digest", F.col("owner.uid").alias("owner"))
    linked = written(slim.join(owner, "digest", "left").select("page_id", "url", "uid", "digest", "size", F.when(F.col("owner") != F.col("uid"), F.col("owner")).alias("refers")), "linked")
    discard(slim)
    total = linked.where("refers is null").agg(F.sum("size")).first()[0] or 0
    files = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), "digest").alias("key")
    own = F.struct("uid", "url")
    wanted = linked.where("refers is null").select("page_id", "digest", key, own.alias("own")).groupBy("key", "page_id", "digest").agg(F.collect_list("own").alias("own"))
    html = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary"))).select(key, "html")
    stored = wanted.repartition(files, "key").join(html.repartition(files, "key"), "key").sortWithinPartitions("key")
    again = linked.where("refers is not null").select(F.lit(None).cast("string").alias("key"), "page_id", "digest", F.array(own).alias("own"), F.lit(None).cast("string").alias("html"), "refers")
    ready = stored.withColumn("refers", F.lit(None).cast("long")).unionByName(again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out, held = [], 0
            for k, r in enumerate(batch.select(["key", "page_id", "digest", "own", "refers"]).to_pylist()):
                if r["key"] is not None and r["key"] == last:
                    continue  # html of a page that is written already
                last = r["key"]
                text, digest = batch.column("html")[k].as_py(), base64.b32encode(bytes.fromhex(r["digest"])).decode()
                for one in r["own"]:
                    out += records_of(str(one["uid"]), r["page_id"], one["url"], digest, text, None if r["refers"] is None else str(r["refers"]), segment)
                    held += len(text or "")
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    ready.mapInArrow(run, "value string").write.mode("overwrite").option("lineSep", END).option("compression", "gzip").text(path)
    discard(linked)


class Damaged(ValueError):
    """A gzip file that ends early or is not one."""


def inflated(content, part: int = PART) -> Iterator[bytes]:
    """All members of a gzip file, in parts of bounded size; Damaged at the first fault."""
    left = memoryview(content)
    while len(left):
        stream, rest = zlib.decompressobj(31), b""
        while not stream.eof:
            if not rest and not len(left):
                raise Damaged
            if not rest:
                rest, left = left[:part], left[part:]
            try:
                out = stream.decompress(rest, part)
            except zlib.error:
                raise Damaged from None
            rest = stream.unconsumed_tail
            if out:
                yield out
        back = len(stream.unused_data)
        at = len(content) - len(left) - back
        while at < len(content) and content[at] == 0:
            at += 1
        left = memoryview(content)[at:]


class Window:
    """The part of a stream that is being read."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.held, self.at, self.is_open, self.is_sound = iter(parts), b"", 0, True, True

    def fill(self, n: int) -> bool:
        """Holds n bytes from here on, if there are as many."""
        size = len(self.held) - self.at
        if size >= n:
            return True
        found = [self.held[self.at :]]
        while size < n and self.is_open:
            try:
                found.append(next(self.parts))
                size += len(found[-1])
            except StopIteration:
                self.is_open = False
            except Damaged:
                self.is_open = self.is_sound = False
        self.held, self.at = b"".join(found), 0
        return size >= n

    def find(self, what: bytes, most: int) -> int:
        """Where `what` begins, as far from here as given; -1 if it doesn't within `most` bytes."""
        while True:
            found = self.held.find(what, self.at, self.at + most)
            if found >= 0:
                return found - self.at
            size = len(self.held) - self.at
            if size >= most or not self.is_open:
                return -1
            self.fill(min(most, size + PART))

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out


_BEGIN = re.compile(rb"\r\nWARC/\d")


def parse(stream: Window) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers, block and error of each record of an archive. What is held is a record's block, or a header of at most HEADER bytes."""
    while stream.fill(1):
        if stream.fill(2) and stream.held[stream.at : stream.at + 2] == b"\r\n":
            stream.at += 2
            continue
        end = stream.find(b"\r\n\r\n", HEADER)
        lines = stream.held[stream.at : stream.at + max(0, end)].split(b"\r\n")
        head = {k.strip().decode("utf-8", "replace").lower(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines[1:])}
        size = head.get("content-length", "")
        if end < 0 or not lines[0].startswith(b"WARC/") or not (size.isascii() and size.isdigit()) or not {"warc-type", "warc-record-id"} <= head.keys():
            yield head, b"", "no record"
            stream.at += 1
            while stream.fill(8):  # on to the next line that begins a record
                following = _BEGIN.search(stream.held, stream.at)
                stream.at = following.start() if following else len(stream.held) - 7
                if following:
                    break
            else:
                stream.at = len(stream.held)
            continue
        stream.at += end + 4
        block = stream.take(int(size))
        yield head, block, None if len(block) == int(size) else "block cut off"


RECORDS = "type string, id string, page_id long, url string, digest string, refers_to string, origin string, number int, total long, segmented boolean, block binary, error string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row of RECORDS for each record in the files under path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.string()]
    names = [f.split()[0] for f in RECORDS.split(", ")]
    number = lambda x: int(x) if x and x.isascii() and x.isdigit() and len(x) < 10 else None

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def row(head: dict[str, str], block: bytes, error: str | None) -> tuple:
        own, page = head.get("warc-record-id"), head.get("x-page-id")
        digest, place = head.get("warc-payload-digest"), head.get("warc-segment-number")
        page_id = int(page) if page and re.fullmatch(r"-?[0-9]{1,19}", page) and -(1 << 63) <= int(page) < 1 << 63 else None
        return (
            head.get("warc-type"), own, page_id, head.get("warc-target-uri"), digest and digest.partition(":")[2], head.get("warc-refers-to"), head.get("warc-segment-origin-id", own),
            number(place) if place is not None else 1, number(head.get("warc-segment-total-length")), place is not None and error is None, block, error,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                stream, rows, held = Window(inflated(content.as_buffer())), [], 0
                for head, block, error in parse(stream):
                    rows.append(row(head, block, error))
                    held += len(block)
                    if held > 4 << 20:
                        yield pack(rows)
                        rows, held = [], 0
                if not stream.is_sound:
                    rows.append(row({}, b"", "damaged file"))
                yield pack(rows)

    return files.mapInArrow(run, RECORDS)


WHOLE = "type string, id string, page_id long, url string, digest string, refers_to string, error string, payload binary"


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records, a row of WHOLE each: payload is null for revisits, error is null if all is well.

    Only segmented records are shuffled; a group is one HTTP response, whatever else is in the input. Its blocks are joined once, in the worker.
    """
    fields = ["type", "id", "page_id", "url", "digest", "refers_to", "error"]
    whole = records.where(~F.col("segmented")).select(*fields, F.array("block").alias("blocks"), F.lit(None).cast("long").alias("total"))
    parts = records.where("segmented").groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("number", "total", "type", "id", "page_id", "url", "digest", "block"))).alias("parts"))
    first, last = F.col("parts")[0], F.element_at("parts", -1)
    complete = (first["type"] == "response") & (first["number"] == 1) & (last["number"] == F.size("parts")) & last["total"].isNotNull()
    parts = parts.select(
        F.coalesce(first["type"], F.lit("response")).alias("type"), F.col("origin").alias("id"), first["page_id"].alias("page_id"), first["url"].alias("url"), first["digest"].alias("digest"), F.lit(None).cast("string").alias("refers_to"),
        F.when(~F.coalesce(complete, F.lit(False)), "segments missing").alias("error"), F.transform("parts", lambda p: p["block"]).alias("blocks"), last["total"].alias("total"),
    )

    def decoded(blocks: list[bytes], total: int | None, digest: str | None) -> tuple[bytes | None, str | None]:
        block = blocks[0] if len(blocks) == 1 else b"".join(blocks)
        if total is not None and len(block) != total:
            return None, "total length"
        head, _, body = block.partition(b"\r\n\r\n")
        try:
            payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
        except ValueError:
            return None, "chunked framing"
        return (payload, None) if base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest else (None, "payload digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, errors = [], batch.column("error").to_pylist()
            for k, (kind, total, digest) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("type", "total", "digest")), strict=True)):
                payload = None
                if kind == "response" and errors[k] is None:
                    payload, errors[k] = decoded(batch.column("blocks")[k].as_py(), total, digest)
                payloads.append(payload)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields[:-1]), pa.array(errors, pa.string()), pa.array(payloads, pa.binary())], [*fields, "payload"])

    return whole.unionByName(parts).mapInArrow(run, WHOLE)


def summary(whole: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, error: a revisit's size is that of the record it refers to.

    The records' sizes are written to a table, so the payloads are decoded once.
    """
    slim = written(whole.select("type", "id", "page_id", "digest", "refers_to", "error", F.octet_length("payload").cast("long").alias("payload_bytes")), "sizes")
    stored = slim.where("type is null or type <> 'revisit'").select("page_id", F.col("id").alias("at"), "digest", "payload_bytes", "error")
    revisits = slim.where("type = 'revisit'").select("page_id", "digest", F.col("refers_to").alias("at"), F.col("error").alias("own"))
    target = stored.select("at", F.col("page_id").alias("refers_to"), "payload_bytes", F.when(F.col("error").isNotNull(), F.concat(F.lit("refers to: "), "error")).alias("error"))
    far = revisits.join(target, "at", "left").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to", F.coalesce("own", "error").alias("error"))
    return stored.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "error").unionByName(far)
