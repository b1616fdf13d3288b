"""WARC archives: writing with segments, chunked framing and revisits; reading them back whole."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Payloads shorter than this are always stored.
LEAST_REVISIT = 1000
#: Bytes of a record's block; what is longer goes on in continuation records.
SEGMENT = 16 << 10
#: Bytes of a chunk of the transfer framing.
CHUNK = 4 << 10
#: Bytes of an archive that are decompressed at a time, rows that are framed or read at a time, and records of a batch that leaves.
READ, ROWS, OUT_ROWS = 1 << 20, 250, 2000
#: Bytes of records an archive file should hold.
ARCHIVE = 16 << 20
#: All records' date: archives depend on their pages only.
DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def cuts(data: bytes, size: int) -> list[int]:
    """Where data is cut into parts of about `size` bytes, never within a UTF-8 character."""
    at = [0]
    while len(data) - at[-1] > size:
        end = at[-1] + size
        while data[end] & 0xC0 == 0x80 and end > at[-1] + size - 4:
            end -= 1
        at.append(end)
    return [*at, len(data)]


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing of a payload."""
    at = cuts(payload, size)
    parts = [payload[a:b] for a, b in zip(at, at[1:]) if a < b]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing: extensions and trailers are skipped; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', str(v))}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def records(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: str | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page, each UTF-8 if the payload is: a response, in segments where it is long, or a revisit of the record refers_to."""
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Page-ID", None if page_id is None else str(page_id))]
    about = [("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"), ("Content-Type", "application/http;msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id}>"), *shared, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>"), *about], head)
        return
    block = head + chunked(payload)
    at = cuts(block, segment)
    many = len(at) > 2
    for n, (a, b) in enumerate(zip(at, at[1:]), 1):
        number = ("WARC-Segment-Number", str(n) if many else None)
        if n == 1:
            yield _record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id}>"), *shared, *about, number], block[a:b])
        else:
            total = ("WARC-Segment-Total-Length", str(len(block)) if b == len(block) else None)
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}:{n}>"), *shared, ("WARC-Segment-Origin-ID", f"<{record_id}>"), number, total], block[a:b])


def unpacked(raw: bytes, size: int = READ) -> Iterator[bytes]:
    """The bytes of an archive, `size` at a time at most: all members of a gzip file, one after another, or the file as it is. ValueError where a member is broken or ends early."""
    if raw[:2] != b"\x1f\x8b":
        for i in range(0, len(raw), size):
            yield raw[i : i + size]
        return
    view, at = memoryview(raw), 0
    while at < len(raw) and any(view[at : at + 2]):  # zeros may pad the end
        member, rest = zlib.decompressobj(31), b""
        while not member.eof:
            given = rest or view[at : at + size]
            at += 0 if rest else len(given)
            try:
                out = member.decompress(given, size)  # however well it was packed
            except zlib.error as e:
                raise ValueError(f"broken gzip member: {e}") from e
            if not out and not given and not member.eof:
                raise ValueError("a gzip member ends early")
            rest = member.unconsumed_tail
            yield out
        at -= len(member.unused_data)


def parse(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records of an archive that comes in parts, by their Content-Length; one record is held at a time."""
    parts, held, done = iter(parts), bytearray(), 0

    def more() -> bool:
        part = next(parts, None)
        held.extend(part or b"")
        return part is not None

    while True:
        while held[:2] == b"\r\n" or len(held) < 2:
            if held[:2] == b"\r\n":
                del held[:2]
                done += 2
            elif not more():
                if held:
                    raise ValueError(f"no record at byte {done}")
                return
        seen = 0
        while (end := held.find(b"\r\n\r\n", seen)) < 0 and held[:5] == b"WARC/"[: len(held)]:
            seen = max(0, len(held) - 3)
            if not more():
                break
        if end < 0 or not held.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {done}")
        fields, last = {}, None
        for line in bytes(held[:end]).decode(errors="replace").split("\r\n")[1:]:
            if line[:1] in (" ", "\t") and last:  # a folded line
                fields[last] += " " + line.strip()
                continue
            k, _, v = line.partition(":")
            last = k.strip().lower()
            fields[last] = v.strip()
        first, n = end + 4, int(fields.get("content-length", "-1"))
        if n < 0:
            raise ValueError(f"the record at byte {done} has no length")
        while len(held) < first + n:
            if not more():
                raise ValueError(f"the record at byte {done} ends early")
        yield fields, bytes(held[first : first + n])
        del held[: first + n]
        done += first + n


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes a record per page into gzip archives under path (part-*.txt.gz, each a WARC file), by Spark's own writer.

    Of the pages whose payloads are equal and have LEAST_REVISIT bytes or more, the one with the largest page_id (of several: the largest url, then one
    of the equal rows) is stored as a response, and the others as revisits of it. Null html is an empty payload; a null id or url leaves its
    field out and counts as the smallest. An empty table writes no record. Equal payloads are found by a pre-aggregated digest, so copies never meet in a task as
    pairs; short payloads, empty ones with them, meet nowhere."""
    common.arrow_batches(pages.sparkSession)
    rows = common.fit_columns(pages, {id_col: "long", url_col: "string", html_col: "string"}).toDF("page_id", "url", "html")
    rows = rows.withColumn("html", F.coalesce("html", F.lit("")).cast("binary"))
    digest = F.unhex(F.sha1("html"))
    again = not rows.groupBy("page_id").count().filter("count > 1").isEmpty()
    if again:  # equal rows are one with a number of copies, added up before the shuffle
        rows = rows.groupBy("page_id", "url", digest.alias("digest")).agg(F.first("html").alias("html"), F.count("*").alias("copies"))
    else:
        rows = rows.withColumns({"digest": digest, "copies": F.lit(1).cast("long")})
    rows = rows.withColumn("n", F.octet_length("html").cast("long"))
    count, size = rows.agg(F.count("*"), F.sum("n")).first()
    per_file = max(1, int(ARCHIVE / (1000 + (size or 0) / max(1, count))))
    at = F.struct("page_id", "url")
    groups = rows.filter(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.max(at).alias("last"), F.sum("copies").alias("members")).filter("members > 1").withColumnRenamed("digest", "of")
    # a short payload looks for a key that no digest has, each for its own
    wanted = F.when(F.col("n") >= LEAST_REVISIT, F.col("digest")).otherwise(F.unhex(F.md5(F.concat_ws("/", "page_id", "url").cast("binary"))))
    rows = rows.withColumn("_wanted", wanted).join(groups, F.col("_wanted") == F.col("of"), "left")
    name = lambda page, url: F.regexp_replace(F.md5(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("-")), F.hex("digest"), F.coalesce(url, F.lit("-"))).cast("binary")), "^(.{8})(.{4})(.{4})(.{4})", "urn:uuid:$1-$2-$3-$4-")
    stored = F.col("members").isNull() | at.eqNullSafe(F.col("last"))
    rows = rows.select("page_id", "url", "html", "digest", name(F.col("page_id"), F.col("url")).alias("record_id"), stored.alias("stored"), F.when(F.col("members").isNotNull(), name(F.col("last.page_id"), F.col("last.url"))).alias("of"), "copies")

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, ROWS):
            out = []
            for page, url, html, digest, record_id, stored, of, copies in zip(*(c.to_pylist() for c in b.columns)):
                for k in range(copies):
                    revisits = None if of is None or (stored and k == 0) else of
                    out += [r[:-1].decode() for r in records(record_id if k == 0 else f"{record_id}:copy-{k}", page, url, html, digest, revisits)]
            for i in range(0, len(out), OUT_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(out[i : i + OUT_ROWS], pa.string())], names=["value"])  # the writer's line end is the last byte

    rows.mapInArrow(frame, "value string").write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(path)


_RECORD = T.StructType([*[T.StructField(c, T.StringType()) for c in ("record_id", "type", "page_id", "refers_to", "digest", "origin")], T.StructField("number", T.LongType()), T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType())])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under path, plain or gzip with any number of members, of whatever name, from wherever Spark can read them.

    A file is decompressed some bytes at a time, so what is held is its raw bytes and one record. An empty folder or file gives no record; a record that
    breaks off, or bytes that are none, are a ValueError. Fields that are missing are null; a segment number that is no number is one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows = []
                for f, block in parse(unpacked(data.as_py())):
                    bare = lambda k: f[k].strip("<>") if k in f else None  # noqa: B023,E731
                    number = lambda k: int(f[k]) if f.get(k, "").isdigit() else None  # noqa: B023,E731
                    rows.append((bare("warc-record-id"), f.get("warc-type"), f.get("warc-page-id"), bare("warc-refers-to"), f.get("warc-payload-digest"), bare("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"), block))
                    if len(rows) == ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _ARROW)], names=_RECORD.names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _ARROW)], names=_RECORD.names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _RECORD)


_ARROW = [pa.string()] * 6 + [pa.int64()] * 2 + [pa.binary()]


def sha1_of(digest: str | None) -> str | None:
    """The hexadecimal SHA-1 of a digest field, in base 32 or 16; null for another algorithm, or none."""
    algorithm, _, value = (digest or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def reassemble(found: DataFrame) -> DataFrame:
    """One row per response and revisit: record_id, page_id, type, refers_to, payload, payload_digest and problem.

    Continuation records are grouped by the record they go on from and put in order of their number; numbers must run from 1, and the last
    one's total length must be that of all blocks. Chunked framing is decoded, and the digest of the payload is held against the
    field, if that is a SHA-1; what doesn't fit is named in `problem` (null: sound), with a null payload. A revisit has no payload of its own. Records of other
    types are left out. Records without an id, with an empty block, or repeated whole, are rows each; a repeated segment is a problem, and segments that name neither an origin nor themselves are rows each. An empty table gives an empty result."""
    part = F.struct("number", "block", "total")
    keep = ["type", "page_id", "refers_to", "digest"]
    found = found.filter("type IN ('response', 'revisit', 'continuation')")
    whole = found.filter("number IS NULL AND type <> 'continuation'").select("record_id", *keep, F.array(part).alias("parts"))
    cut = found.filter("number IS NOT NULL OR type = 'continuation'").withColumn("of", F.coalesce("origin", "record_id"))
    own = lambda c: F.when(F.col("number") == 1, F.col(c))
    first = lambda c: F.max(own(c)).alias(c)
    lone = cut.filter("of IS NULL").select("record_id", *[own(c).alias(c) for c in keep], F.array(part).alias("parts"))
    whole, cut = whole.unionByName(lone), cut.filter("of IS NOT NULL")
    cut = cut.groupBy("of").agg(*[first(c) for c in keep], F.sort_array(F.collect_list(part)).alias("parts")).withColumnRenamed("of", "record_id")
    out = T.StructType([*[T.StructField(c, T.StringType()) for c in ("record_id", "type")], T.StructField("page_id", T.LongType()), T.StructField("refers_to", T.StringType()), T.StructField("payload", T.BinaryType()), T.StructField("payload_digest", T.StringType()), T.StructField("problem", T.StringType())])

    def payload(parts: list[dict]) -> bytes:
        block = b"".join(p["block"] for p in parts)
        if len(parts) > 1 or parts[0]["number"] is not None:
            if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError("a segment is missing or repeated")
            if parts[-1]["total"] != len(block):
                raise ValueError("segments don't add up to the total length")
        head, _, body = block.partition(b"\r\n\r\n")
        if any(k.strip() == b"transfer-encoding" and b"chunked" in v for k, _, v in (line.lower().partition(b":") for line in head.split(b"\r\n"))):
            body = unchunked(body)
        return body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, ROWS):
            rows = []
            for record_id, kind, page, refers_to, digest, parts in zip(*(c.to_pylist() for c in b.columns)):
                page = int(page) if page is not None and page.lstrip("-").isdigit() else None
                name = sha1_of(digest)
                if kind == "revisit":
                    rows.append((record_id, kind, page, refers_to, None, name, None))
                    continue
                try:
                    body = payload(parts)
                    real = hashlib.sha1(body).hexdigest()
                    rows.append((record_id, kind, page, None, body if name in (None, real) else None, real, None if name in (None, real) else "the digest differs"))
                except (ValueError, IndexError) as e:
                    rows.append((record_id, kind, page, None, None, name, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string()])] if rows else [pa.array([], k) for k in (pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string())], names=out.names)

    common.arrow_batches(found.sparkSession)
    return whole.unionByName(cut).mapInArrow(run, out)


def resolve(whole: DataFrame) -> DataFrame:
    """Per response and revisit: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id) and problem; a revisit's figures are the response's.

    A revisit whose response isn't there has a null refers_to and says so in `problem`; ids that are null stay null. Payloads don't travel: only their sizes and digests meet. An empty table gives an empty result."""
    rows = common.written(whole.select("record_id", "page_id", "type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "problem"))
    stored = rows.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("of"), F.col("payload_bytes").alias("n"))
    done = rows.filter("type = 'revisit'").join(stored, "refers_to", "left").select("page_id", F.col("n").alias("payload_bytes"), "payload_digest", F.col("type").alias("record_type"), F.col("of").alias("refers_to"), F.when(F.col("n").isNull(), "the response is missing").alias("problem"))
    return rows.filter("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "problem").unionByName(done)
