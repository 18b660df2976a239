"""WARC archives: writing pages, and reading them back with segments put together again.

A page is a response record holding an HTTP message with a chunked body. Messages longer than a segment are
cut: the first record carries segment number 1, each further one is a continuation that names the first by its
origin id, and the last states the total length. Of pages with equal payloads of ``DEDUP_BYTES`` or more, that
with the smallest id is a response and the others are revisit records that refer to it.

Archives are text-file writes and reads of Spark, compressed or not; a file that is not is read in splits of any
size. Records are found by their version line, which a body cannot hold, because the writer ends a chunk inside it.
Content-Length, segment numbers, total length, chunk sizes and digest are all verified; ``intact`` tells whether
they held.

Null html is an empty payload. A null id is written as no id and read back as null; it is never the one referred
to unless all copies lack an id, which are then all responses. Rows that repeat the smallest id of a payload are
responses each. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.session import cut_lineage

VERSION = "WARC/1.1\r\n"
DEDUP_BYTES = 100
CHUNK_BYTES = 8192
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked framing; no version line is left whole."""
    out, at, guard = [], 0, VERSION.strip().encode()
    while at < len(payload):
        to = min(at + size, len(payload))
        mark = payload.find(guard, at, to)
        if mark >= 0:
            to = mark + 4
        out.append(b"%x\r\n%b\r\n" % (to - at, payload[at:to]))
        at = to
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None where the framing is broken or cut short."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        start, at = line + 2, line + 2 + size + 2
        if size < 0 or body[start + size : at] != b"\r\n":
            return None
        if size == 0:
            return b"".join(out)
        out.append(body[start : start + size])


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION.encode() + head.encode() + b"\r\n" + block


def records(name: str, page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page, each without the blank lines that end it."""
    about = [("WARC-Page-ID", page)] if page is not None else []
    about += [("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]"))] if url else []
    about += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"), *about, ("WARC-Profile", profile), ("WARC-Refers-To", f"<urn:page:{refers_to}>")], b"")
        return
    block = HTTP + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), *about, ("Content-Type", "application/http;msgtype=response")]
    yield _record(first + [("WARC-Segment-Number", "1")] * (len(parts) > 1), parts[0])
    for i, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if i == len(parts) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{name}/{i}>"), ("WARC-Segment-Origin-ID", f"<urn:page:{name}>"), ("WARC-Segment-Number", str(i)), *last], part)


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", segment_bytes: int = 32 << 10, compression: str = "gzip") -> None:
    """Write the pages as archives below ``path``, one file or more per task."""
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    same = numbered.filter(F.octet_length("payload") >= DEDUP_BYTES).groupBy("digest", "page").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    first = F.min_by(F.struct("page", "n", "row"), F.when(F.col("page").isNotNull(), F.col("page"))).alias("first")
    copies = same.groupBy("digest").agg(first, F.sum("n").alias("all")).filter("all > 1 AND first.page IS NOT NULL").select("digest", "first")
    # Written first, so that the join below knows its size and shuffles the pages only if copies are many.
    copies = cut_lineage(copies, "copies")
    joined, least = numbered.join(copies, "digest", "left"), F.col("first.page")
    # The response that others refer to is named by what they know of it: its page and digest. Of repeated rows one has that name.
    name = lambda page, last: F.concat_ws(":", page.cast("string"), last)
    chosen = F.col("page").eqNullSafe(least) & ((F.col("first.n") == 1) | (F.col("row") == F.col("first.row")))
    told = joined.select(
        F.when(least.isNotNull() & chosen, name(least, F.col("digest"))).otherwise(name(F.coalesce(F.col("page").cast("string"), F.lit("-")), F.col("row").cast("string"))).alias("name"),
        F.col("page").cast("string").alias("page"), "url", "payload", "digest",
        F.when(least.isNotNull() & ~F.col("page").eqNullSafe(least), name(least, F.col("digest"))).alias("refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for x in zip(*(c.to_pylist() for c in batch.columns)):
                for r in records(*x, segment_bytes):
                    out.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    told.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").text(path, compression=compression)


HEAD = re.compile(rb"([A-Za-z0-9-]+):[ \t]*(.*?)\r\n")
RECORD = "kind string, name string, page string, refers string, digest string, origin string, segment long, total long, block binary, ok boolean"


def parse_record(raw: bytes) -> dict | None:
    """The fields of a record that starts after its version line; None for the empty piece before the first."""
    if not raw.strip():
        return None
    head, _, rest = raw.partition(b"\r\n\r\n")
    field = {k.lower().decode(): v.decode() for k, v in HEAD.findall(head + b"\r\n")}
    size = int(field["content-length"]) if field.get("content-length", "").isdigit() else -1
    number = lambda k: int(field[k]) if field.get(k, "").isdigit() else None
    return {
        "kind": field.get("warc-type"), "name": field.get("warc-record-id"), "page": field.get("warc-page-id"),
        "refers": field.get("warc-refers-to"),
        "digest": field.get("warc-payload-digest", "").removeprefix("sha256:"), "origin": field.get("warc-segment-origin-id") or field.get("warc-record-id"),
        "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"),
        "block": rest[:size] if size >= 0 else b"", "ok": 0 <= size <= len(rest) and not rest[size:].strip(b"\r\n"),
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``: type, ids, segment fields and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([(f, t) for f, t in zip(("kind", "name", "page", "refers", "digest", "origin"), [pa.string()] * 6)] + [("segment", pa.int64()), ("total", pa.int64()), ("block", pa.binary()), ("ok", pa.bool_())])
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = [r for x in batch.column(0).slice(at, 512) if (r := parse_record(x.as_py())) is not None]
                yield pa.RecordBatch.from_pylist(found, schema=shape)

    return spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary")).mapInArrow(run, RECORD)


def reassemble(found: DataFrame) -> DataFrame:
    """(kind, name, page, refers, digest, block, whole): one row per response or revisit, the blocks of segments joined in order.

    Only records with a segment number are shuffled, by the id of the record they began with.
    """
    single = found.filter("segment IS NULL AND kind <> 'continuation'").select("kind", "name", "page", "refers", "digest", "block", F.col("ok").alias("whole"))
    parts = F.array_sort(F.collect_list(F.struct("segment", "block")))
    joined = found.filter("segment IS NOT NULL").groupBy("origin").agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("kind", "name", "page", "refers", "digest")],
        parts.alias("parts"), F.max("total").alias("total"), F.bool_and("ok").alias("ok"),
    )
    numbers = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))
    block = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["block"]))
    whole = joined.select("kind", "name", "page", "refers", "digest", block.alias("block"), (F.col("ok") & numbers).alias("numbered"), "total")
    return single.unionByName(whole.select("kind", "name", "page", "refers", "digest", "block", (F.col("numbered") & (F.octet_length("block") == F.col("total"))).alias("whole")).filter("kind IS NOT NULL"))


def read_pages(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """(page string, record_type, refers_to string, payload, payload_bytes, payload_digest, intact) for every page in the archives.

    The payload of a revisit is null; its length comes from the record it refers to. Without ``payload`` that
    column is left out, and nothing as large as the pages is written on the way.
    """

    @F.arrow_udf("binary")
    def decode(blocks: pa.Array) -> pa.Array:
        return pa.array([unchunked(b.partition(b"\r\n\r\n")[2]) if (b := x.as_py()) else None for x in blocks], pa.binary())

    @F.arrow_udf("string")
    def sha256(payloads: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(x.as_py()).hexdigest() if x.is_valid else None for x in payloads], pa.string())

    pages = reassemble(read_records(spark, path))
    own = pages.filter("kind = 'response'").select("name", "page", "digest", "whole", decode("block").alias("payload"))
    content = ["payload"] if payload else []
    own = cut_lineage(own.select("name", "page", *content, F.octet_length("payload").cast("long").alias("payload_bytes"), sha256("payload").alias("payload_digest"), "digest", "whole"), "payloads")
    told = own.select("page", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"), *content, "payload_bytes", "payload_digest", (F.col("whole") & (F.col("digest") == F.col("payload_digest"))).alias("intact"))
    # A revisit leads to the record its reference names; it is intact if that is there and has the payload it claims.
    known = own.select(F.col("name").alias("refers"), F.col("page").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("found"))
    again = pages.filter("kind = 'revisit'").select("page", "refers", "digest", "whole").join(known, "refers", "left")
    good = F.col("whole") & F.coalesce(F.col("found") == F.col("digest"), F.lit(False))
    return told.unionByName(again.select("page", F.lit("revisit").alias("record_type"), "refers_to", *[F.lit(None).cast("binary").alias(c) for c in content], "payload_bytes", F.col("digest").alias("payload_digest"), good.alias("intact")))
