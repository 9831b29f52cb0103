"""WARC archives: writing captures, reading records, assembling transactions.

Each capture becomes a request, a response (or a revisit of an equal payload)
and a metadata record, linked by WARC-Concurrent-To. Spark's own text writer
puts the records into gzip archives of a bounded number of captures, so its
commit protocol covers lost tasks. Reading streams each archive record by
record. Assembly brings the records that name the same capture together by one
shuffle on the concurrent-to identifier; payloads travel only on request.

Defined results: a null payload is empty; a null URL leaves out the target
header; line breaks in a URL are percent-encoded; of equal payloads the row
with the smallest id answers and the others revisit it (rows that repeat the
smallest id answer each for themselves; a null id revisits, unless all ids of
the group are null); an empty table gives an empty archive and no capture;
records whose partner is missing keep a row of their own with nulls.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch

CRLF = "\r\n"
CAPTURES_PER_ARCHIVE = 1000
RECORD = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def base32_sha1(data: Column) -> Column:
    """SHA-1 in bare upper-case base32: 160 bits are 8 groups of 20."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]), 256)
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-5"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def _record(headers: list[Column], block: Column) -> Column:
    """A record; the writer's line feed ends its closing two line breaks."""
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *headers), F.lit(CRLF + CRLF), block, F.lit("\r\n\r"))


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))


def plan_captures(pages: DataFrame, page_id: str, url: str, html: str, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sizes and digests, type, and the id of the answer
    that a revisit refers to. Payloads are not shuffled twice: the smallest id
    of each digest is pre-aggregated and joined back."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col(url).cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload").cast("long"), "key": F.unhex(F.sha2(F.col("payload").cast("binary"), 256))})
    first = rows.where(F.col("bytes") >= min_revisit_bytes).groupBy("key").agg(F.min("page_id").alias("first_id"))
    joined = rows.join(first, "key", "left")
    revisits = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")))
    return joined.select("page_id", "url", "payload", "bytes", "key", F.when(revisits, F.col("first_id")).alias("refers_to"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, page_id="page_id", url="url", html="html", min_revisit_bytes=0, date="2024-01-01T00:00:00Z", captures_per_archive=CAPTURES_PER_ARCHIVE) -> str:
    rows = plan_captures(pages, page_id, url, html, min_revisit_bytes)
    digest = base32_sha1(F.col("payload").cast("binary"))
    is_revisit = F.col("refers_to").isNotNull()
    answer = lambda who: _urn(F.lit("response"), who, F.hex("key"))
    main = F.when(is_revisit, _urn(F.lit("revisit"), F.col("page_id"), F.hex("key"))).otherwise(answer(F.col("page_id")))
    common = [F.lit(f"WARC-Date: {date}"), _field("WARC-Target-URI", F.col("url"))]
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    body = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    asked = F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(" HTTP/1.1" + CRLF + CRLF))
    notes = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")), F.lit("fetch-status: 200" + CRLF))
    length = lambda block: F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    response = _record(
        [
            F.when(is_revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
            F.concat(F.lit("WARC-Record-ID: "), main),
            *common,
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
            F.when(is_revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), answer(F.col("refers_to")))),
            F.lit("Content-Type: application/http; msgtype=response"),
            length(body),
        ],
        body,
    )
    linked = lambda kind, block, mime: _record(
        [F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), _urn(F.lit(kind), main)), *common, F.concat(F.lit("WARC-Concurrent-To: "), main), F.lit(f"Content-Type: {mime}"), length(block)], block
    )
    records = rows.withColumn("digest", digest).select(F.explode(F.array(linked("request", asked, "application/http; msgtype=request"), response, linked("metadata", notes, "application/warc-fields"))).alias("value"))
    records.write.option("compression", "gzip").option("maxRecordsPerFile", 3 * captures_per_archive).text(path)
    return path


def _inflate(data: memoryview):
    """The text of a plain or gzip archive, member after member, in pieces."""
    if bytes(data[:2]) != b"\x1f\x8b":
        for k in range(0, len(data), 1 << 20):
            yield bytes(data[k : k + (1 << 20)])
        return
    z, k = zlib.decompressobj(31), 0
    while k < len(data) or z.unconsumed_tail:
        piece = z.unconsumed_tail or bytes(data[k : k + (1 << 16)])
        k += 0 if z.unconsumed_tail else len(piece)
        yield z.decompress(piece, 1 << 20)
        while z.eof:
            rest = z.unused_data.lstrip(b"\x00")
            z = zlib.decompressobj(31)
            if not rest:
                break
            yield z.decompress(rest, 1 << 20)


class _Source:
    def __init__(self, pieces):
        self.pieces, self.buffer = pieces, bytearray()

    def fill(self, size: int) -> bool:
        while len(self.buffer) < size:
            piece = next(self.pieces, None)
            if piece is None:
                return False
            self.buffer += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (found := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark) + 1)
            if not self.fill(len(self.buffer) + 1):
                return None
        return self.take(found + len(mark))[: -len(mark)]

    def take(self, size: int) -> bytes:
        self.fill(size)
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        return out


def _lines(head: bytes) -> list[tuple[str, str]]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))
    return [(a.strip().lower(), b.strip()) for a, sep, b in pairs if sep]


def parse_archive(name: str, data, with_payload: bool):
    """A tuple in the order of RECORD for each record of one archive."""
    source, ordinal = _Source(_inflate(memoryview(data))), 0
    while True:
        head = source.until(b"\r\n\r\n")
        if head is None:
            return
        at = head.find(b"WARC/")
        if at < 0:
            continue
        pairs = _lines(head[at:])
        one = dict(pairs)
        block = source.take(int(one.get("content-length") or 0))
        kind, payload = one.get("warc-type"), block
        if (one.get("content-type") or "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        fields = _lines(block) if one.get("content-type") == "application/warc-fields" else []
        yield (
            name, ordinal, one.get("warc-record-id"), kind, [b for a, b in pairs if a == "warc-concurrent-to"], one.get("warc-refers-to"), one.get("warc-target-uri"), one.get("warc-date"), one.get("content-type"),
            (one.get("warc-payload-digest") or "").removeprefix("sha1:") or None, base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload), fields, payload if with_payload else None,
        )
        ordinal += 1


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(RECORD)

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for row in parse_archive(name, data.as_buffer(), with_payload):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > 1 << 23:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit, request and metadata.

    A request or metadata record belongs to the capture it names in
    concurrent-to; a response may name its partners instead, and then they are
    found by their own ids. Record ids that occur more than once are paired in
    the archives' order, not multiplied.
    """
    primary = F.col("type").isin("response", "revisit")
    partner = records.where(primary & (F.size("concurrent_to") > 0)).select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("named_by")).groupBy("record_id").agg(F.min("named_by").alias("named_by"))
    keyed = records.join(partner, "record_id", "left")
    key = F.when(primary, F.col("record_id")).otherwise(F.coalesce(F.col("named_by"), F.get("concurrent_to", F.lit(0)), F.col("record_id")))
    kind = F.when(primary, F.lit("response")).otherwise(F.col("type"))
    keyed = keyed.select(key.alias("capture"), kind.alias("kind"), F.struct(*[F.col(c) for c in records.columns]).alias("record"), "archive", "ordinal")
    keyed = keyed.repartition("capture")
    turn = F.row_number().over(Window.partitionBy("capture", "kind").orderBy("archive", "ordinal"))
    pick = lambda k: F.first(F.when(F.col("kind") == k, F.col("record")), ignorenulls=True).alias(k)
    return keyed.withColumn("turn", turn).groupBy("capture", "turn").agg(pick("request"), pick("response"), pick("metadata"))


def captures(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Assembled captures; a revisit takes its payload's size and digest from
    the response that it refers to."""
    rows = assemble(read_archives(spark, path, with_payload))
    page = F.col("metadata.fields").getItem("page-id").cast("long")
    rows = rows.select("capture", page.alias("page_id"), "request", "response", "metadata")
    answers = rows.where("response.type = 'response'").groupBy(F.col("response.record_id").alias("answer")).agg(
        F.min("page_id").alias("answer_page"), F.max("response.payload_bytes").alias("answer_bytes"), F.max("response.payload_digest").alias("answer_digest")
    )
    # a capture that refers to nothing looks itself up, so that nulls don't meet in one task
    rows = rows.withColumn("sought", F.coalesce("response.refers_to", "capture"))
    rows = rows.join(answers, rows["sought"] == answers["answer"], "left")
    revisit = F.col("response.type") == "revisit"
    return rows.select(
        "page_id",
        F.when(revisit, F.col("answer_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.coalesce("answer_digest", "response.declared_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(revisit, F.col("answer_page")).alias("refers_to"),
        F.when(revisit, F.col("answer_digest") == F.col("response.declared_digest")).otherwise(F.col("response.payload_digest") == F.col("response.declared_digest")).alias("digest_agrees"),
        "request",
        "response",
        "metadata",
    )


def warc_transactions(spark: SparkSession, pages: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    path = scratch(spark, "warc")
    write_archives(spark, pages, path, **options)
    return captures(spark, path, with_payload)
