"""WARC archives of pages: writing captures, reading records and assembling them into transactions.

A capture is three records: the request, the response or a revisit of an equal earlier payload, and
metadata. Requests and metadata name the response in ``WARC-Concurrent-To``. Archives are written with
Spark's text writer, with the empty lines that end a record as separator, so they go wherever Spark can
write; they are read as whole files, whose size the writer bounds.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.session import fresh_dir
from tutorlake.sources.tables import settle

VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 24_000_000
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = """
    record_id string, type string, target_uri string, date string, concurrent_to array<string>,
    refers_to string, payload_digest string, block_bytes long, payload_bytes long, payload_sha1 string,
    fields map<string, string>, payload binary
"""


def base32(hexed: Column) -> Column:
    """Bare upper-case base32 of hexadecimal digits, whose number must be a multiple of ten."""
    groups = F.transform(
        F.sequence(F.lit(0), (F.length(hexed) / 5).cast("int") - 1),
        lambda k: F.lpad(F.conv(F.substring(hexed, 5 * k + 1, F.lit(5)), 16, 32), 4, "0"),
    )
    return F.translate(F.array_join(groups, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, *parts: str) -> Column:
    name = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(F.col(p).cast("string"), F.lit("null")) for p in parts]))
    cuts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _lines(*lines: tuple[str, Column | str | None]) -> Column:
    """Header lines; one whose value is null is left out, line breaks in values are percent-encoded."""
    made = []
    for name, value in lines:
        column = value if isinstance(value, Column) else F.lit(value)
        clean = F.replace(F.replace(column, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
        made.append(F.concat(F.lit(f"{name}: "), clean, F.lit(BREAK)))
    return F.concat_ws("", *made)


def _record(kind: Column | str, record_id: Column, block: Column, *headers: tuple[str, Column | str | None]) -> Column:
    size = F.octet_length(block).cast("string")
    head = _lines(("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers, ("Content-Length", size))
    return F.concat(F.lit(VERSION + BREAK), head, F.lit(BREAK), block)


def captures_of(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """One row per page: ``page, url, payload, digest, turn, type, refers_to``.

    A null page text is an empty payload. Among payloads that are equal and have at least ``least`` bytes,
    the one of the smallest key is the response, the others revisit it. Rows of one key are numbered in
    ``turn``; of equal rows of the smallest key the first is the response. A null key comes last.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), payload.alias("payload"))
    # Named first, then turned into base32: within the lambda each of its uses would hash the payload again.
    hexed = rows.withColumn("hex", F.upper(F.sha1(F.encode("payload", "UTF-8"))))
    sized = hexed.groupBy("page", "hex").agg(F.count(F.lit(1)).alias("times"), F.first(F.octet_length("payload")).alias("size"))
    turns = settle(sized, "digests")
    total = turns.agg(F.sum(F.col("times") * F.col("size")).alias("n")).first()["n"] or 0
    # Payloads are dealt once, by page and digest; join and numbering keep that dealing.
    rows = hexed.withColumn("own", F.struct("page", "hex")).repartition(max(1, -(-(total + 1) // FILE_BYTES)), "own")
    ranked = F.struct(F.col("page").isNull().alias("last"), F.col("page"))
    first = turns.where(F.col("size") >= least).groupBy("hex").agg(F.min(ranked)["page"].alias("first"))
    known = turns.join(first, "hex", "left").select(
        F.struct("page", "hex").alias("of"), base32(F.col("hex")).alias("digest"), "first",
        F.coalesce(F.col("size") >= least, F.lit(False)).alias("counts"), "times",
    )
    joined = rows.join(known, F.col("own") == F.col("of"))
    window = _turns()
    numbered = joined.withColumn("turn", F.when(F.col("times") > 1, F.row_number().over(window)).otherwise(1))
    original = ~F.col("counts") | (F.col("page").eqNullSafe(F.col("first")) & (F.col("turn") == 1))
    return numbered.select(
        "page", "url", "payload", "digest", "turn",
        F.when(original, "response").otherwise("revisit").alias("type"),
        F.when(~original, F.struct(F.col("first").alias("page"), F.col("digest"), F.lit(1).alias("turn"))).alias("refers_to"),
    )


def _turns():
    from pyspark.sql.window import Window

    return Window.partitionBy("own").orderBy("url")


def write(captures: DataFrame, path: str, compression: str = "none") -> None:
    """Write captures as WARC files of three records each, of about ``FILE_BYTES`` or one capture at most."""
    flat = captures.withColumns(
        {
            "r_page": F.col("refers_to.page"),
            "r_digest": F.col("refers_to.digest"),
            "r_turn": F.col("refers_to.turn"),
        }
    )
    main = _record_id("main", "page", "digest", "turn")
    revisit = F.col("type") == "revisit"
    uri = ("WARC-Target-URI", F.col("url"))
    beside = ("WARC-Concurrent-To", main)
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
        F.when(revisit, F.lit("")).otherwise(_lines(("Content-Length", F.octet_length("payload").cast("string")))),
        F.lit(BREAK),
    )
    request = _record(
        "request", _record_id("request", "page", "digest", "turn"),
        F.concat(F.lit("GET "), F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.lit("/")), F.lit(f" HTTP/1.1{BREAK}{BREAK}")),
        uri, beside, ("Content-Type", "application/http; msgtype=request"),
    )
    answer = _record(
        F.col("type"), main, F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload"))),
        uri, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, _record_id("main", "r_page", "r_digest", "r_turn"))),
        ("Content-Type", "application/http; msgtype=response"),
    )
    metadata = _record(
        "metadata", _record_id("metadata", "page", "digest", "turn"),
        _lines(
            ("page-id", F.col("page").cast("string")),
            ("refers-to-page-id", F.when(revisit, F.col("r_page").cast("string"))),
            ("payload-bytes", F.when(revisit, F.octet_length("payload").cast("string"))),
        ),
        uri, beside, ("Content-Type", "application/warc-fields"),
    )
    records = flat.select(F.explode(F.array(request, answer, metadata)).alias("value"))
    records.write.option("lineSep", BREAK + BREAK).option("compression", compression).text(path)


def parse(archive: bytes) -> Iterator[dict]:
    """The records of one archive; raises at anything that is not a whole record."""
    if archive[:2] == b"\x1f\x8b":
        archive = gzip.decompress(archive)
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        named: dict[str, list[str]] = {}
        for line in archive[at:end].split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            named.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(named["content-length"][0])
        block = archive[end + 4 : end + 4 + size]
        at = end + 4 + size + 4
        if len(block) < size or archive[at - 4 : at] != b"\r\n\r\n":
            raise ValueError(f"a record breaks off before byte {at}")
        one = {name: values[0] for name, values in named.items()}
        kind = one.get("warc-type")
        payload, fields = None, []
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            parts = (x.decode("utf-8", "replace").partition(":") for x in block.split(b"\r\n") if x)
            fields = [(a.strip(), c.strip()) for a, _, c in parts]
        yield {
            "record_id": one.get("warc-record-id"),
            "type": kind,
            "target_uri": one.get("warc-target-uri"),
            "date": one.get("warc-date"),
            "concurrent_to": named.get("warc-concurrent-to", []),
            "refers_to": one.get("warc-refers-to"),
            "payload_digest": one["warc-payload-digest"].partition(":")[2] if "warc-payload-digest" in one else None,
            "block_bytes": size,
            "payload_bytes": None if payload is None else len(payload),
            "payload_sha1": None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            "fields": fields,
            "payload": payload,
        }


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the WARC files below a folder, plain or gzip; no rows for an empty folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.string()) for n in ("record_id", "type", "target_uri", "date")]
            + [("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_digest", pa.string())]
            + [("block_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string())]
            + [("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
        )
        for batch in batches:
            for archive in batch.column(0):
                rows, held = [], 0
                for record in parse(archive.as_py()):
                    if not with_payload:
                        record["payload"] = None
                    rows.append(record)
                    held += record["block_bytes"]
                    if held > FILE_BYTES // 4 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id, response, requests, metadata``.

    Records are joined through ``concurrent_to``, whichever of two records names the other. A capture
    without request or metadata has empty lists; a record that names no capture is left out.
    """
    main = records.where(F.col("type").isin("response", "revisit"))
    side = records.where(F.col("type").isin("request", "metadata"))
    links = (
        side.select(F.explode("concurrent_to").alias("capture"), F.col("record_id").alias("named"))
        .union(main.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("named")))
        .distinct()
    )
    row = F.struct("record_id", "type", "target_uri", "date", "block_bytes", "fields")
    beside = (
        links.join(side.select(F.col("record_id").alias("named"), F.col("type").alias("kind"), row.alias("row")), "named")
        .groupBy("capture")
        .agg(
            F.collect_list(F.when(F.col("kind") == "request", F.col("row"))).alias("requests"),
            F.collect_list(F.when(F.col("kind") == "metadata", F.col("row"))).alias("metadata"),
        )
    )
    whole = F.struct(*[c for c in records.columns if c not in ("concurrent_to", "fields")])
    return main.select("record_id", whole.alias("response")).join(
        beside, F.col("record_id") == F.col("capture"), "left"
    ).select(
        "record_id",
        "response",
        F.coalesce("requests", F.array().cast(beside.schema["requests"].dataType)).alias("requests"),
        F.coalesce("metadata", F.array().cast(beside.schema["metadata"].dataType)).alias("metadata"),
    )


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC captures, read back and assembled; revisits name the page that they repeat."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = fresh_dir(spark, "warc")
    write(captures_of(pages), path, "gzip")
    records = settle(read(spark, path, with_payload=False).drop("payload"), "records")
    whole = assemble(records).withColumn("beside", F.element_at("metadata", 1)["fields"])
    kind = pages.schema["page_id"].dataType
    # A revisit's own records tell what it repeats, so the records of one much repeated page need not meet.
    return whole.select(
        F.col("beside")["page-id"].cast(kind).alias("page_id"),
        F.coalesce(F.col("response.payload_bytes"), F.col("beside")["payload-bytes"].cast("long")).alias("payload_bytes"),
        F.coalesce("response.payload_sha1", "response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("beside")["refers-to-page-id"].cast(kind).alias("refers_to"),
    )


OP8_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), ranked AS (
    SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM payloads
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS INTEGER) >> (5 * (3 - k % 4))) & 31 AS INTEGER), 1)), '')
        AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM ranked
"""
