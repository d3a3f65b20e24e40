"""WARC archives: writing captured pages, reading archives, and assembling captures.

Writing and reading go through Spark's own file sources, so archives may lie on any storage that Spark reaches, and a
lost task is simply run again. A capture is a response (or a revisit of an equal payload) with the request and metadata
records that name it, or that it names, in ``WARC-Concurrent-To``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cambio.llm.common import id_sketch, maybe_in, written

#: Smaller payloads are always stored, whether or not they repeat.
LEAST_SHARED_BYTES = 100
#: Pages per archive file, so that a reader's memory is bounded by a file.
PAGES_PER_FILE = 1000
CAPTURE_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY_TYPES = ("response", "revisit")
BREAK = "\r\n"


def classify_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, payload_bytes, first): ``first`` is the page to revisit, null for a response.

    Of equal payloads of at least LEAST_SHARED_BYTES the one with the smallest page_id is stored; rows that repeat that
    id are stored as often. A null html is the empty payload; a null id is larger than any other. The smallest ids are
    found over digests only, pre-aggregated in each task. Pages whose digest is not in the sketch of those that repeat
    pass the scan; the others are joined, and adaptive execution splits a digest that many pages share.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
    )
    shared = (
        rows.where(F.col("payload_bytes") >= LEAST_SHARED_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    shared = written(shared, "shared-digests")
    columns = [*rows.columns, "first"]
    marked = rows.withColumn("maybe", maybe_in(pages.sparkSession, id_sketch(shared, "digest"), "digest"))
    alone = marked.where("NOT maybe").withColumn("first", F.lit(None).cast("bigint")).select(*columns)
    stored = F.col("page_id").eqNullSafe(F.col("first"))
    several = marked.where("maybe").join(shared, "digest", "left")
    return alone.unionByName(several.withColumn("first", F.when(~stored, F.col("first"))).select(*columns))


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text; a header whose value is null is left out."""
    lines = [F.lit(f"WARC/1.1{BREAK}WARC-Type: {kind}{BREAK}WARC-Date: {CAPTURE_DATE}{BREAK}")]
    headers = [("WARC-Record-ID", record_id), *headers, ("Content-Length", F.octet_length(block).cast("string"))]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit("")) for name, value in headers]
    return F.concat(*lines, F.lit(BREAK), block)


def archive_text(page_id: str = "page_id", first: str = "first") -> Column:
    """The request, response or revisit, and metadata records of a classified page, without the final line breaks.

    Records are named by page and payload; a page without an id takes its name from the column ``no_id``.
    """

    def name(page: str, part: str) -> Column:
        page_text = F.coalesce(F.col(page).cast("string"), F.col("no_id"))
        return F.concat(F.lit("<urn:x-page:"), page_text, F.lit(":"), F.substring("digest", 1, 16), F.lit(f":{part}>"))

    # no line break or other control character may get into a header
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\x00-\\x20\\x7F]", "%20")
    own = name(page_id, "capture")
    target = ("WARC-Target-URI", url)
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(BREAK + BREAK),
    )
    request = _record(
        "request",
        name(page_id, "request"),
        [target, ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{BREAK}{BREAK}")),
    )
    answer_type = ("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", own, [target, digest, answer_type], F.concat(http, F.col("html")))
    refers = ("WARC-Refers-To", name(first, "capture"))
    profile = ("WARC-Profile", F.lit(REVISIT_PROFILE))
    revisit = _record("revisit", own, [target, digest, answer_type, refers, profile], http)
    metadata = _record(
        "metadata",
        name(page_id, "metadata"),
        [target, ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(BREAK)),
    )
    end = F.lit(BREAK + BREAK)
    main = F.when(F.col(first).isNull(), response).otherwise(revisit)
    return F.concat(request, end, main, end, metadata)


def write_archives(classified: DataFrame, path: str) -> None:
    """Archive files of classified pages, compressed, at most PAGES_PER_FILE pages in each."""
    (
        # drawn once for each row, and named only by rows without an id, which nothing refers to
        classified.withColumn("no_id", F.concat(F.lit("none-"), F.expr("uuid()")))
        .select(archive_text().alias("value"))
        .write.option("lineSep", BREAK + BREAK)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", PAGES_PER_FILE)
        .text(path)
    )


RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, concurrent_to array<string>, refers_to string, "
    "header_digest string, payload_bytes bigint, payload_sha256 string, fields map<string,string>, payload binary"
)


def parse_records(raw: bytes, with_payload: bool) -> Iterator[tuple]:
    """The records of an archive (compressed as a whole, by record, or not at all), as rows of RECORD_SCHEMA."""
    if raw[:2] == b"\x1f\x8b":
        parts = []
        while raw:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(raw))
            raw = member.unused_data
        raw = b"".join(parts)
    at = 0
    while True:
        while raw[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(raw):
            return
        stop = raw.find(b"\r\n\r\n", at)
        if stop < 0 or raw[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        headers: dict[str, list[str]] = {}
        for line in raw[at:stop].decode("utf-8", "replace").split(BREAK)[1:]:
            key, _, value = line.partition(":")
            headers.setdefault(key.strip().lower(), []).append(value.strip())
        length = int(headers["content-length"][0])
        block = raw[stop + 4 : stop + 4 + length]
        if len(block) < length:
            raise ValueError(f"the record at byte {at} is cut off")
        at = stop + 4 + length
        yield _row(headers, block, with_payload)


def _row(headers: dict[str, list[str]], block: bytes, with_payload: bool) -> tuple:
    kind = headers["warc-type"][0]
    one = lambda name: headers.get(name, [None])[0]
    payload, size, fields = block, len(block), {}
    if kind in (*PRIMARY_TYPES, "request"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":  # the payload is elsewhere; the HTTP header tells its length
            lines = (line.partition(b":") for line in head.split(b"\r\n"))
            size = next((int(v) for k, _, v in lines if k.strip().lower() == b"content-length"), None)
    elif kind == "metadata" or kind == "warcinfo":
        lines = (line.partition(":") for line in block.decode("utf-8", "replace").splitlines() if ":" in line)
        fields = {k.strip(): v.strip() for k, _, v in lines}
    return (
        headers["warc-record-id"][0],
        kind,
        one("warc-target-uri"),
        headers.get("warc-concurrent-to", []),
        one("warc-refers-to"),
        one("warc-payload-digest"),
        size,
        hashlib.sha256(payload).hexdigest() if kind == "response" else None,
        list(fields.items()),
        payload if with_payload and kind != "revisit" else None,
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records (RECORD_SCHEMA) of all archives under a path. A damaged archive fails the job."""
    names = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
    strings = pa.list_(pa.string())
    kinds = [pa.string(), pa.string(), pa.string(), strings, pa.string(), pa.string(), pa.int64(), pa.string()]
    kinds += [pa.map_(pa.string(), pa.string()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = parse_records(batch.column("content")[k].as_py(), with_payload)
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, its requests and its metadata records.

    Requests and metadata find their capture by ``WARC-Concurrent-To`` on either side. A capture without companions has
    empty arrays, a companion without a capture makes no row, and captures that repeat an id are rows of their own with
    the same companions. Companions are grouped by capture before the join, equal ones count once, in each task first: so
    the join multiplies nothing, and copies of a record add nothing.
    """
    primary = records.where(F.col("record_type").isin(*PRIMARY_TYPES))
    companion = records.where(F.col("record_type").isin("request", "metadata")).select(
        "record_type",
        F.struct("record_id", "target_uri", "payload_bytes", F.map_entries("fields").alias("fields")).alias("part"),
        F.col("record_id").alias("own_id"),
        "concurrent_to",
    )
    named_by_companion = companion.select(
        F.explode("concurrent_to").alias("capture_id"), "record_type", "part"
    )
    named_by_capture = (
        primary.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("own_id"))
        .join(companion.select("own_id", "record_type", "part"), "own_id")
        .select("capture_id", "record_type", "part")
    )
    parts = named_by_companion.unionByName(named_by_capture)

    def by_id(a: Column, b: Column) -> Column:
        return F.when(a.record_id < b.record_id, -1).when(a.record_id > b.record_id, 1).otherwise(0)

    def of(kind: str) -> Column:
        found = F.array_sort(F.collect_set(F.when(F.col("record_type") == kind, F.col("part"))), by_id)
        whole = lambda part: part.withField("fields", F.map_from_entries(part["fields"]))
        return F.transform(found, whole)

    grouped = parts.groupBy("capture_id").agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    nothing = F.array().cast(grouped.schema["requests"].dataType)
    return (
        primary.join(grouped, primary["record_id"] == grouped["capture_id"], "left")
        .select(
            F.col("record_id").alias("capture_id"),
            "record_type",
            "target_uri",
            F.struct("refers_to", "header_digest", "payload_bytes", "payload_sha256", "payload").alias("answer"),
            F.coalesce("requests", nothing).alias("requests"),
            F.coalesce("metadata", nothing).alias("metadata"),
        )
    )
