"""WARC archives: writing captures and assembling their transactions.

Every page becomes three records: the response (or, if its payload of at least
``least`` bytes is that of a smaller page, a revisit of it), the request and a
metadata record, the latter two with a WARC-Concurrent-To of the first. Spark's
text writer puts the records into gzipped archives, a record per row with the
record separator between, and the files' sizes are kept near ``file_bytes`` by
a record count derived from the payloads. Reading goes by Content-Length, file
by file in parallel; the records meet through their concurrent-to identifiers
and become one nested row per capture.

Null html is an empty payload; a null url has no WARC-Target-URI; a null page
id is written empty and read back as null, is no page that others revisit, and
revisits a page of the same payload that has an id.
Rows equal in id, url and html are one capture, or with ``each_row`` one each: all
of them but one carry a number in their record identifiers. Of equal payloads the smallest
page_id is the response (ties: every row of that id is). Empty tables give an
empty archive and result. Other input columns are not written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import common
from attrition.session import shared_dir

END = "\r\n"

RECORD = ("capture string, type string, id string, refers_to string, uri string, date string, "
          "digest string, payload_bytes long, payload binary, fields map<string,string>")


def write_archive(pages: DataFrame, path: str, least: int = 100, file_bytes: int = 32 << 20,
                  date: str = "2000-01-01T00:00:00Z", each_row: bool = False) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``."""
    html = common.text_of("html")
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("key"),
                        F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n"),
                        (F.monotonically_increasing_id() if each_row else F.lit(0)).alias("num"))
    digests = common.stored(rows.select("key", "url", "digest", "n", "num"), "payload-digests")
    total, count = digests.agg(F.sum("n"), F.count("*")).first()
    mean = (total or 0) / max(count, 1) + 1000
    shared = (digests.filter(f"n >= {least}").groupBy("digest")
              .agg(F.min("key").alias("first"), F.count("*").alias("c"),
                   F.min(F.when(F.col("key").isNotNull(), F.struct("key", "url"))).getField("url").alias("first_url"))
              .filter("c > 1 AND first IS NOT NULL").drop("c"))
    rows = rows.join(common.sized(shared), "digest", "left").withColumn("again_of", F.lit(""))
    if each_row:  # the first of equal rows has the plain identifier
        equal = (digests.groupBy(F.col("key").alias("k"), F.col("url").alias("u"), F.col("digest").alias("d"))
                 .agg(F.min("num").alias("lead"), F.count("*").alias("c")).filter("c > 1").drop("c"))
        rows = (rows.join(common.sized(equal), F.expr("key <=> k AND url <=> u AND digest = d"), "left")
                .withColumn("again_of", F.when(F.col("num") != F.col("lead"), F.concat(F.lit(":"), "num"))
                            .otherwise("")))

    def record_id(page, url, more=F.lit("")):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page, F.lit("")), F.lit(":"),
                        F.md5(F.concat_ws("|", page, url, "digest")), more, F.lit(">"))

    def header(kind, own, block, mime, *more):
        lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}") if isinstance(kind, str) else
                 F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), own),
                 F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")),
                 *more, F.lit(f"Content-Type: {mime}"),
                 F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
        return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)  # nulls leave no line

    own = record_id(F.col("page_id"), F.col("url"), F.col("again_of"))
    again = F.col("first").isNotNull() & F.coalesce(F.col("first") < F.col("key"), F.lit(True))
    to = F.concat(F.lit("WARC-Concurrent-To: "), own)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("n").cast("string"), F.lit(END + END), F.when(again, "").otherwise(F.col("html")))
    response = header(F.when(again, "revisit").otherwise("response"), own, http, "application/http; msgtype=response",
                      F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
                      F.when(again, F.concat(F.lit("WARC-Refers-To: "),
                                             record_id(F.col("first").cast("string"), F.col("first_url")))),
                      F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
    request = header("request", F.regexp_replace(own, ">$", ":request>"),
                     F.lit(f"GET / HTTP/1.1{END}{END}"), "application/http; msgtype=request", to)
    about = F.concat(F.lit("pageId: "), F.coalesce("page_id", F.lit("")), F.lit(END))
    metadata = header("metadata", F.regexp_replace(own, ">$", ":metadata>"), about, "application/warc-fields", to)
    (rows.select(F.explode(F.array(response, request, metadata)).alias("value"))
     .write.option("lineSep", END + END).option("compression", "gzip")
     .option("maxRecordsPerFile", max(3, int(3 * file_bytes / mean))).text(path))


def parse(data: bytes):
    """The records of an archive: (headers, block), by Content-Length."""
    at, n = 0, len(data)
    while at < n:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= n:
            return
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        heads = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(heads["content-length"])
        yield heads, data[stop + 4:stop + 4 + size]
        at = stop + 4 + size


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record; ``capture`` is the record it is concurrent to, or itself."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches):
        import gzip

        import pyarrow as pa

        kinds = [pa.string()] * 7 + [pa.int64(), pa.binary(), pa.map_(pa.string(), pa.string())]
        names = [c.split()[0] for c in RECORD.split(", ")]

        def table(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer().to_pybytes()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for heads, block in parse(data):
                    kind, payload, size, fields = heads["warc-type"], None, None, None
                    if kind in ("response", "revisit"):
                        top, _, body = block.partition(b"\r\n\r\n")
                        http = dict(x.lower().split(": ", 1) for x in top.decode("utf-8").split("\r\n")[1:])
                        size, payload = int(http["content-length"]), body if kind == "response" else None
                    elif kind == "metadata":
                        fields = [tuple(x.split(": ", 1)) for x in block.decode("utf-8").split("\r\n") if x]
                    rows.append((heads.get("warc-concurrent-to", heads["warc-record-id"]), kind,
                                 heads["warc-record-id"], heads.get("warc-refers-to"),
                                 heads.get("warc-target-uri"), heads["warc-date"],
                                 heads.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                                 size, payload, fields))
                    held += len(block)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, request, response (or revisit) and
    metadata, joined through the concurrent-to identifiers."""
    main = (records.filter("type IN ('response', 'revisit')").dropDuplicates(["id"])
            .select(F.col("id").alias("capture"), F.struct(
                "id", "type", "uri", "date", "digest", "payload_bytes", "payload", "refers_to").alias("response")))
    side = records.filter("type IN ('request', 'metadata')")
    by_type = {t: F.max(F.when(F.col("type") == t, F.struct("id", "uri", "date", F.col("page").alias("page_id"))))
               for t in ("request", "metadata")}
    side = (side.select("capture", "type", "id", "uri", "date", F.col("fields")["pageId"].alias("page"))
            .groupBy("capture").agg(*[v.alias(t) for t, v in by_type.items()]))
    return main.join(side, "capture", "left").select(
        F.expr("try_cast(nullif(metadata.page_id, '') AS bigint)").alias("page_id"), "capture",
        "request", "response", "metadata",
        F.expr(r"try_cast(nullif(regexp_extract(response.refers_to, 'urn:page:(-?[0-9]*):', 1), '') AS bigint)")
        .alias("refers_to"))


def round_trip(pages: DataFrame, each_row: bool = False) -> DataFrame:
    """Write ``pages`` into archives in the shared folder and read their captures back."""
    spark = common.python_ready(pages).sparkSession
    path = shared_dir(spark, f"llm-warc-{uuid.uuid4().hex}")
    write_archive(pages, path, each_row=each_row)
    return assemble(read_records(spark, path))
