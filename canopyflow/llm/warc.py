"""WARC archives with revisit resolution.

The headers of all records (id, payload length, payload digest) are shuffled by digest; of equal payloads one record stays a response and
the others are joined to it and written as revisits, without payload, under fresh headers. Archives are WARC/1.1, gzipped whole files that
Spark writes to any store it knows: a record's end, CR LF CR LF, is the writer's line separator. Reading streams each file
record by record, by Content-Length, so a payload may hold anything.

Defined results: a null payload is empty; payloads below the least size are all responses; rows that share the largest page_id of their payload
are all responses; a null page_id is smaller than any other; a null url leaves its header out; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm._common import NULL_ID, Scratch

RECORDS_PER_FILE = 4000
READ = "page_id long, record_type string, refers_to long, target_uri string, payload_digest string, payload_bytes long, payload binary, intact boolean"
_END = "\r\n"


def resolve(pages: DataFrame, least: int = 1000, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(page, url, body, bytes, digest, original): original is the page that a revisit refers to, else null."""
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    all_ = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    all_ = all_.withColumn("bytes", F.octet_length("body").cast("long")).withColumn("digest", F.sha1(F.encode("body", "UTF-8")))
    headers = all_.where(F.col("bytes") >= least).select("page", "bytes", "digest")
    several = headers.groupBy("digest", "bytes").agg(F.max("page").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "bytes", "latest")
    return all_.join(several, ["digest", "bytes"], "left").withColumn("original", F.when(F.col("latest") != F.col("page"), F.col("latest"))).drop("latest")


def _record_id(page):
    h = F.md5(F.concat(F.lit("page "), page.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value):
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def write_archive(resolved: DataFrame, path: str, date: str = "2025-01-01T00:00:00Z") -> None:
    """Write resolved pages as WARC files in a folder."""
    revisit, http = F.col("original").isNotNull(), F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("bytes"), F.lit(_END * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    head = F.concat_ws(
        _END, F.lit("WARC/1.1"), _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), _line("WARC-Record-ID", _record_id(F.col("page"))), F.lit(f"WARC-Date: {date}"),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), _line("X-Page-Id", F.when(F.col("page") != NULL_ID, F.col("page"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("original")))), F.when(revisit, _line("X-Refers-To-Page", F.col("original"))),
        F.lit("Content-Type: application/http;msgtype=response"), _line("Content-Length", F.octet_length(block)))
    out = resolved.select(F.concat(head, F.lit(_END * 2), block).alias("value"))
    out.write.option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).mode("overwrite").text(path)


def _records(stream):
    """(headers, block) of each record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            head[k.strip().lower()] = v.strip()
        yield head, stream.read(int(head["content-length"]))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """READ of every record in a folder; intact: the payload has the digest in the header (null for a revisit, which has none)."""

    def parse(batches):
        import gzip
        import hashlib
        import io

        import pyarrow as pa

        names = [f.partition(" ")[0] for f in READ.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for head, block in _records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest, gone = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"] == "revisit"
                    page, to = (int(head[x]) if x in head else None for x in ("x-page-id", "x-refers-to-page"))
                    intact = None if gone else len(payload) == length and hashlib.sha1(payload).hexdigest() == digest
                    rows.append((page, head["warc-type"], None if to == NULL_ID else to, head.get("warc-target-uri"), digest, length, None if gone else payload, intact))
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(parse, READ)


def restore(records: DataFrame) -> DataFrame:
    """(page_id, target_uri, payload) of every record, a revisit's payload taken from the response that it refers to."""
    whole = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("found")).dropDuplicates(["refers_to", "payload_digest"])
    back = records.where("record_type = 'revisit'").drop("payload").join(whole, ["refers_to", "payload_digest"], "left")
    return records.where("record_type = 'response'").select("page_id", "target_uri", "payload").unionByName(back.select("page_id", "target_uri", F.col("found").alias("payload")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    scratch = Scratch(spark, "warc")
    write_archive(resolve(spark.read.parquet(f"{sf_dir}/pages.parquet")), f"{scratch.root}/archive")
    return read_archive(spark, f"{scratch.root}/archive").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT payload_digest, payload_bytes, max(page_id) AS latest FROM q WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, q.payload_bytes, q.payload_digest, CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to, CASE WHEN latest <> page_id THEN NULL ELSE true END AS intact
FROM q LEFT JOIN m ON q.payload_digest = m.payload_digest AND q.payload_bytes = m.payload_bytes
"""
