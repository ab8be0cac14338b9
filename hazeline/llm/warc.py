"""WARC archives without repeated payloads.

Headers alone are shuffled by payload digest to find, for each payload that occurs more than once, the record that keeps
it; the others become revisit records that refer to it. Archives are written by Spark's text writer: a WARC record ends
in two line breaks, which is the writer's line separator here, so the files lie wherever Spark can write. Reading goes
by each record's Content-Length, and joins revisits to the responses they refer to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.session import scratch_path, written

SMALLEST = 1000  # bytes of a payload that a revisit is worth
FILE_BYTES = 64 << 20  # of a file before compression, about: a file is read as one value
FILE_RECORDS = 4000  # records of a file at most
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def _hidden(text: Column) -> Column:
    """A text as a header value: white space, controls and percent signs escaped."""
    return F.regexp_replace(F.url_encode(F.coalesce(text, F.lit(""))), r"\+", "%20")


def resolved(records: DataFrame, key: str, payload: str, smallest: int = SMALLEST) -> DataFrame:
    """(key, digest, refers_to): the records that become revisits, and whom they refer to.

    Of equal payloads of at least `smallest` bytes the largest key is kept. Rows that share that key are all kept; a
    null key is smaller than any other, and if all are null, all are kept.
    """
    heads = records.select(F.col(key).alias("key"), F.sha1(F.col(payload)).alias("digest"), F.octet_length(payload).alias("bytes"))
    heads = written(heads.where(F.col("bytes") >= smallest).select("key", "digest"), "warc-heads")
    kept = heads.groupBy("digest").agg(F.max("key").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    both = heads.join(kept, "digest").where(F.col("refers_to").isNotNull() & ~F.col("key").eqNullSafe(F.col("refers_to")))
    return both.select("key", "digest", "refers_to").distinct()


def _record_id(key: Column, digest: Column) -> Column:
    """A record's own identifier, the same in each run."""
    h = F.sha1(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/"), digest))
    return F.concat(F.lit("<urn:sha1:"), h, F.lit(">"))


def write_archives(records: DataFrame, path: str, key: str, uri: str, payload: str, date: str = DATE) -> None:
    """One record per row: `response`, or `revisit` without the payload if another record keeps it.

    A null payload counts as empty. Headers are made anew; the payload digest is that of the whole payload either way.
    """
    rows = records.select(F.col(key).alias("key"), F.col(uri).cast("string").alias("uri"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    again = resolved(rows, "key", "payload")
    mean = rows.agg(F.avg(F.octet_length("payload"))).first()[0] or 0
    in_file = max(1, min(FILE_RECORDS, int(FILE_BYTES / (mean + 1000))))
    both = rows.alias("r").join(again.alias("a"), F.col("r.key").eqNullSafe(F.col("a.key")) & (F.col("r.digest") == F.col("a.digest")), "left")
    digest, first = F.col("r.digest"), F.col("a.refers_to")
    size = F.octet_length("r.payload")
    plain = F.col("r.uri").rlike(r"^[\x21-\x7E]+\z")  # others are escaped as a whole, and marked
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END))
    block = F.when(first.isNull(), F.concat(http, F.col("r.payload"))).otherwise(http)
    lines = [
        F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.when(first.isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("r.key"), digest)),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.when(plain, F.col("r.uri")).otherwise(F.concat(_hidden(F.col("r.uri")), F.lit("\r\nX-Escaped: uri")))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.when(first.isNotNull(), F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _record_id(first, digest))),
        F.when(F.col("r.key").isNotNull(), F.concat(F.lit("X-Key: "), _hidden(F.col("r.key").cast("string")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)
    both.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", in_file).text(path)


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record; ends with an error where a record is cut off."""
    at = 0
    while at < len(archive):
        body = archive.index(END.encode(), at) + len(END)
        first, *rest = archive[at:body].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in rest if x)}
        stop = body + int(head["content-length"])
        if archive[stop:stop + len(END)] != END.encode():
            raise ValueError(f"the record at byte {at} is cut off")
        yield head, archive[body:stop]
        at = stop + len(END)


READ = "key string, uri string, record_type string, record_id string, refers_to string, digest string, payload binary"


def read_archives(spark, path: str) -> DataFrame:
    """The records of all archives below `path`, with payloads where they are; key, uri and digest as text.

    Raises an error for a payload that doesn't fit its digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        from urllib.parse import unquote

        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for head, block in parsed(zlib.decompress(content.as_py(), 31)):
                    payload = block[block.index(END.encode()) + len(END):] if head["warc-type"] == "response" else None
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{head['warc-record-id']} does not have the payload of its digest")
                    key = unquote(head["x-key"]) if "x-key" in head else None
                    uri = head["warc-target-uri"]
                    out.append((key, unquote(uri) if "x-escaped" in head else uri, head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"), digest, payload))
                    size += len(block)
                    if size > 8 << 20:
                        yield _batch(out)
                        out, size = [], 0
                yield _batch(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = [pa.string()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(7)], names)


def archive(records: DataFrame, key: str, uri: str, payload: str, path: str | None = None) -> DataFrame:
    """Write the archives to `path` (a new folder if none is named) and read them back, one row per record.

    Result: key (text), uri, payload_bytes, payload_digest, record_type, refers_to (the key, as text, of the response
    that a revisit refers to). For a revisit the first two are those of the response it refers to, by join. An empty
    table gives an empty result; repeated rows are records of their own.
    """
    path = path or scratch_path(records.sparkSession, "warc")
    write_archives(records, path, key, uri, payload)
    heads = read_archives(records.sparkSession, path).select(
        "key", "uri", "record_type", "record_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    heads = written(heads, "warc-read")
    full = heads.where("record_type = 'response'").drop("refers_to")
    kept = full.groupBy("record_id").agg(F.max("key").alias("first"), F.max("payload_bytes").alias("bytes"), F.max("payload_digest").alias("digest"))
    back = heads.where("record_type = 'revisit'").alias("r").join(kept.alias("k"), F.col("r.refers_to") == F.col("k.record_id"))
    back = back.select("r.key", "r.uri", F.col("k.bytes").alias("payload_bytes"), F.col("k.digest").alias("payload_digest"), "r.record_type", F.col("k.first").alias("refers_to"))
    return full.select("key", "uri", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to")).unionByName(back)
