"""Registered queries over raw web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.llm.extraction import extract
from hazeline.llm.text import table
from hazeline.llm.warc import archive

ARCHIVED = """
with p as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
),
g as (select *, max(page_id) over (partition by payload_digest) as last, payload_bytes >= 1000 as is_large from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
    case when is_large and page_id <> last then 'revisit' else 'response' end as record_type,
    case when is_large and page_id <> last then last end as refers_to
from g
"""


def op8_warc(spark, sf_dir):
    records = archive(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return records.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op7_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
