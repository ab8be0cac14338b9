"""Registered query of the token rollups, with its check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.rollups import Rollup, image, no_image
from hazeline.llm.text import table, word_count
from hazeline.session import scratch_path, written

#: Pieces of the second tokenizer version: runs of letters and digits, and every other visible character by itself.
PIECE = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"

SQL = r"""
with counted as (
    select source, lang, coalesce(doc_id, 0) % 3 = 0 as revised, coalesce(text, '') as text
    from documents where coalesce(doc_id, 0) % 5 <> 0
)
select source, lang, case when revised then 'words-2' else 'words-1' end as tokenizer, count(*) as n_docs,
    sum(case when revised then len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]'))
        else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end)::bigint as n_tokens
from counted group by all
"""


def batches_of(docs: DataFrame) -> list[DataFrame]:
    """Changes of all documents: inserts in four batches, then a batch that counts each third document by the second
    tokenizer version, then a batch that deletes each fifth."""
    place = F.coalesce(F.col("doc_id"), F.lit(0))
    third, fifth = place % 3 == 0, place % 5 == 0
    pieces = F.coalesce(F.regexp_count("text", F.lit(PIECE)), F.lit(0)).cast("long")
    counts = written(docs.select(
        "source", "lang", F.pmod(place, F.lit(4)).alias("part"), third.alias("third"), fifth.alias("fifth"),
        word_count("text").alias("words"), F.when(third, pieces).alias("pieces")), "rollup-counts")
    first, second = image(F.lit("words-1"), "words"), image(F.lit("words-2"), "pieces")
    return [
        counts.select(F.concat(F.lit("insert-"), F.col("part").cast("string")).alias("batch_id"), no_image().alias("before"), first.alias("after")),
        counts.where("third").select(F.lit("revise").alias("batch_id"), first.alias("before"), second.alias("after")),
        counts.where("fifth").select(F.lit("delete").alias("batch_id"), F.when(F.col("third"), second).otherwise(first).alias("before"), no_image().alias("after")),
    ]


def op4_rollups(spark, sf_dir):
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    inserts, revisions, deletes = batches_of(table(spark, sf_dir, "documents"))
    for changes in (inserts, revisions, inserts.unionByName(revisions).unionByName(deletes)):  # the last repeats what is committed
        rollup.commit(changes)
    return rollup.read()
