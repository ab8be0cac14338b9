"""Registered query of the byte-pair operator. SQL can't express it; the tests hold it against the tokenizers library."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from hazeline.llm.bpe import transcode
from hazeline.llm.text import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe(spark, sf_dir):
    rows = transcode(table(spark, sf_dir, "documents"), VOCABULARY)
    return rows.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
