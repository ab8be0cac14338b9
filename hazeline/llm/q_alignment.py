"""Registered query of the tokenizer alignment. SQL can't express it; the tests hold it against brute force."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

from hazeline.llm.alignment import alignment
from hazeline.llm.text import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def digest(groups: bytes) -> str:
    return hashlib.sha256(groups).hexdigest()


def op12_alignment(spark, sf_dir):
    rows = alignment(table(spark, sf_dir, "documents"), A, B, shown=digest)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
