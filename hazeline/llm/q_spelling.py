"""Registered query of the spelling operator. SQL has no crc32; the tests hold it against brute force."""

from __future__ import annotations

from hazeline.llm.spelling import variants
from hazeline.llm.text import table


def op13_spelling(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents"))
