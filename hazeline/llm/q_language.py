"""Registered query of the language operator. SQL can't express it within reason; the tests hold it against brute force."""

from __future__ import annotations

from hazeline.llm.language import held_out, identify, learn
from hazeline.llm.text import table
from hazeline.session import written


def op1_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = written(learn(docs.where(~held_out())), "lang-profiles")
    rows = identify(docs.select("doc_id", "text"), profiles)
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
