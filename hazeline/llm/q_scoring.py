"""Registered query of the language model. SQL can't express sampling; the tests hold it against a plain sampler."""

from __future__ import annotations

from hazeline.llm.pitman_yor import held_out, scored
from hazeline.llm.text import table


def op11_scoring(spark, sf_dir):
    return scored(table(spark, sf_dir, "documents"), held_out())
