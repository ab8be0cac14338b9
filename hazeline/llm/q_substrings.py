"""Registered query of the suffix-order operator, with its check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.llm.substrings import whole_characters, without_repeats
from hazeline.llm.text import table

SQL = """
with docs as (select doc_id, row_number() over () as r, encode(coalesce(text, '')) as b from documents),
starts as (select r, b, unnest(range(1, octet_length(b) - 398)) as i from docs),
windows as (select r, i, md5(b[i:i + 399]) as h from starts),
twice as (select h from windows group by h having count(*) > 1),
hits as (select r, i, lag(i) over (partition by r order by i) as before from windows where h in (select h from twice)),
numbered as (select r, i, sum(case when before is null or i > before + 400 then 1 else 0 end) over (partition by r order by i) as g from hits),
runs as (select r, min(i) as a, max(i) + 400 as z from numbered group by r, g),
pieces as (
    select r, a as place, coalesce(lag(z) over (partition by r order by a), 1) as x, a - 1 as y from runs
    union all
    select d.r, octet_length(d.b) + 401, coalesce(max(n.z), 1), octet_length(d.b) from docs d left join runs n on n.r = d.r group by d.r, d.b
),
kept as (
    select p.r, unhex(string_agg(case when y >= x then hex(d.b[x:y]) else '' end, '' order by place)) as k
    from pieces p join docs d on d.r = p.r group by p.r
)
select d.doc_id, octet_length(d.b)::bigint as n_bytes, (octet_length(d.b) - octet_length(k.k))::bigint as n_removed,
    (select count(*) from runs n where n.r = d.r)::bigint as n_spans, sha256(k.k) as kept_sha256,
    decode(unhex(coalesce(array_to_string(list_filter(regexp_extract_all(hex(k.k), '[0-7].|(?:C[2-9A-F]|D.)[89AB].|E0[AB].[89AB].|(?:E[1-9ABCEF])[89AB].[89AB].|ED[89].[89AB].|F0[9AB].[89AB].[89AB].|F[1-3][89AB].[89AB].[89AB].|F48.[89AB].[89AB].|..'),
        lambda x: x <> 'EFBFBD' and (length(x) > 2 or x < '8')), ''), ''))) as text
from docs d join kept k on k.r = d.r
"""


def op2_substrings(spark, sf_dir):
    rows = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), whole_characters("kept").alias("text"))
