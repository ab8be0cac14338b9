"""Registered query of the Jaccard join, with its check SQL."""

from __future__ import annotations

from hazeline.llm.jaccard import similar_groups
from hazeline.llm.text import table

SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
shingles as (
    select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
    select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)
),
paired as (select a, b from links union all select b, a from links),
reached as (
    select doc_id as a, doc_id as b from documents
    union
    select r.a, l.b from reached r join paired l on l.a = r.b
)
select w.doc_id, coalesce(z.n, 0)::bigint as n_shingles, r.component_id
from words w left join sizes z using (doc_id)
join (select a, min(b) as component_id from reached group by a) r on r.a = w.doc_id
"""


def op3_jaccard(spark, sf_dir):
    return similar_groups(table(spark, sf_dir, "documents"))
