"""Registered query of the mixing operator, with its check SQL."""

from __future__ import annotations

from hazeline.llm.mixing import mix
from hazeline.llm.text import table

SQL = r"""
with docs as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, 15))::bigint as point
    from documents
),
sources as (
    select source, sum(size)::bigint as source_size,
        [5.0, 2.0, 1.0][((row_number() over (order by source is null, encode(source)) - 1) % 3 + 1)::int]::double as weight
    from docs group by source
),
filled as (
    select *, 2.0::double * source_size as most, 1.5::double * sum(source_size) over () as budget,
        row_number() over (order by 2.0::double * source_size / weight, source is null, encode(source)) as k from sources
),
ordered as (
    select *, coalesce(sum(most) over (order by k rows between unbounded preceding and 1 preceding), 0) as given,
        sum(weight) over (order by k rows between current row and unbounded following) as rest from filled
),
judged as (select *, weight * (budget - given) > most * rest as is_full from ordered),
level as (
    select max(budget) - coalesce(sum(most) filter (is_full), 0) as words, sum(weight) filter (not is_full) as weight from judged
),
targets as (
    select j.source, j.source_size, case when is_full then most else j.weight * l.words / l.weight end as target
    from judged j, level l
),
parts as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole,
        case when source_size > 0 then target - floor(target / source_size) * source_size else 0 end as part from targets
),
runs as (
    select d.*, p.source_size, p.target, p.whole, p.part,
        coalesce(sum(d.size) over (partition by d.source order by d.point range between unbounded preceding and current row), 0) as upto,
        sum(d.size) over (partition by d.source, d.point) as words
    from docs d join parts p on d.source is not distinct from p.source
)
select doc_id, size::bigint as size, source_size, target,
    (size * (whole + case when part > 0 and upto - words < part and (upto < part or (part - upto + words) * 2 > words) then 1 else 0 end))::bigint as taken
from runs
"""


def op6_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
