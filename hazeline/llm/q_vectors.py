"""Registered queries of the two vector searches. The approximate one has no SQL; its recall is tested."""

from __future__ import annotations

from hazeline.llm.exact_search import top_products
from hazeline.llm.hnsw import build_index, search_index
from hazeline.llm.text import table

PRODUCTS = """
with v as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
pairs as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
    from v q, v c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
where rank <= 5
"""


def op10_top_products(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op5_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search_index(build_index(vectors), vectors.where("vec_id % 100 = 0"), 10)
