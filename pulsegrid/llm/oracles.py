"""SQL of the queries it can express over whole tables in reasonable time."""

from __future__ import annotations

SUBSTRING_DEDUP = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (
  select doc_id, i, array_to_string(ws[i:i + 12], ' ') as w
  from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from texts where len(ws) >= 13)),
least_doc as (select w, min(doc_id) as first_doc from windows group by w),
covered as (
  select distinct doc_id, unnest(range(i, i + 13)) as p
  from windows join least_doc using (w) where first_doc < doc_id),
places as (select doc_id, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as word from texts),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as words, count(*) as n
  from places anti join covered using (doc_id, p) group by doc_id)
select t.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(words, '')) as kept_sha256
from texts t left join kept k on k.doc_id = t.doc_id
"""

EMBEDDING_DEDUP = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b
    on a.label = b.label and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (
  select vec_id as node, vec_id as root from embeddings
  union select l.b, r.root from reach r join links l on l.a = r.node where r.root < l.b),
least_root as (select node, min(root) as component_id from reach group by node),
counted as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n, 0)::bigint as n_links, component_id, e.vec_id = component_id as kept
from embeddings e left join counted c on c.a = e.vec_id left join least_root r on r.node = e.vec_id
"""

EXACT_DEDUP = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
  row_number() over w = 1 as kept, text_sha256
from t window w as (partition by text_sha256 order by doc_id nulls last)
"""

ORACLES = {"op3_substring_dedup": SUBSTRING_DEDUP, "op10_embedding_dedup": EMBEDDING_DEDUP, "op12_exact_dedup": EXACT_DEDUP}
