"""DuckDB statements for the queries that SQL can express over the whole tables.

The others rest on tests against brute force: a trained model (op3, op10), Spark's own hashes (op4), a tokenizer (op1,
op13), double-precision sums in an order of their own (op8, op12), an alignment (op11), windows over templates (op2).
"""

from __future__ import annotations

_COMPONENTS = """
reach(node, other) as (
  select node, node from nodes
  union
  select reach.node, edges.b from reach join edges on reach.other = edges.a),
components as (select node, min(other) as component_id from reach group by 1)
"""

# A byte string as base32: five hexadecimal digits are four characters.
_BASE32 = """
list_reduce(list_transform(range(0, 8), lambda g: list_reduce(list_transform([15, 10, 5, 0], lambda shift:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(digest, 5 * g + 1, 5))::integer) >> shift) & 31) + 1, 1)),
  lambda x, y: x || y)), lambda x, y: x || y)
"""

ORACLE_SQL: dict[str, str] = {
    "op5_warc": f"""
with payloads as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages),
last as (select payload, max(page_id) as original from payloads group by 1)
select page_id, octet_length(encode(payloads.payload)) as payload_bytes, {_BASE32} as payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id <> original then original end as refers_to
from payloads join last on payloads.payload = last.payload
""",
    "op6_embedding_near_dedup": f"""
with recursive vectors as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings),
nodes as materialized (
  select vec_id as node, label, v from vectors
  where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(v, lambda x: x <> 0)) > 0),
edges as (
  select x.node as a, y.node as b from nodes x join nodes y on x.label = y.label and x.node <> y.node and len(x.v) = len(y.v)
  where list_cosine_similarity(x.v, y.v) >= 0.98),
{_COMPONENTS},
degrees as (select a as node, count(*) as n from edges group by 1)
select vec_id, coalesce(n, 0) as n_links, coalesce(component_id, vec_id) as component_id, coalesce(component_id, vec_id) = vec_id as kept
from vectors left join components on vec_id = components.node left join degrees on vec_id = degrees.node
""",
    "op7_minhash_near_dedup": f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words),
nodes as (select doc_id as node, len(s) as n from sets where len(s) > 0),
shingles as (select doc_id, unnest(s) as g from sets),
pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from shingles x join shingles y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
links as (
  select a, b from pairs join nodes x on a = x.node join nodes y on b = y.node where 100 * common >= 85 * (x.n + y.n - common)),
edges as (select a, b from links union all select b, a from links),
{_COMPONENTS}
select doc_id, len(s) as n_shingles, coalesce(component_id, doc_id) as component_id, coalesce(component_id, doc_id) = doc_id as kept
from sets left join components on doc_id = node
""",
    "op9_suffix_array_dedup": """
with raw as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
strings as (
  select doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) as s
  from (select doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0))) as p from raw)),
firsts as (select s, min(doc_id::hugeint * 4294967296 + p) as place from strings group by 1 having count(*) > 1),
again as (
  select doc_id, p from strings join firsts on strings.s = firsts.s where doc_id::hugeint * 4294967296 + p > place),
marked as (
  select doc_id, p, coalesce(p > lag(p) over (partition by doc_id order by p) + 100, true) as fresh from again),
islands as (
  select doc_id, min(p) as start, max(p) + 100 as stop
  from (select doc_id, p, sum(fresh::integer) over (partition by doc_id order by p) as island from marked) group by doc_id, island),
parts as (
  select doc_id, start, stop, coalesce(lag(stop) over (partition by doc_id order by start), 0) as before from islands),
cuts as (
  select parts.doc_id, sum(stop - start) as n_removed, count(*) as n_spans, max(stop) as last,
         string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' order by start) as kept
  from parts join raw on parts.doc_id = raw.doc_id group by 1)
select raw.doc_id, len(h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when kept is null then h else kept || substr(h, 2 * last + 1) end)) as kept_sha256
from raw left join cuts on raw.doc_id = cuts.doc_id
""",
}
