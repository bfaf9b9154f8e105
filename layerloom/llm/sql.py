"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from layerloom.llm import licenses


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license_sql() -> str:
    """Every position of every text against every phrase; no index."""
    templates = [(True, t) for t in licenses.BASE_PHRASES] + [(False, t) for t in licenses.NOTICES]
    values = ", ".join(
        f"({str(base).lower()}, '{t.label}', {_list(t.words)}, {_list(t.key)}, {t.key_at})" for base, t in templates
    )
    return f"""
with t(base, label, tw, kw, key_at) as (values {values}),
d as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '') as w
  from documents),
m as (
  select d.doc_id, t.base, t.label, t.tw, t.key_at, d.w, unnest(list_filter(range(0, len(d.w)::bigint),
    lambda i: d.w[i + 1] = t.kw[1] and d.w[i + 1 : i + len(t.kw)] = t.kw)) as s
  from d join t on list_has_all(d.w, t.kw)),
g as (
  select doc_id, count(*) filter (base) as n_base, min(s) filter (base) as first_word, max(s) filter (base) as last_word,
    string_agg(distinct label, ',' order by label) filter (base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels,
    max(case when base then 0.0::double else
      len(list_filter(range(0, len(tw)::bigint), lambda k: s + k - key_at >= 0 and w[s + k - key_at + 1] = tw[k + 1])) / len(tw)::double end) as score
  from m group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(g.n_base, 0)::bigint as n_base, g.first_word::bigint as first_word,
  g.last_word::bigint as last_word, coalesce(g.base_labels, '') as base_labels, coalesce(g.labels, '') as labels,
  coalesce(g.score, 0.0::double)::double as score
from d left join g using (doc_id)
"""


URLS = """
with u as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r(rule_host, rule_path, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f as (
  select p.*, r.*, row_number() over (partition by page_id order by length(rule_host || rule_path) desc nulls last) as n
  from p left join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule_host || rule_path as rule, coalesce(verdict, 'allow') as verdict from f where n = 1
"""

# All pairs; the operator needs none of them.
TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

COSINES = """
with recursive v as (
  select vec_id, embedding::double[] as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.x, b.x) >= 0.9),
r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on r.b = l.a),
m as (select a as vec_id, min(b) as component_id from r group by a),
n as (select a as vec_id, count(*) as n_links from l group by a)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, m.component_id, e.vec_id = m.component_id as kept
from embeddings e join m using (vec_id) left join n using (vec_id)
"""

# Every document that shares a term with an item; no masks.
RANKED = """
with words as (
  select doc_id, row_number() over () as d, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) as term
  from documents),
sizes as (select d, doc_id, count(*) as n from words group by all),
total as (select count(*) as docs, sum(n)::bigint as words from sizes),
asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) as term from benchmark)
  group by all),
held as (select d, term, count(*) as tf from words where term in (select term from asked) group by all),
weights as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from held, total group by term),
parts as (
  select d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))) as part
  from held join weights using (term) join sizes using (d), total),
scored as (select item_id, d, doc_id, sum(times * part)::bigint as score from asked join parts using (term) group by all),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

ORACLE = {"op11_ranked_search": RANKED, "op5_exact_top_k": TOP_K, "op6_lattice_near_dedup": COSINES, "op3_license_scan": _license_sql(), "op8_url_filters": URLS}
