"""DuckDB SQL of the registered queries that SQL can express."""

_LOWER = (
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

#: Integer products of every pair; vectors with null or non-finite components are left out.
OP6 = """
with fine as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from fine q join fine c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
  from pairs)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""

#: Shared shingles of every pair, then the smallest id that links lead to.
OP10 = f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(case
    when len(w) = 0 then []
    when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select x.doc_id as a, y.doc_id as b
  from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
  join sizes m on m.doc_id = x.doc_id join sizes n on n.doc_id = y.doc_id
  group by x.doc_id, y.doc_id, m.n, n.n
  having 100 * count(*) >= 85 * (m.n + n.n - count(*))),
reached as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reached r join links l on r.b = l.a),
least as (select a as doc_id, min(b) as component_id from reached group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id,
       doc_id = component_id as kept
from least left join sizes using (doc_id)
"""

#: Every document's exact score for every item.
_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP11 = f"""
with words as (
  select doc_id, row_number() over () as uid, {_TERMS} as w from documents),
held as (select doc_id, uid, w, len(w)::bigint as n from words where len(w) > 0),
whole as (select count(*)::bigint as docs, sum(n)::bigint as length from held),
tf as (
  select uid, doc_id, n, term, count(*)::bigint as tf
  from (select uid, doc_id, n, unnest(w) as term from held) group by all),
df as (select term, count(*)::bigint as df from tf group by term),
items as (
  select item_id, row_number() over () as qid, unnest({_TERMS}) as term from benchmark),
asked as (select item_id, qid, term, count(*)::bigint as times from items group by all),
scored as (
  select qid, item_id, uid, doc_id, sum(
    times * floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * df + 1)))::bigint
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length)))
  )::bigint as score
  from asked join df using (term) join tf using (term), whole group by all),
ranked as (
  select *, row_number() over (
    partition by qid order by score desc, doc_id nulls last, uid) as rank
  from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return f"sha256({' || '.join([*fields, _field(text)])})"


#: CRC-32 of an id's decimal text, bit by bit.
_CRC = """
  4294967295 - list_reduce([4294967295::bigint] || flatten(list_transform(
    string_split(coalesce(doc_id::varchar, ''), ''),
    lambda c: list_transform(range(8), lambda j: (ascii(c)::bigint >> j) & 1))),
    lambda a, b: xor(a >> 1, (xor(a, b) & 1) * 3988292384))
"""

#: Both trees level by level, each leaf's siblings, and the fold of the changed leaf.
OP13 = f"""
with recursive leaves as (
  select doc_id, source, {_leaf("text")} as leaf,
    case when ({_CRC}) % 2 = 0 then {_leaf("replace(text, chr(10), '')")}
         else {_leaf("text")} end as shown
  from documents),
placed as (
  select *, dense_rank() over (order by source nulls first) - 1 as tree,
    row_number() over (partition by source order by doc_id nulls first, leaf, shown) - 1 as pos,
    count(*) over (partition by source) as n
  from leaves),
nodes as (
  select tree, 0 as lvl, pos, n, leaf as h from placed
  union all
  select tree, lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' order by pos))
  from nodes where n > 1 group by tree, lvl, pos // 3),
subroots as (select tree, h as subroot from nodes where n = 1),
tops as (
  select 0 as lvl, tree as pos, count(*) over () as n, subroot as h from subroots
  union all
  select lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' order by pos))
  from tops where n > 1 group by lvl, pos // 3),
every as (
  select tree, lvl, pos, h, n from nodes where n > 1
  union all
  select null, lvl, pos, h, n from tops where n > 1),
steps as (
  select p.tree, p.pos, e.lvl, p.pos // (3 ** e.lvl)::bigint as own, e.pos as place, e.h
  from placed p join every e
    on e.tree = p.tree and e.pos // 3 = p.pos // (3 ** (e.lvl + 1))::bigint
  union all
  select p.tree, p.pos, 1000 + e.lvl, p.tree // (3 ** e.lvl)::bigint, e.pos, e.h
  from placed p join every e
    on e.tree is null and e.pos // 3 = p.tree // (3 ** (e.lvl + 1))::bigint),
sides as (
  select tree, pos, lvl,
    coalesce(string_agg(h, '' order by place) filter (place < own), '') as l,
    coalesce(string_agg(h, '' order by place) filter (place > own), '') as r
  from steps group by tree, pos, lvl),
paths as (
  select tree, pos, list({{l: l, r: r}} order by lvl) as path,
    sha256(string_agg(l || r, '' order by lvl)) as proof
  from sides group by tree, pos),
folded as (
  select p.*, coalesce(proof, sha256('')) as proof_sha256,
    list_reduce([{{l: shown, r: ''}}] || coalesce(path, []),
      lambda a, s: {{l: sha256(s.l || a.l || s.r), r: ''}}).l as folded_root
  from placed p left join paths using (tree, pos)),
root as (select h as root from tops where n = 1)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified
from folded join subroots using (tree), root
"""

ORACLE_SQL: dict[str, str] = {
    "op6_topk_search": OP6,
    "op10_minhash_dedup": OP10,
    "op11_lexical_search": OP11,
    "op13_merkle_manifest": OP13,
}
