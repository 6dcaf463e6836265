"""DuckDB statements for the operators that SQL can express."""

SQL = {}

SQL["op1_vector_near_duplicates"] = """
with recursive v as (
  select vec_id, label, embedding::double[] as e,
         sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as norm
  from embeddings where label is not null and embedding is not null),
links as (
  select a.vec_id as src, b.vec_id as dst from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where a.norm > 0 and b.norm > 0 and list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
walk as (
  select vec_id as node, vec_id as seen from embeddings
  union select w.node, l.dst from walk w join links l on l.src = w.seen)
select e.vec_id, (select count(*) from links l where l.src = e.vec_id) as n_links,
       w.component_id, w.component_id = e.vec_id as kept
from embeddings e join (select node, min(seen) as component_id from walk group by node) w on w.node = e.vec_id
"""

SQL["op2_warc_captures"] = """
with p as (
  select page_id, encode(coalesce(html, '')) as b, sha1(coalesce(html, '')) as d from pages),
g as (
  select page_id, octet_length(b) as n, d,
         case when octet_length(b) >= 1000 then max(page_id) over (partition by d, octet_length(b)) else page_id end as top
  from p)
select page_id, n::bigint as payload_bytes, d as payload_digest,
       case when page_id < top then 'revisit' else 'response' end as record_type,
       case when page_id < top then top end as refers_to
from g
"""

SQL["op4_repeated_passages"] = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
n as (select doc_id, ws, len(ws) as n_words from w),
s as (
  select doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) as k
  from (select doc_id, ws, unnest(generate_series(1, n_words - 34)) as i from n where n_words >= 35)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by k) as c from s) where c > 1),
c as (select distinct doc_id, unnest(generate_series(i, i + 34)) as j from r),
h as (select doc_id, list(j) as js, count(*) as n_removed from c group by doc_id)
select n.doc_id, n_words::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(generate_series(1, n_words), lambda x: not list_contains(coalesce(js, []::bigint[]), x)), lambda x: ws[x]), ' '), '')) as kept_sha256
from n left join h using (doc_id)
"""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op5_decontamination"] = rf"""
with d as (
  select doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
win as (
  select distinct item_id, m, array_to_string(ws[i:i + m - 1], ' ') as k
  from (select item_id, ws, least(13, len(ws)) as m, unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) as i
        from b where len(ws) > 0)),
sizes as (select distinct m from win),
pos as (
  select doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') as k
  from (select doc_id, ws, m, unnest(generate_series(1, len(ws) - m + 1)) as i from d, sizes where len(ws) >= m)),
hit as (select doc_id, item_id, i, win.m from pos join win on pos.k = win.k and pos.m = win.m),
covered as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(generate_series(i, i + m - 1)) as j from hit) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as s
  from (select distinct doc_id, item_id::varchar as item from hit) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join covered using (doc_id) left join items using (doc_id)
"""

SQL["op6_minhash_near_duplicates"] = rf"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') as ws from documents),
sh as (
  select doc_id, md5(array_to_string(ws[i:i + 4], ' ')) as k
  from (select doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) as i from w where len(ws) > 0)),
st as (select distinct doc_id, k from sh),
n as (select doc_id, count(*) as c from st group by doc_id),
often as (select k from st group by k having count(*) > 1),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from st a join often using (k) join st b on a.k = b.k and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from common join n p on p.doc_id = x join n q on q.doc_id = y where 100 * common.c >= 85 * (p.c + q.c - common.c)),
edges as (select x as src, y as dst from links union select y, x from links),
walk as (
  select doc_id as node, doc_id as seen from documents
  union select walk.node, edges.dst from walk join edges on edges.src = walk.seen)
select d.doc_id, coalesce(n.c, 0)::bigint as n_shingles, m.component_id, m.component_id = d.doc_id as kept
from documents d left join n using (doc_id) join (select node, min(seen) as component_id from walk group by node) m on m.node = d.doc_id
"""

_CRC_TABLE = """
crc as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end, i)) as t
)"""
_CRC = ("xor(4294967295, list_reduce(list_transform(string_split({0}::varchar, ''), lambda ch: ascii(ch)::bigint), "
        "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295))")

_FIELD = "coalesce(octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"

SQL["op11_merkle_manifest"] = rf"""
with recursive {_CRC_TABLE},
d as (
  select doc_id, coalesce('=' || lang, '-') as tree, {_LEAF.format(_FIELD.format('text'))} as leaf,
         case when {_CRC.format('doc_id')} % 3 = 0
              then {_LEAF.format(_FIELD.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))}
              else {_LEAF.format(_FIELD.format('text'))} end as now
  from documents, crc),
n as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos from d),
up as (
  select tree, 0 as level, list(leaf order by pos) as nodes from n group by tree
  union all
  select tree, level + 1, list_transform(range(ceil(len(nodes) / 8)::bigint), lambda r: sha256(array_to_string(nodes[r * 8 + 1:r * 8 + 8], '')))
  from up where len(nodes) > 1),
sub as (select tree, nodes[1] as subroot, row_number() over (order by tree) - 1 as pos from up where len(nodes) = 1),
top as (
  select 0 as level, list(subroot order by pos) as nodes from sub
  union all
  select level + 1, list_transform(range(ceil(len(nodes) / 8)::bigint), lambda r: sha256(array_to_string(nodes[r * 8 + 1:r * 8 + 8], '')))
  from top where len(nodes) > 1),
sides as (
  select n.tree, n.doc_id, n.pos as id, level, nodes, (n.pos // pow(8, level)::bigint) as spot from n join up using (tree) where len(nodes) > 1
  union all
  select n.tree, n.doc_id, n.pos as id, 1000 + level, nodes, (sub.pos // pow(8, level)::bigint) as spot
  from n join sub using (tree), top where len(nodes) > 1),
path as (
  select tree, id, list(struct_pack(l := array_to_string(nodes[spot - spot % 8 + 1:spot], ''), r := array_to_string(nodes[spot + 2:spot - spot % 8 + 8], '')) order by level) as p
  from sides group by tree, id),
walk as (
  select n.tree, n.pos as id, 0 as k, now as node, coalesce(p, []) as p from n left join path on path.tree = n.tree and path.id = n.pos
  union all
  select tree, id, k + 1, sha256(p[k + 1].l || node || p[k + 1].r), p from walk where k < len(p))
select n.doc_id, n.leaf, sub.subroot, (select nodes[1] from top where len(nodes) = 1) as root,
       sha256(array_to_string(list_transform(w.p, lambda s: s.l || s.r), '')) as proof_sha256, w.node as folded_root,
       w.node = (select nodes[1] from top where len(nodes) = 1) as verified
from n join sub using (tree) join walk w on w.tree = n.tree and w.id = n.pos and w.k = len(w.p)
"""

SQL["op13_prefix_trie"] = rf"""
with {_CRC_TABLE},
own as (
  select conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) order by turn nulls first) as l
  from conversations group by conv_id),
h as (select conv_id, l, {_CRC.format('conv_id')} % 6 as h from own, crc),
built as (
  select h.conv_id, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) as l
  from h left join own b on b.conv_id = h.conv_id - h.conv_id % 100),
walk as (select conv_id, l, d, l[1:d] as p, d = len(l) as ends from (select conv_id, l, unnest(range(len(l) + 1)) as d from built)),
nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from walk group by p, d),
children as (select p[1:d - 1] as p, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
val as (
  select n.*, coalesce(n_children, 0) as n_children, (n_children is null)::bigint as leaf,
         case when n.d > 0 then (n_convs - 1) * len(n.p[n.d].x) else 0 end as saved
  from nodes n left join children c on c.d = n.d and c.p = n.p),
sums as (
  select p[1:e] as p, e as d, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
  from (select p, leaf, saved, unnest(range(d + 1)) as e from val) group by all)
select v.conv_id, v.d::bigint as depth, up.conv_id as parent_conv_id, v.n_convs, v.n_children::bigint as n_children, n_leaves, saved_tokens, v.ends_sha256
from val v join sums s on s.d = v.d and s.p = v.p left join nodes up on up.d = v.d - 1 and up.p = v.p[1:v.d - 1]
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '</turn>', '<\/turn>'), '<turn:', '<\turn:')"

SQL["op12_chat_tree"] = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations
  union all select -7, i, case i when 0 then 'user' else 'assistant' end, '\### Assistant: </turn> ok' from range(2) s(i)),
f as (
  select *, '<turn:' || replace({_ESCAPED.format('r')}, '>', '\>') || '>' || {_ESCAPED.format('x')} || '</turn>' || chr(10) as shown,
         r = 'assistant' as learned
  from t)
select conv_id, count(*) as n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn nulls first)) as turns_sha256,
       coalesce(sum(len(x)) filter (where learned), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(x, '' order by turn nulls first) filter (where learned), '')) as loss_sha256,
       sum(len(shown))::bigint as formatted_chars
from f group by conv_id
"""
