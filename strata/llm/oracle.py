"""SQL (DuckDB) for the queries of this subpackage that SQL can express. The others are tested against plain versions."""

from __future__ import annotations

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x20\\x09-\\x0D]+')"""

ORACLE: dict[str, str] = {
    "op1_chat_formatting": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked as (
  select *, '### ' || regexp_replace(role, '([\\#<:])', '\\\1', 'g') || ': ' || regexp_replace(text, '([\\#<])', '\\\1', 'g') || '</turn>' || chr(10) as shown
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(length(shown)) as bigint) as formatted_chars, false as rewrites_history
from marked group by conv_id""",
    "op2_ngram_jaccard_join": f"""
with recursive words as (select doc_id, {_WORDS} as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words),
tokens as (select doc_id, unnest(s) as t from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id group by all),
links as (
  select p.a, p.b from pairs p join sets x on x.doc_id = p.a join sets y on y.doc_id = p.b
  where 100 * p.n >= 75 * (len(x.s) + len(y.s) - p.n)),
both_ways as (select a, b from links union select b, a from links),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join both_ways l on r.b = l.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.component_id
from sets s join (select a, min(b) as component_id from reach group by a) m on m.a = s.doc_id""",
    "op4_warc_index": """
with sized as (select page_id, coalesce(html, '') as h, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages),
firsts as (select h, min(page_id) as original from sized group by h)
select s.page_id, cast(s.n as bigint) as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(s.d, 1 + 5 * (i // 4), 5))::integer >> (15 - 5 * (i % 4))) & 31)::integer, 1)),
    'string_agg', '') as payload_digest,
  case when f.original = s.page_id then 'response' else 'revisit' end as record_type,
  case when f.original = s.page_id then null else f.original end as refers_to
from sized s join firsts f on f.h = s.h""",
    "op10_repeat_removal": """
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as x, strlen(coalesce(text, '')) as n from documents),
starts as (select doc_id, unnest(range(0, n - 399)) as i from texts where n >= 400),
strings as (select s.doc_id, s.i, md5(substr(t.x, 1 + 2 * s.i, 800)) as m from starts s join texts t using (doc_id)),
often as (select m from strings group by m having count(*) > 1),
hits as (select s.doc_id, s.i from strings s join often using (m)),
marked as (select doc_id, i, case when i - lag(i) over w <= 400 then 0 else 1 end as fresh from hits window w as (partition by doc_id order by i)),
runs as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run from marked),
spans as (select doc_id, run, min(i) as a, max(i) + 400 as b from runs group by doc_id, run),
edges as (
  select doc_id, a as until, lag(b, 1, 0) over (partition by doc_id order by a) as since from spans
  union all select doc_id, n, coalesce((select max(b) from spans s where s.doc_id = t.doc_id), 0) from texts t),
kept as (
  select e.doc_id, string_agg(substr(t.x, 1 + 2 * cast(since as bigint), 2 * cast(until - since as bigint)), '' order by since) as x
  from edges e join texts t using (doc_id) group by e.doc_id)
select t.doc_id, cast(t.n as bigint) as n_bytes, cast(coalesce(r.n, 0) as bigint) as n_removed, cast(coalesce(r.k, 0) as bigint) as n_spans,
  sha256(unhex(k.x)) as kept_sha256, cast(t.n - coalesce(r.n, 0) as bigint) as n_kept
from texts t join kept k using (doc_id) left join (select doc_id, sum(b - a) as n, count(*) as k from spans group by doc_id) r using (doc_id)""",
    "op11_conversation_trie": """
with turns as (
  select conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} as said,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos from conversations where conv_id is not null),
own as (select conv_id, list(said order by pos) as s from turns group by conv_id),
lead as (
  select conv_id, s, conv_id - conv_id % 20 as base, xor(list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(cast(conv_id as varchar), ''), lambda ch: ascii(ch)::bigint)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0::bigint, 0, 0, 0, 0, 0, 0, 0],
      lambda x, i: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint) % 4 as h from own),
rebuilt as (
  select l.conv_id, list_concat(coalesce(b.s, [])[1:l.h], l.s[l.h + 1:]) as s from lead l left join own b on b.conv_id = l.base),
prefixes as (select conv_id, len(s) as n, unnest(range(0, len(s) + 1)) as depth, s from rebuilt),
nodes as (
  select s[1:depth] as p, depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where n = depth), '')) as ends_sha256
  from prefixes group by s[1:depth], depth),
kids as (select p[1:depth - 1] as p, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
sized as (
  select n.*, coalesce(k.n_children, 0) as n_children,
    case when n.depth = 0 then 0 else (n.n_convs - 1) * len(regexp_extract_all(n.p[n.depth].t, '[^\\x20\\x09-\\x0D]+')) end as saved
  from nodes n left join kids k on k.depth = n.depth and k.p = n.p),
upward as (select p, depth, unnest(range(0, depth + 1)) as above, saved, n_children from sized),
subtrees as (
  select p[1:above] as p, above as depth, sum(saved) as saved_tokens, sum(case when n_children = 0 then 1 else 0 end) as n_leaves from upward group by all)
select n.conv_id, n.depth, o.conv_id as parent_conv_id, n.n_convs, n.n_children, cast(t.n_leaves as bigint) as n_leaves,
  cast(t.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from sized n join subtrees t on t.depth = n.depth and t.p = n.p left join nodes o on o.depth = n.depth - 1 and o.p = n.p[1:n.depth - 1]""",
    "op13_content_sort": """
with bodies as (
  select doc_id, length(coalesce(text, '')) as c, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') as b from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by b) as group_size, row_number() over w = 1 as kept, sha256(b) as text_sha256
from bodies window w as (partition by b order by c desc, doc_id)""",
}
