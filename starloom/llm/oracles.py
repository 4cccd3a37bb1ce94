"""Checking SQL for the operators that SQL can express, written from their contracts."""

MIXING = r"""
with sized as (
  select doc_id, source,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) as source_rank
  from sized group by source),
weighted as (
  select *, case (source_rank - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight,
         3 * source_size as most
  from sources),
levels as (select *, cast(most as double) / weight as level from weighted),
filled as (
  select *,
         coalesce(sum(most) over (order by level, source_rank
                                  rows between unbounded preceding and 1 preceding), 0) as most_before,
         sum(weight) over (order by level, source_rank
                           rows between current row and unbounded following) as weight_left,
         sum(source_size) over () as budget
  from levels),
water as (
  select min_by((budget - most_before)::double / weight_left, (level, source_rank)) as water
  from filled where (budget - most_before)::double / weight_left <= level),
targets as (
  select source, source_rank, source_size,
         least(cast(most as double), coalesce(water * weight, cast(most as double))) as target
  from levels, water),
queued as (
  select s.doc_id, s.size, t.source_rank, t.source_size, t.target,
         sum(s.size) over (partition by t.source_rank order by md5(cast(s.doc_id as varchar)), s.doc_id
                           rows unbounded preceding) as upto,
         row_number() over (order by t.source_rank, md5(cast(s.doc_id as varchar)), s.doc_id) as nr
  from sized s join targets t on s.source is not distinct from t.source),
copies as (
  select doc_id, size, nr, nth, (nth * source_size + upto)::double / target as finish
  from queued, (values (0), (1), (2)) as n(nth)
  where size > 0 and target > 0 and nth * source_size + upto - size < target),
walked as (
  select *, sum(size) over (order by finish, nr, nth rows unbounded preceding) as words from copies),
taken as (
  select nr, cast(sum(size) as bigint) as taken from walked
  where words <= (select sum(target) from targets) group by nr)
select q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::bigint as taken
from queued q left join taken t on q.nr = t.nr
"""

LINES = r"""
with texts as (
  select doc_id, regexp_extract_all(text, '[^\n\r]+') as lines
  from documents),
lines as (select doc_id, unnest(range(1, len(lines) + 1)) as line, unnest(lines) as content from texts),
near as (
  select doc_id, line, content, lead(content, 1) over w as second, lead(content, 2) over w as third,
         len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) >= 5 as solid
  from lines window w as (partition by doc_id order by line)),
windows as (
  select doc_id, line, case when solid then 1 else 3 end as n,
         case when solid then content else concat_ws(chr(10), content, second, third) end as content
  from near where solid or third is not null),
found as (
  select doc_id, line, n,
         first_value(struct_pack(d := doc_id, l := line))
           over (partition by content order by doc_id, line) as first
  from windows),
matches as (
  select doc_id, line, n, first.d as from_id, first.l as from_line
  from found where first <> struct_pack(d := doc_id, l := line)),
over1 as (
  select m.doc_id, m.line, m.from_id, m.from_line from matches m
  join lines a on a.doc_id = m.doc_id and a.line = m.line - 1
  join lines b on b.doc_id = m.from_id and b.line = m.from_line - 1
  where a.content = b.content),
over2 as (
  select m.doc_id, m.line from over1 m
  join lines a on a.doc_id = m.doc_id and a.line = m.line - 2
  join lines b on b.doc_id = m.from_id and b.line = m.from_line - 2
  where a.content = b.content),
under1 as (
  select m.doc_id, m.line + m.n as line, m.from_id, m.from_line + m.n as from_line from matches m
  join lines a on a.doc_id = m.doc_id and a.line = m.line + m.n
  join lines b on b.doc_id = m.from_id and b.line = m.from_line + m.n
  where a.content = b.content),
under2 as (
  select m.doc_id, m.line + 1 as line from under1 m
  join lines a on a.doc_id = m.doc_id and a.line = m.line + 1
  join lines b on b.doc_id = m.from_id and b.line = m.from_line + 1
  where a.content = b.content),
gone as (
  select doc_id, line + k as line from matches, (values (0), (1), (2)) as steps(k) where k < n
  union select doc_id, line - 1 from over1
  union select doc_id, line - 2 from over2
  union select doc_id, line from under1
  union select doc_id, line from under2),
kept as (
  select l.doc_id, string_agg(l.content, chr(10) order by l.line) as content, count(*) as n
  from lines l anti join gone g on l.doc_id = g.doc_id and l.line = g.line group by l.doc_id)
select t.doc_id, coalesce(len(t.lines), 0)::bigint as n_lines,
       (coalesce(len(t.lines), 0) - coalesce(k.n, 0))::bigint as n_removed,
       sha256(coalesce(k.content, '')) as kept_sha256
from texts t left join kept k on t.doc_id = k.doc_id
"""

NEGATIVES = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor, b.vec_id as other, a.label = b.label as same,
         cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor, other as positive, score from scored where same
  qualify row_number() over (partition by anchor order by score desc, other) <= 5),
found as (
  select p.anchor as anchor_id, p.positive as positive_id, n.other as negative_id,
         p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor, p.positive order by n.score desc, n.other) as nr
  from positives p join scored n on n.anchor = p.anchor and not n.same
   and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score)
select anchor_id, positive_id, nr::int as rank, negative_id, positive_score, negative_score
from found where nr <= 10
"""

# The checksum is taken bit by bit: seven zeros follow each byte, one step for each bit.
TRIE = r"""
with ids as (
  select distinct conv_id as c from conversations where conv_id is not null),
headed as (
  select c, xor(4294967295::ubigint, list_reduce(
    list_prepend(4294967295::ubigint, flatten(list_transform(
      range(1, length(c::varchar) + 1),
      lambda i: list_prepend(ascii(substr(c::varchar, i::int, 1))::ubigint, list_value(0, 0, 0, 0, 0, 0, 0)::ubigint[])))),
    lambda a, x: case when xor(a, x) & 1 = 1 then xor(xor(a, x) >> 1, 3988292384::ubigint) else xor(a, x) >> 1 end
  )) % 9 as h
  from ids),
own as (
  select conv_id as c,
         list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
              order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
rebuilt as (
  select h.c, list_concat(coalesce(b.turns[1:h.h::bigint], []), o.turns[h.h::bigint + 1:]) as turns
  from headed h join own o on o.c = h.c left join own b on b.c = h.c - h.c % 5),
prefixes as (
  select c, unnest(range(0, len(turns) + 1)) as depth, turns from rebuilt),
keyed as (
  select c, depth, turns[1:depth] as key, turns[1:depth - 1] as parent, depth = len(turns) as ends,
         coalesce(strlen(turns[depth].t), 0) as bytes from prefixes),
nodes as (
  select depth, key, any_value(parent) as parent, min(c) as conv_id, count(*) as n_convs,
         any_value(bytes) as bytes,
         string_agg(c::varchar, ',' order by c) filter (where ends) as ended
  from keyed group by depth, key),
counted as (
  select n.*, p.conv_id as parent_conv_id,
         (select count(*) from nodes k where k.depth = n.depth + 1 and k.parent = n.key) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.key = n.parent),
paths as (select k.c, k.depth, n.conv_id from keyed k join counted n using (depth, key)),
below as (
  select up.conv_id, up.depth, sum((n.n_convs - 1) * n.bytes)::bigint as saved_tokens,
         sum((n.n_children = 0)::bigint)::bigint as n_leaves
  from counted n join paths up on up.c = n.conv_id and up.depth <= n.depth
  group by up.conv_id, up.depth)
select n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens,
       sha256(coalesce(n.ended, '')) as ends_sha256
from counted n join below b on b.conv_id = n.conv_id and b.depth = n.depth
"""

JACCARD = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, list_distinct(
    case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from texts),
shingles as (select doc_id, unnest(s) as shingle, len(s) as n from sets),
shared as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as n_a, any_value(b.n) as n_b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
links as (select a, b from shared where 100 * n >= 80 * (n_a + n_b - n)),
reach(doc_id, other) as (
  select doc_id, doc_id from sets
  union
  select l.b, r.other from reach r join links l on l.a = r.doc_id)
select s.doc_id, len(s.s)::bigint as n_shingles, min(r.other) as component_id
from sets s join reach r on r.doc_id = s.doc_id group by s.doc_id, s.s
"""
