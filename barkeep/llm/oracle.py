"""SQL twins of the queries that SQL can express."""

OP3 = """
with v as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), pairs as (
  select a.vec_id as query_id, b.vec_id,
         cast(list_inner_product(cast(a.q as double[]), cast(b.q as double[])) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id
  where a.vec_id % 20 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
       vec_id, score
from pairs
qualify rank <= 20
"""

OP8 = """
with turns as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
), rolled as (
  select conv_id, turn,
         string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '')
           over (partition by conv_id order by turn, role, text rows unbounded preceding) as prefix,
         count(*) over (partition by conv_id) as n,
         row_number() over (partition by conv_id order by turn, role, text) as place
  from turns
), whole as (
  select min(conv_id) as conv_id, n as n_turns, prefix as text from rolled where place = n group by n, prefix
)
select conv_id, n_turns, text from whole
where text not in (select prefix from rolled where place < n)
"""

# Every prefix as the text of its turns' digests; CRC-32 is folded bit by bit.
OP12 = """
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as place
  from conversations where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 5 as base, (4294967295 - list_reduce(
      list_concat([4294967295], [ascii(ch) for ch in string_split(cast(conv_id as varchar), '')]),
      lambda crc, byte: list_reduce([xor(crc, cast(byte as bigint)), 0, 0, 0, 0, 0, 0, 0, 0],
                                    lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 9 as head
  from turns group by conv_id
), rebuilt as (
  select conv_id, row_number() over (partition by conv_id order by second, place) as place,
         md5(length(role) || ':' || role || text) as id, strlen(text) as bytes
  from (
    select c.conv_id, false as second, t.place, t.role, t.text
    from convs c join turns t on t.conv_id = c.base and t.place <= c.head
    union all
    select c.conv_id, true, t.place, t.role, t.text
    from convs c join turns t on t.conv_id = c.conv_id and t.place > c.head
  )
), prefixes as (
  select conv_id, place as depth, bytes, string_agg(id, '') over (partition by conv_id order by place) as path from rebuilt
  union all
  select conv_id, 0, 0, '' from convs
), lengths as (
  select conv_id, max(depth) as length from prefixes group by conv_id
), nodes as (
  select path, depth, min(p.conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
         sha256(coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) filter (where depth = length), '')) as ends_sha256
  from prefixes p join lengths l on p.conv_id = l.conv_id
  group by path, depth
), children as (
  select left(path, length(path) - 32) as path, count(*) as n from nodes where depth > 0 group by 1
)
select n.conv_id, n.depth, any_value(p.conv_id) as parent_conv_id, n.n_convs, coalesce(any_value(c.n), 0) as n_children,
       count(*) filter (where below.path not in (select path from children)) as n_leaves,
       cast(sum((below.n_convs - 1) * below.bytes) as bigint) as saved_tokens, n.ends_sha256
from nodes n
join nodes below on starts_with(below.path, n.path)
left join nodes p on n.depth > 0 and p.path = left(n.path, length(n.path) - 32)
left join children c on c.path = n.path
group by n.path, n.conv_id, n.depth, n.n_convs, n.ends_sha256
"""

ORACLE = {"op3_exact_topk": OP3, "op8_chat_format": OP8, "op12_conversation_trie": OP12}
