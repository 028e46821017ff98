"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))

OP12 = f"""
with docs as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\\x{{80}}-\\x{{10FFFF}}]+') as found
  from documents
), hits as (
  select id, lang, source, unnest(found) as term from docs
), kept as (
  select lang, term, count(*) as lang_n from hits group by lang, term having count(distinct id) >= 3
), langs as (
  select lang, count(*) as terms, cast(sum(lang_n) as hugeint) as lang_total from kept group by lang
), groups as (select distinct lang, source from docs
), held as (
  select lang, source, term, count(*) as n from hits semi join kept using (lang, term) group by all
), totals as (
  select g.lang, g.source, coalesce(sum(n), 0)::hugeint as total
  from groups g left join held h on g.lang = h.lang and g.source = h.source group by all
), rated as (
  select t.lang, t.source, k.term, coalesce(h.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(h.n, 0) + 1)) // (t.total + l.terms) as p,
         1 + (1000000000::hugeint * (k.lang_n + 1)) // (l.lang_total + l.terms) as q
  from totals t join kept k using (lang) join langs l using (lang)
  left join held h on h.lang = t.lang and h.source = t.source and h.term = k.term
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from rated a join rated b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), every_pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
), over_lang as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from rated where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from every_pair union all select * from over_lang)
)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 200
"""

_SPACE = r"\x20\x09-\x0D"
_INSERTS = "(0,0,0,''),(1,1,0,''),(2,2,0,''),(3,3,0,''),(0,2,2,'I'),(0,3,4,'II'),(1,2,2,'I'),(1,3,4,'II'),(2,3,2,'I'),(3,2,2,'I')"
_STEPS = "(0,'s',1),(0,'u',2),(1,'u',2),(3,'u',2),(2,'a',3)"

# A walk over the rows of a conversation, with the best edits for each of the four states, instead of a chart over spans.
OP11 = f"""
with recursive damaged as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(flatten(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
           lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end,
           4294967295::bigint), 4294967295::bigint) % 20 as fate
  from conversations
), hurt as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
         case fate when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(case when fate = 3 then [1, 2] else [1] end) as copy
  from damaged where fate <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || text), copy) as pos from hurt
), rows as (
  select conv_id, turn, role, text, pos, left(role, 1) as initial,
         case when not regexp_matches(text, '[^{_SPACE}]') then 'blank'
              when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
              when not regexp_matches(text, '[.!?][{_SPACE}]*$') then 'truncated' else '' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by pos) as before,
         count(*) over (partition by conv_id) as n
  from placed
), inserts(p, q, cost, audit) as (values {_INSERTS}),
steps(p, initial, q) as (values {_STEPS}),
moves as (  -- what each row may become, from every state
  select r.conv_id, r.pos, s.p, s.q, 3 as cost, 'D' as edit from rows r, (select p, p as q from (values (0), (1), (2), (3)) t(p)) s
  union all
  select r.conv_id, r.pos, s.p, s.q, case fault when 'truncated' then 1 else 0 end, 'K' from rows r join steps s using (initial) where fault in ('', 'truncated')
  union all
  select r.conv_id, r.pos, s.p, s.q, 2 + case fault when 'truncated' then 1 else 0 end, 'R' from rows r join steps s on s.initial <> 's' where fault in ('', 'truncated')
), walk as (
  select distinct conv_id, 0::bigint as pos, 0 as state, '000000000' as best from rows
  union all
  select w.conv_id, m.pos, m.q, min(printf('%09d', left(w.best, 9)::int + i.cost + m.cost) || substr(w.best, 10) || i.audit || m.edit)
  from walk w join inserts i on i.p = w.state join moves m on m.conv_id is not distinct from w.conv_id and m.pos = w.pos + 1 and m.p = i.q
  group by w.conv_id, m.pos, m.q
), repairs as (
  select w.conv_id, min(printf('%09d', left(best, 9)::int + i.cost) || substr(best, 10) || i.audit) as best
  from walk w join inserts i on i.p = w.state join (select distinct conv_id, n from rows) s on s.conv_id is not distinct from w.conv_id and s.n = w.pos
  where i.q = 3 or (i.p = 0 and i.q = 0) group by w.conv_id
), letters as (
  select conv_id, substr(best, 10) as audit, unnest(string_split(substr(best, 10), '')) as edit, generate_subscripts(string_split(substr(best, 10), ''), 1) as step from repairs
), counted as (
  select *, count(*) filter (edit <> 'I') over w as pos, count(*) filter (edit <> 'D') over w as place,
         count(*) filter (edit <> 'D') over (partition by conv_id) % 2 as system
  from letters window w as (partition by conv_id order by step)
), lines as (
  select c.conv_id, c.step,
         case when c.edit = 'K' then r.role when (c.place - 1 - c.system) % 2 = 0 then 'user' else 'assistant' end || ':' || case when c.edit = 'I' then '' else r.text end as line
  from counted c left join rows r on r.conv_id is not distinct from c.conv_id and r.pos = c.pos where c.edit <> 'D'
), texts as (select conv_id, string_agg(line, chr(10) order by step) as whole from lines group by conv_id),
facts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from rows group by conv_id
)
select o.conv_id, coalesce(f.gaps, 0)::bigint as gaps, coalesce(f.blank, 0)::bigint as blank, coalesce(f.duplicate, 0)::bigint as duplicate,
       coalesce(f.truncated, 0)::bigint as truncated, coalesce(f.illegal, 0)::bigint as illegal,
       coalesce(left(r.best, 9)::bigint, 0) as cost, coalesce(substr(r.best, 10), '') as audit, sha256(coalesce(t.whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join facts f on f.conv_id is not distinct from o.conv_id
left join repairs r on r.conv_id is not distinct from o.conv_id
left join texts t on t.conv_id is not distinct from o.conv_id
"""

# Every string of 400 bytes by its hash, counted over all documents; texts as hexadecimal digits, two a byte.
OP13 = """
with docs as (
  select row_number() over () as id, doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as digits from documents
), starts as (
  select id, unnest(range(1, len(digits) // 2 - 398)) as pos, encode(digits) as data from docs where len(digits) >= 800
), strings as (
  select id, pos, md5(data[2 * pos - 1:2 * pos + 798]) as name from starts
), again as (
  select id, pos from strings where name in (select name from strings group by name having count(*) > 1)
), parted as (
  select id, pos, case when pos - lag(pos) over (partition by id order by pos) <= 400 then 0 else 1 end as fresh from again
), runs as (
  select id, min(pos) as first, max(pos) + 400 as after
  from (select *, sum(fresh) over (partition by id order by pos) as run from parted) group by id, run
), gaps as (
  select id, lag(after, 1, 1) over (partition by id order by first) as first, first as after, 0 as tail from runs
  union all select id, max(after), null, 1 from runs group by id
), left_over as (
  select g.id, string_agg(digits[2 * g.first - 1:case when tail = 1 then len(digits) else 2 * g.after - 2 end], '' order by g.first, tail) as digits
  from gaps g join docs using (id) group by g.id
), sums as (select id, sum(after - first)::bigint as n_removed, count(*) as n_spans from runs group by id)
select d.doc_id, (len(d.digits) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(l.digits, d.digits))) as kept_sha256
from docs d left join sums s using (id) left join left_over l using (id)
"""

_WORD = r"[^\x20\x09-\x0D]+"

SHINGLE_COUNTS = f"""
with listed as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') as w from documents
)
select doc_id, case when len(w) = 0 then 0 when len(w) < 4 then 1
  else len(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) end::bigint as n_shingles
from listed
"""


def url_parts(rules) -> str:
    """Host, path and rule of every url; the longest rule that fits wins."""
    listed = ", ".join(f"('{text.split('/')[0]}', '/{text.split('/', 1)[1]}', '{text}')" for _, text in rules)
    return f"""
with rules(name, start, rule) as (values {listed}),
parts as (
  select page_id, coalesce(url, '') as url, contains(coalesce(url, ''), '://') as sound, substr(url, strpos(url, '://') + 3) as rest from pages
), split as (
  select page_id, case when sound then translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') else '' end as host,
         case when sound then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path
  from parts
)
select page_id, host, path, (
  select max_by(rule, length(rule)) from rules where (host = name or ends_with(host, '.' || name)) and starts_with(path, start)) as rule
from split
"""


EDITED_TEXTS = """
with docs as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
ordered as (
  select *, coalesce(lead(text) over (order by doc_id desc nulls last), first_value(text) over (order by doc_id desc nulls last)) as following from docs
)
select doc_id, n as n_chars, sha256(left(text, n - n // 2) || left(following, n // 2)) as edited_sha256
from (select doc_id, n, case when length(following) < n // 2 then left(text, n - n // 2) else text end as text, following from ordered)
"""

MIXING_TARGETS = f"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size from documents),
sources as (select source, sum(size)::double as source_size from sized group by source),
ranked as (
  select *, 3 * source_size as cap, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end as weight from sources
), raised as (  -- sources reach their caps in the order of cap / weight
  select *, (sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (o rows between current row and unbounded following) as level
  from ranked window o as (order by cap / weight, source)
), chosen as (select first(level order by cap / weight, source) as level from raised where level <= cap / weight)
select d.doc_id, d.size, r.source_size::bigint as source_size, round(least(r.cap, r.weight * c.level), 3) as target
from sized d join ranked r on r.source is not distinct from d.source, chosen c
"""
