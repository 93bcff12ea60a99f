"""SQL counterparts of the text operators that SQL can express."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The checksum is taken byte by byte with a table made by its rule; near words share a
#: form with one letter left out at some place.
SPELLING = f"""
with recursive checks as (
  select list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) s(i)
), runs as (
  select doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) as run from documents
), per_doc as (
  select doc_id, run, count(*) as k, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as named
  from runs group by doc_id, run
), marked as (
  select run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(named) // 2),
    lambda i: 16 * (strpos('0123456789ABCDEF', named[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', named[2 * i + 2]) - 1)),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) as h
  from per_doc, checks
), words as (
  select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word,
    cast(sum(k) as bigint) as n
  from marked group by 1 having sum(k) >= 3 and length(word) >= 5
), shorter as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from words, unnest(range(1, length(word) + 1)) s(i)
), pairs as (
  select a.word, b.word as other, b.n as other_n from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.rest, a.word, a.n from shorter a join words b on a.rest = b.word
  union select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
), best as (
  select word, count(*) as n_near, max(other_n) as top,
    (list(other order by other_n desc, other))[1] as other from pairs group by word
), formed as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near,
    case when b.top >= 2 * w.n then b.other end as form, case when b.top >= 2 * w.n then b.top end as form_n
  from words w left join best b on w.word = b.word
), chain as (
  select word as start, word as here, 0 as steps from formed
  union all select c.start, f.form, c.steps + 1 from chain c join formed f on c.here = f.word where f.form is not null
), ends as (select start, arg_max(here, steps) as root from chain group by start)
select f.word, f.form, e.root, f.n, cast(f.n_near as bigint) as n_near, f.form_n
from formed f join ends e on f.word = e.start
"""

PHRASES = f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents
), texts as (
  select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as words from pieces
), phrases as (
  select lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) as phrase
  from texts, range(1, 4) s(m)
), counted as materialized (
  select lang, m, phrase, cast(count(*) as hugeint) as f from phrases group by all
), found as materialized (
  select lang, m, phrase, string_split(phrase, ' ') as words, f as a from counted where m > 1 and f >= 10
), parts as materialized (
  select lang, m, phrase, a, k, array_to_string(words[1:k], ' ') as head, array_to_string(words[k + 1:m], ' ') as tail
  from found, range(1, 3) s(k) where k < m
), heads as materialized (
  select p.*, c.f as l from parts p join counted c on p.lang = c.lang and p.head = c.phrase
), cuts as (
  select p.*, c.f as r, (1000000 * a * a) // (l * c.f) as score
  from heads p join counted c on p.lang = c.lang and p.tail = c.phrase
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
  select lang, part, max(a) as most from (select lang, a, case k when 1 then tail else head end as part from parts where m = 3)
  group by lang, part
), kept as (
  select s.* from lowest s left join longer t on s.lang = t.lang and s.phrase = t.part and s.m = 2
  where t.most is null or 100 * t.most < 50 * s.a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as place from kept
), totals as (select lang, sum(f) as n from counted where m = 1 group by lang)
select r.lang, cast(place as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
  cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked r join totals t on r.lang = t.lang where place <= 2000
"""
