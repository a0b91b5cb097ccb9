"""SQL of the spelling variants: near words by equal remains after deleting a letter."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32: its polynomial, reversed, and the value that starts and ends it.
_POLYNOMIAL, _ONES = 3988292384, 4294967295


def sql(slip: int, least_letters: int, least_count: int, ratio: int) -> str:
    return rf"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(
    list_concat([i], range(8)),
    lambda c, k: case when c % 2 = 1 then xor(c // 2, {_POLYNOMIAL}) else c // 2 end)) as step
), counted as (
  select doc_id, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) as run
        from documents)
  group by doc_id, run
), hexed as (
  select doc_id, run, n, hex(concat(cast(doc_id as varchar), ':', run)) as code from counted
), hashed as (
  select run, n, xor(list_reduce(
    list_concat([cast({_ONES} as bigint)],
                list_transform(range(0, length(code), 2),
                               lambda i: cast('0x' || substr(code, i + 1, 2) as bigint))),
    lambda c, byte: xor(c // 256, step[cast(xor(c, byte) % 256 as bigint) + 1])), {_ONES}) as h
  from hexed, crc_table
), words as (
  select word, cast(sum(n) as bigint) as n
  from (
    select n, case when h % {slip} = 0
                   then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                   else run end as word
    from hashed
  )
  where length(word) >= {least_letters} group by word having sum(n) >= {least_count}
), deletions as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select a.word, b.word as near from deletions a join deletions b using (i, rest)
  where a.word <> b.word
  union
  select d.word, w.word from deletions d join words w on d.rest = w.word
  union
  select w.word, d.word from deletions d join words w on d.rest = w.word
), nearest as (
  select near.word, count(*) as n_near, max(w.n) as near_n,
         first(near.near order by w.n desc, near.near) as form
  from near join words w on w.word = near.near group by near.word
), related as (
  select word, case when near_n >= {ratio} * n then form end as form, n,
         coalesce(n_near, 0) as n_near, case when near_n >= {ratio} * n then near_n end as form_n
  from words left join nearest using (word)
), walked as (
  select word, word as at, form as next from related
  union all
  select walked.word, walked.next, related.form
  from walked join related on related.word = walked.next
)
select related.word, related.form, walked.at as root, related.n, related.n_near, related.form_n
from related join walked on walked.word = related.word and walked.next is null"""
