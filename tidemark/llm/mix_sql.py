"""SQL of the source mix, with another way to the water level and plain windows."""

from __future__ import annotations

from collections.abc import Sequence


def sql(weights: Sequence[int], most: int, seed: int) -> str:
    """The level is the one of all candidates (some sources with the smallest cap per
    weight full, the rest shared) at which the targets add up to the size of the corpus."""
    turn = " ".join(f"when {i} then {weight}" for i, weight in enumerate(weights))
    return rf"""
with sized as (
  select doc_id, source, md5(coalesce(text, '')) as digest,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents
), sources as (
  select source, sum(size) as source_size,
         case (row_number() over (order by source is null, source) - 1) % {len(weights)}
           {turn} end as weight
  from sized group by source
), marks as (
  select distinct {most} * source_size / weight as mark from sources
), levels as (
  select mark, (sum(source_size) - sum(case when {most} * source_size / weight < mark
                                       then {most} * source_size else 0 end))
           / cast(sum(case when {most} * source_size / weight >= mark then weight else 0 end)
                  as double) as level
  from marks, sources group by mark
), candidates as (
  select level, sum(least(level * weight, {most} * source_size)) as given
  from levels, sources group by level
), chosen as (
  select arg_min(level, abs(given - (select sum(source_size) from sources))) as level
  from candidates
), goals as (
  select source, source_size,
         cast(least(level * weight, {most} * source_size) as double) as target
  from sources, chosen
), shares as (
  select sized.*, source_size, target,
         case when source_size > 0
              then cast(floor(target / source_size * 1000000000000000) as bigint) else 0 end as share,
         cast('0x' || substr(md5(concat('{seed}', case when goals.source is not null
              then ':' || goals.source else '' end)), 1, 15) as bigint) % 1000000000000000 as start
  from sized join goals on sized.source is not distinct from goals.source
), placed as (
  select *, start + sum(cast(share as hugeint)) over (
    partition by source order by size, doc_id nulls first, digest
    rows between unbounded preceding and current row) as upto
  from shares
)
select doc_id, source, size, cast(source_size as bigint) as source_size, target,
       cast((upto // 1000000000000000 - (upto - share) // 1000000000000000) * size as bigint)
         as taken
from placed"""
