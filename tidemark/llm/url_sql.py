"""The template tree of url_templates as SQL."""

from __future__ import annotations

from tidemark.llm import url_templates as u


def sql(rules: list[u.Rule]) -> str:
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def chain(part) -> str:
        cases = " ".join(
            f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') "
            f"then '{part(h, p, v)}'"
            for h, p, v in ordered
        )
        return f"case {cases} end"

    levels = ""
    for d in range(u.MAX_DEPTH):
        levels += f""", seg{d} as (
  select *, coalesce(segs[{d + 1}], '') as segment from tree{d}
), child{d} as (
  select host, template, segment, sum(labelled) as l, sum(bad) as b
  from seg{d} group by all
), node{d} as (
  select host, template, count(*) as branches, sum(l) as al, sum(b) as ab
  from child{d} group by all
), choice{d} as (
  select host, template, segment,
    case when segment = '' then ''
         when branches <= {u.MAX_BRANCHES} and l >= {u.MIN_LABELLED}
           and pow(b - l * (ab / greatest(al, 1)), 2)
             > {u.SIGNIFICANT**2!r}::double * l * (ab / greatest(al, 1)) * (1 - ab / greatest(al, 1))
         then '/' || segment else '/*' end as branch
  from child{d} join node{d} using (host, template)
), tree{d + 1} as (
  select host, segs, labelled, bad, template || branch as template
  from seg{d} join choice{d} using (host, template, segment)
)"""
    return rf"""
with rests as (
  select page_id, case when strpos(url, '://') > 0
    then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), raw as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as h from rests
), parsed as (
  select page_id, translate(h, '{u._UPPER}', '{u._LOWER}') as host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') as path from raw
), shaped as (
  select page_id, host, path,
    list_transform(list_filter(string_split(path, '/'), lambda s: s <> '')[1:{u.MAX_DEPTH}],
                   lambda s: regexp_replace(s, '[0-9]+', '#', 'g')) as segs,
    try_cast(nullif(regexp_extract(path, '([0-9]{{1,18}})[^0-9/]*/?\z', 1), '') as bigint)
      as number
  from parsed
), page_labels as (
  select doc_id as number,
    max(case when coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1 then 1 else 0 end) as bad
  from labels where quality is not null or toxic is not null group by doc_id
), tree0 as (
  select host, segs, count(page_labels.bad)::double as labelled,
         coalesce(sum(page_labels.bad), 0)::double as bad, '' as template
  from shaped left join page_labels using (number) group by host, segs
){levels}, leaf as (
  select host, template, sum(labelled) as l, sum(bad) as b from tree{u.MAX_DEPTH} group by all
), hosts as (
  select host, sum(l) as hl, sum(b) as hb from leaf group by all
), every as (
  select case when sum(hl) > 0 then sum(hb) / sum(hl) else 0 end as overall from hosts
), purity as (
  select host, template, 1 - (b + {u.SMOOTHING} * ((hb + {u.SMOOTHING} * overall)
    / (hl + {u.SMOOTHING}))) / (l + {u.SMOOTHING}) as purity
  from leaf join hosts using (host), every
)
select page_id, host, path, {chain(lambda h, p, v: h + p)} as rule,
  coalesce({chain(lambda h, p, v: v)}, case when purity < {u.PURITY} then 'block' else 'allow' end)
    as verdict, template, round(purity, 6) as purity
from shaped join tree{u.MAX_DEPTH} using (host, segs) join purity using (host, template)"""
