"""DuckDB twins of the store queries."""

from __future__ import annotations

from sftpipe.plans.oracle import _CSV_TEXT, _MISSING, QUOTES, _scored


def stores() -> dict[str, str]:
    return {
        "ingest_stream": f"""with {QUOTES},
held as (
  select doc_id as page_key, 'https://quotes.example/' || (doc_id // 2) as u, (doc_id + 2) % 3 as batch, lang <> 'es' as ok
  from documents),
done as (select * from held where batch = (select min(batch) from held h where h.u = held.u)),
kept as (
  select * from (select content_hash, u, batch, row_number() over (partition by content_hash order by batch, page_key, position) as n
    from found join done using (page_key)) where n = 1)
select 'record' as kind, content_hash as key, u as value from kept
union all select 'visited', u, case when arg_max(ok, page_key) then '1' else '0' end from done group by u
union all select distinct 'dead', u, '{_MISSING}' from done where not ok
union all select 'run', 'stream-' || b, (select count(*) from done where ok and batch = b) || ' '
  || (select count(*) from done where not ok and batch = b) || ' ' || (select count(*) from kept where batch = b)
from (select unnest([0, 1, 2]) as b)""",
        "scored_rounds": _scored("""
select doc_id, instruction, complexity, clarity, informativeness, _error, 2 as rounds from scored"""),
        "large_csv_round_trip": f"""
select doc_id::varchar as doc_id, {_CSV_TEXT} as text, lang,
  row_number() over (order by doc_id % 2, doc_id) - 1 as position from documents""",
    }
