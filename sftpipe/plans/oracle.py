"""The registered queries as DuckDB SQL over the same tables, written independently."""

from __future__ import annotations

from sftpipe.functions.minhash import BASE, PRIME, permutation_coefficients
from sftpipe.plans.checks import RULE

# Fixed values, stated here again so that a slip on the other side shows.
PROMPT_HEAD = """你是一名严格的法律数据质量评审。请对下面这条"法律问答"从三个维度打分(1-5 分,5 最好):
- complexity:问题的专业性/复杂度(越是真实、有难度的法律问题分越高)
- clarity:答案表达是否清晰、有条理
- informativeness:答案信息量是否充足、是否真正解决问题

只输出一个 JSON,不要任何多余文字,格式:
{"complexity": 整数, "clarity": 整数, "informativeness": 整数, "reason": "一句话理由"}

【问题】"""
PROMPT_MIDDLE = "\n【答案】"
NO_TAGS = "无"
NUM_PERM, BANDS, ROWS = 64, 5, 11
SPACE_POINTS = [
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
]

# Whitespace left after control removal, as an RE2 class.
_SPACES = (
    r"[\t\n\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_STRIP = "||".join(f"chr({c})" for c in SPACE_POINTS)


def _clean(c: str) -> str:
    no_control = rf"regexp_replace(coalesce({c}, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"
    return f"trim(regexp_replace({no_control}, '{_SPACES}', ' ', 'g'))"


def _ratio(c: str, letters: str) -> str:
    return (
        f"coalesce(length(regexp_replace({c}, '[^{letters}]', '', 'g'))"
        f" / nullif(length({c}), 0)::double, 0.0)"
    )


DOCUMENT_PAIRS = """
raw as (
  select doc_id as k,
    case when instr(text, '.') > 0 then substr(text, 1, instr(text, '.') - 1) else text end as question,
    case when instr(text, '.') > 0 then substr(text, instr(text, '.') + 1) else '' end as answer
  from documents)"""

CONVERSATION_PAIRS = """
raw as (
  select conv_id * 4294967296 + turn as k, text as question, next_text as answer
  from (select *, lead(role) over w as next_role, lead(text) over w as next_text
        from conversations window w as (partition by conv_id order by turn))
  where role = 'user' and next_role = 'assistant')"""

CLEANED = f"""
clean as (
  select k, {_clean('question')} as question, {_clean('answer')} as answer from raw),
full_pairs as (select * from clean where question <> '' and answer <> '')"""


def _hashes(source: str, text: str) -> str:
    """CTE ``hashes(k, h)``: the distinct shingle hashes of ``text``."""
    window = "c[i]"
    for j in range(1, 5):
        window = f"(({window}) * {BASE} + c[i + {j}]) % {PRIME}"
    return f"""
points as (
  select k, list_transform(string_split(replace({text}, ' ', ''), ''),
                           lambda x: unicode(x)::bigint) as c
  from {source}),
hashes as (
  select distinct k, unnest(
    case when len(c) < 5
      then [list_reduce(list_prepend(0::bigint, c), lambda x, y: (x * {BASE} + y) % {PRIME})]
      else list_transform(range(1, len(c) - 3), lambda i: {window}) end) as h
  from points)"""


def _minima(n: int) -> str:
    columns = ",\n    ".join(
        f"min(({a}::hugeint * h + {b}::hugeint) % 18446744073709551616::hugeint // 4294967296) as m{i}"
        for i, (a, b) in enumerate(permutation_coefficients(n))
    )
    return f"minima as (\n  select k,\n    {columns}\n  from hashes group by k)"


def _buckets() -> str:
    def key(band: int) -> str:
        minima = ", ".join(f"m{band * ROWS + i}" for i in range(ROWS))
        return f"select k, {band}::bigint as band, md5(concat_ws(',', {band}, {minima})) as bucket from minima"

    return "buckets as materialized (\n  " + "\n  union all ".join(map(key, range(BANDS))) + ")"


FIRST_WINS = """
survivors as (
  select min(k) as k from full_pairs group by md5(question || chr(1) || answer)),
entries as (select buckets.* from buckets join survivors using (k)),
scan as (
  select 0 as round, k, bucket, 'live' as state from entries
  union all
  select round + 1, k, bucket,
    case when kept then 'kept' when lost then 'lost' else 'live' end
  from (
    select *, bool_and(first = k) over (partition by k) as kept,
      bool_or(claimed and first <> k) over (partition by k) as lost
    from (
      select *, bool_or(leads and first = k) over (partition by bucket) as claimed
      from (
        select *, bool_and(first = k) over (partition by k) as leads
        from (select *, min(k) over (partition by bucket) as first
              from scan where state = 'live'))))),
near as (select distinct k from scan where state = 'kept')"""

STAGED = f"""
staged as (
  select clean.k, question, answer,
    length(question) as question_chars, length(answer) as answer_chars,
    case when question = '' or answer = '' then 'empty'
      when survivors.k is null then 'exact_dup'
      when near.k is null then 'near_dup'
      when length(question) < {RULE.min_question_chars}
        or length(answer) < {RULE.min_answer_chars} or length(answer) > {RULE.max_answer_chars}
        or {_ratio('answer', chr(92) + 'p{L}')} < {RULE.min_script_ratio} then 'quality'
      else 'kept' end as drop_stage
  from clean left join survivors using (k) left join near using (k))"""


def _build(pairs: str, select: str) -> str:
    parts = [
        pairs,
        CLEANED,
        _hashes("full_pairs", "question || answer"),
        _minima(BANDS * ROWS),
        _buckets(),
        FIRST_WINS,
        STAGED,
    ]
    return "with recursive " + ",".join(parts) + "\n" + select


def _pairs(select: str) -> str:
    return f"with {DOCUMENT_PAIRS},{CLEANED}\n{select}"


def _object(complexity: str, clarity: str, rest: str) -> str:
    return f"""'{{"complexity": ' || {complexity} || ', "clarity": ' || {clarity} || {rest} || '}}'"""


_C, _L = "(n_chars % 5 + 1)", "(doc_id * 7 % 5 + 1)"
_INFO = """', "informativeness": ' || (coalesce(quality, 0) * 2 + doc_id % 3 + 1)"""
_REASON = """', "reason": "ok"'"""

RESPONSES = f"""
judged as (
  select doc_id, doc_id % 11 as trouble,
    case doc_id % 13
      when 0 then {_object(_C + " || '.5'", _L, _INFO + " || " + _REASON)}
      when 1 then {_object("'" + '"4"' + "'", _L, _INFO + " || " + _REASON)}
      when 2 then {_object("'true'", "'null'", _INFO + " || " + _REASON)}
      when 3 then {_object(_C, _L, _REASON)}
      when 4 then '{{"complexity": 5, "clarity": 4, "informativeness": 4, "output": "rewritten"}}'
      when 5 then {_object("9", _L, "', " + '"informativeness": 0' + "'")}
      when 6 then {_object(_C, _L, _INFO + " || ', " + '"reason": null, "output": null' + "'")}
      when 7 then {_object(_C, _L, _INFO + " || ', " + '"_error": null' + "'")}
      else {_object(_C, _L, _INFO + " || " + _REASON)} end as good
  from documents left join labels using (doc_id)),
responses as (
  select doc_id, 1 as attempt,
    case trouble when 0 then null when 1 then 'no scores today' when 2 then '[1, 2, 3]'
      when 4 then '{{"complexity": 3' else good end as content,
    case when trouble = 0 then 'HTTPError: 503 Server Error' end as error
  from judged where doc_id % 17 <> 5
  union all
  select doc_id, 2, case when doc_id % 2 = 0 then good when doc_id % 3 = 0 then '"fine"'
    else '{{"complexity": 3' end, null
  from judged where trouble < 3 and doc_id % 17 <> 5
  union all
  select doc_id, 4, good, null from judged where trouble = 4 or doc_id % 17 = 5),
checked as (
  select *, case when error is not null then error
    when not json_valid(content) then 'JSONDecodeError: the response is not valid JSON'
    when json_type(content) = 'ARRAY' then 'TypeError: ''list'' object is not a mapping'
    when json_type(content) = 'VARCHAR' then 'TypeError: ''str'' object is not a mapping' end as problem
  from responses),
picked as (
  select doc_id, arg_min(content, attempt) filter (where problem is null) as content,
    case when bool_and(problem is not null)
      then arg_max(problem, attempt) filter (where problem is not null) end as _error
  from checked group by doc_id)"""


def _number(field: str) -> str:
    path = f"'$.{field}'"
    return (
        f"case when json_type(content, {path}) in ('UBIGINT', 'BIGINT', 'DOUBLE')"
        f" then json_extract_string(content, {path})::double"
        f" when json_type(content, {path}) = 'BOOLEAN'"
        f" then case json_extract_string(content, {path}) when 'true' then 1.0 else 0.0 end"
        f" end::double as {field}"
    )


SCORED = f"""{DOCUMENT_PAIRS},{RESPONSES},
scored as materialized (
  select doc_id, question as instruction, '' as input,
    case when json_exists(content, '$.output') then json_extract_string(content, '$.output')
      else answer end as output, 'documents' as source,
    {_number('complexity')}, {_number('clarity')}, {_number('informativeness')},
    json_extract_string(content, '$.reason') as reason,
    case when json_exists(content, '$._error')
      then coalesce(json_extract_string(content, '$._error'), 'null') else _error end as _error
  from raw join picked on raw.k = picked.doc_id),
ok as (select *, (complexity + clarity + informativeness) / 3 as overall
       from scored where _error is null)"""


def _scored(select: str) -> str:
    return f"with {SCORED}\n{select}"


def _histogram(value: str, bins: int) -> str:
    return _scored(f"""
, v as (select ({value})::double as v from ok where ({value}) is not null),
w as (select min(v) - case when min(v) = max(v) then 0.5 else 0 end as lo,
             max(v) + case when min(v) = max(v) then 0.5 else 0 end as hi from v),
r as (select lo, hi, (hi - lo) / {bins} as step from w),
g as (select v, lo, hi, step, least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})::bigint as b
      from v, r),
p as (select case when v < lo + b * step then b - 1
                  when v >= lo + (b + 1) * step and b <> {bins - 1} then b + 1 else b end as bin
      from g)
select i as bin, lo + i * step as lo,
  case when i = {bins - 1} then hi else lo + (i + 1) * step end as hi,
  (select count(*) from p where p.bin = i) as rows
from r, range({bins}) as t(i)""".lstrip())


FUNNEL = """
select *,
  case when after_clean = 0 then 0.0 else (after_clean - after_exact) / after_clean::double * 100 end
    as exact_dup_pct,
  case when after_exact = 0 then 0.0 else (after_exact - after_near) / after_exact::double * 100 end
    as near_dup_pct,
  final_rows / nullif(raw_rows, 0)::double * 100 as yield_pct
from (
  select count(*) as raw_rows,
    count(*) filter (drop_stage <> 'empty') as after_clean,
    count(*) filter (drop_stage not in ('empty', 'exact_dup')) as after_exact,
    count(*) filter (drop_stage in ('quality', 'kept')) as after_near,
    count(*) filter (drop_stage = 'kept') as final_rows,
    avg(question_chars) filter (drop_stage = 'kept') as mean_question_chars,
    avg(answer_chars) filter (drop_stage = 'kept') as mean_answer_chars
  from staged)"""

_RECORDS = """
select k as {key}, question as instruction, '' as input, answer as output, '{source}' as source
from staged where drop_stage = 'kept'"""

_BY_STRIP = f"trim({{}}, {_STRIP})"

QUOTES = f"""{DOCUMENT_PAIRS},
quotes as (
  select k as page_key, 0 as position, lang, {_BY_STRIP.format('question')} || 'end' as t,
    '—— ' || {_BY_STRIP.format('source')} || '(标签:' || lang || ', text)' as answer
  from raw join documents on k = doc_id
  union all
  select k, 1, lang, answer, '—— anonymous(标签:{NO_TAGS})' from raw join documents on k = doc_id),
found as (
  select page_key, position, 'https://quotes.example/' || page_key as url, 'quotes_demo' as source,
    {_BY_STRIP.format('t')} as question, answer, lang,
    sha1({_BY_STRIP.format(_BY_STRIP.format('t') + ' || answer')}) as content_hash
  from quotes where lang <> 'es' and {_BY_STRIP.format('t')} <> ''),
stored as (select distinct content_hash from found where lang = 'de'),
fresh as (
  select * from (select *, row_number() over (partition by content_hash
                                              order by page_key, position) as n from found)
  where n = 1 and content_hash not in (select content_hash from stored))"""

_MISSING = "AttributeError: ''NoneType'' object has no attribute ''get_text''"

# The article's markup with its h1, comments, scripts and styles removed: tags with the
# white space around them go, entities are read.
_ARTICLE = (
    r"regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1),"
    r" '(?s)<h1>.*?</h1>|<!--.*?-->|<script.*?</script>|<style.*?</style>', '<b>', 'g')"
)


def _markup_text(markup: str) -> str:
    text = rf"regexp_replace({markup}, '(\s*<[^>]*>\s*)+', '', 'g')"
    for entity, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return f"trim({text}, {_STRIP})"


_CSV_TEXT = """case when doc_id % 10 in (3, 4) then null
  else replace(text, '. ', '",' || chr(10) || '"') end"""


def oracle() -> dict[str, str]:
    dims = ("complexity", "clarity", "informativeness")
    histogram_rows = " union all ".join(
        f"select '{d}' as dimension, s as score, count(*) filter ({d} = s) as rows,"
        f" (select sum({d}) filter ({d} in (1, 2, 3, 4, 5))"
        f" / nullif(count(*) filter ({d} in (1, 2, 3, 4, 5)), 0) from ok) as mean"
        f" from ok, (select unnest([1, 2, 3, 4, 5]) as s) group by s"
        for d in dims
    )
    profiled = ("text", "lang", "source", "n_chars", "quality", "toxic")
    published = "doc_id, instruction, input, output, source, complexity, clarity, informativeness"
    prompt = PROMPT_HEAD.replace("'", "''")
    return {
        "clean_documents": f"select doc_id, {_clean('text')} as text from documents",
        "normalize_columns": f"""
select doc_id, {_BY_STRIP.format('source')} as question, {_BY_STRIP.format('text')} as answer
from documents where {_BY_STRIP.format('source')} <> '' and {_BY_STRIP.format('text')} <> ''""",
        "drop_empty_pairs": _pairs("select k as doc_id, question, answer from full_pairs"),
        "exact_dedup": _pairs("""
select k as doc_id, question, answer, fingerprint
from (select *, md5(question || chr(1) || answer) as fingerprint,
        row_number() over (partition by md5(question || chr(1) || answer) order by k) as n
      from full_pairs) where n = 1"""),
        "ingest_fingerprint": f"""with {DOCUMENT_PAIRS}
select k as doc_id, sha1({_BY_STRIP.format('question || answer')}) as content_hash from raw""",
        "script_ratio": f"""
select doc_id, {_ratio('text', chr(92) + 'p{L}')} as letter_ratio,
  {_ratio('text', '一-鿿')} as han_ratio, length(text) as chars from documents""",
        "shingle_counts": """
select doc_id, case when length(t) < 5 then 1
  else len(list_distinct(list_transform(range(1, len(c) - 3),
         lambda i: c[i] || c[i + 1] || c[i + 2] || c[i + 3] || c[i + 4]))) end as shingles
from (select doc_id, replace(text, ' ', '') as t, string_split(replace(text, ' ', ''), '') as c
      from documents)""",
        "minhash_signatures": f"""
with docs as (select doc_id as k, text from documents),{_hashes('docs', 'text')},
{_minima(NUM_PERM)}
select k as doc_id, concat_ws(',', {', '.join(f'm{i}' for i in range(NUM_PERM))}) as minima
from minima""",
        "minhash_bands": f"""
with docs as (select doc_id as k, text from documents),{_hashes('docs', 'text')},
{_minima(BANDS * ROWS)},
{_buckets()}
select k as doc_id, band, bucket from buckets""",
        "lsh_buckets": f"""
with {DOCUMENT_PAIRS},{CLEANED},{_hashes('clean', 'question || answer')},
{_minima(BANDS * ROWS)},
{_buckets()}
select bucket, min(k) as first_key, count(*) as size from buckets group by bucket having count(*) > 1""",
        "near_dedup": _build(
            DOCUMENT_PAIRS, "select k as doc_id from staged where drop_stage in ('quality', 'kept')"
        ),
        "quality_filter": _pairs(f"""
select k as doc_id, question, answer from clean
where length(question) >= {RULE.min_question_chars}
  and length(answer) between {RULE.min_answer_chars} and {RULE.max_answer_chars}
  and {_ratio('answer', chr(92) + 'p{L}')} >= {RULE.min_script_ratio}"""),
        "drop_stage": _build(
            DOCUMENT_PAIRS,
            "select k as doc_id, drop_stage, question_chars, answer_chars from staged",
        ),
        "funnel_report": _build(DOCUMENT_PAIRS, FUNNEL),
        "document_records": _build(
            DOCUMENT_PAIRS, _RECORDS.format(key="doc_id", source="documents")
        ),
        "conversation_records": _build(
            CONVERSATION_PAIRS, _RECORDS.format(key="turn_key", source="conversations")
        ),
        "publish_fields": _scored(f"select {published} from ok"),
        "judge_prompts": f"""with {DOCUMENT_PAIRS}
select k as doc_id, '{prompt}' || question || '{PROMPT_MIDDLE}' || substr(answer, 1, 1500) as prompt
from raw""",
        "judge_picks": f"with {RESPONSES.lstrip()}\nselect doc_id, content, _error from picked",
        "judge_scores": _scored(f"select {published}, reason, _error from scored"),
        "score_resume": _scored("""
select k as doc_id, question as instruction from raw
where not exists (select 1 from ok where ok.instruction = raw.question)"""),
        "score_summary": _scored(
            "select count(*) filter (_error is null) as ok_rows,"
            " count(*) filter (_error is not null) as failed_rows, "
            + ", ".join(
                f"avg(coalesce({d}, 0)) filter (_error is null) as mean_{d}" for d in dims
            )
            + " from scored"
        ),
        "score_histogram": _scored(histogram_rows),
        "overall_histogram": _histogram("overall", 20),
        "high_quality": _scored("select doc_id, instruction, output from ok where overall >= 4"),
        "high_quality_share": _scored("""
select count(overall) as rated_rows, count(*) filter (overall >= 4) as high_rows,
  count(*) filter (overall >= 4) / nullif(count(overall), 0)::double * 100 as high_pct from ok"""),
        "question_length_histogram": _histogram("length(instruction)", 50),
        "answer_length_histogram": _histogram("length(output)", 50),
        "mean_lengths": _scored(
            "select avg(length(instruction)) as mean_question_chars,"
            " avg(length(output)) as mean_answer_chars from ok"
        ),
        "train_test_split": _scored("""
select doc_id, instruction, case when row_number() over (order by md5('42' || doc_id), doc_id) <= 50
  then 'test' else 'train' end as split from ok"""),
        "head_sample": "select * from documents order by doc_id limit 100",
        "seed_sample": f"with {DOCUMENT_PAIRS}\n"
        "select k as doc_id, question, answer from raw order by k limit 20000",
        "table_profile": "with t as (select d.* exclude (doc_id), quality, toxic"
        " from documents d left join labels using (doc_id)),\n"
        "n as (select count(*) as rows, (select count(*) from (select distinct * from t)) as"
        " distinct_rows from t)\n"
        + " union all ".join(
            f"select '{c}' as \"column\", (select count(*) - count({c}) from t) as nulls, rows,"
            f" {len(profiled)} as columns, distinct_rows, rows - distinct_rows as duplicates from n"
            for c in profiled
        ),
        "duplicate_rows": """
select n as rows, d as distinct_rows, n - d as duplicates
from (select count(*) as n from documents),
     (select count(*) as d from (select distinct text, lang, source, n_chars from documents))""",
        "quote_page_records": f"with {QUOTES}\n"
        "select page_key, position, url, source, question, answer from found",
        "book_rows": """
select doc_id as page_key, 0 as position, text as title, '£' || n_chars || '.00' as price,
  'In ' || lang || ' stock' as stock from documents where lang <> 'fr'""",
        "book_outcomes": f"""
select doc_id as page_key, 'https://books.example/' || doc_id as url, lang <> 'fr' as ok,
  case when lang = 'fr' then '{_MISSING}' end as error, case when lang <> 'fr' then 1 end as books
from documents""",
        "pages_by_site": f"""with {QUOTES}
select page_key, position, url, source, question, answer from found
union all
select -1 - page_id, 0, url, 'article_page', question, answer
from (select *, {_markup_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} as question,
        {_markup_text(_ARTICLE)} as answer from pages)
where question <> '' and answer <> ''""",
        "ingest_twice": f"""with {QUOTES},
held as (
  select doc_id as page_key, 'https://quotes.example/' || (doc_id // 2) as u, doc_id % 3 = 0 as late,
    lang <> 'es' as ok from documents),
done as (select * from held where not late or u not in (select u from held where not late)),
kept as (
  select * from (select content_hash, u, late,
      row_number() over (partition by content_hash order by late, page_key, position) as n
    from found join done using (page_key)) where n = 1)
select 'record' as kind, content_hash as key, u as value from kept
union all
select 'visited', u, case when arg_max(ok, page_key) then '1' else '0' end from done group by u
union all
select distinct 'dead', u, '{_MISSING}' from done where not ok
union all
select 'run', 'run ' || n_,
  (select count(*) from done where ok and late = (n_ = 2) and n_ <> 1)
  || ' ' || (select count(*) from done where not ok and late = (n_ = 2) and n_ <> 1)
  || ' ' || (select count(*) from kept where late = (n_ = 2) and n_ <> 1)
from (select unnest([0, 1, 2]) as n_)""",
        "csv_round_trip": f"""
select doc_id::varchar as doc_id, {_CSV_TEXT} as text, lang,
  row_number() over (order by doc_id % 2, doc_id) - 1 as position from documents""",
        "file_profile": f"""
with t as (select lang, source, {_CSV_TEXT} as text from documents),
n as (select lang, count(*) as rows, count(*) - count(source) as no_source, count(*) - count(text) as no_text
      from t group by lang),
d as (select lang, count(*) as distinct_rows from (select distinct * from t) group by lang)
select n.lang, x as "column", case x when 'text' then no_text else no_source end as nulls, rows,
  2 as columns, distinct_rows, rows - distinct_rows as duplicates
from n join d on n.lang is not distinct from d.lang, (select unnest(['source', 'text']) as x)""",
        "jsonl_round_trip": _scored("""
select instruction, input, output, source, complexity, clarity, informativeness, reason, _error,
  count(*) as copies, count(*) as places from scored group by all"""),
        "publish_from_disk": _build(DOCUMENT_PAIRS, """
select question as instruction, answer as output, (length(answer) % 5 + 1)::double as complexity,
  20 as test_rows from staged where drop_stage = 'kept' and length(answer) % 7 <> 0"""),
        "report_lines": _build(DOCUMENT_PAIRS, f"""
select unnest(['# Data quality report', '', '- raw rows: ' || raw_rows,
  '- after empty filter: ' || after_clean,
  '- after exact dedup: ' || after_exact || format(' ({{:.1f}}% removed)', exact_dup_pct),
  '- after near dedup: ' || after_near || format(' ({{:.1f}}% removed)', near_dup_pct),
  '- after quality filter: ' || final_rows, format('- overall yield: {{:.1f}}%', yield_pct),
  format('- mean question length: {{:.0f}}', mean_question_chars),
  format('- mean answer length: {{:.0f}}', mean_answer_chars)]) as line
from ({FUNNEL})"""),
        "split_sizes": _scored("""
select doc_id, case when row_number() over (order by md5('42' || doc_id), doc_id) <= 50
  then 'test' else 'train' end as split from ok"""),
        "seeded_shuffle": """
select doc_id, row_number() over (order by md5('42' || doc_id), doc_id) - 1 as position from documents""",
        "seed_sample_of_lines": """
select l_orderkey * 8 + l_linenumber as line, l_quantity from lineitem order by line limit 20000""",
        "distributions": f"""
select 'overall' as kind, bin as at, rows::double as value from ({_histogram("overall", 20)})
union all select 'question_chars', bin, rows from ({_histogram("length(instruction)", 50)})
union all select 'answer_chars', bin, rows from ({_histogram("length(output)", 50)})
union all ({_scored("""select 'high', count(*) filter (overall >= 4),
  count(*) filter (overall >= 4) / nullif(count(overall), 0)::double * 100 from ok""")})
union all ({_scored("select 'mean', 0, avg(length(output)) from ok")})
union all ({_scored("select 'clarity', s, count(*) filter (clarity = s) from ok,"
           " (select unnest([1, 2, 3, 4, 5]) as s) group by s")})""",
        "clean_odd_documents": f"select doc_id, {_clean("replace(text, 'o', 'o ')")} as text from documents",
        "han_ratio": f"""
select doc_id, {_ratio('text', 'aeiou')} as ratio,
  substr(translate(text, 'aeiou', '法律问答题'), 1, 500) as head from documents""",
        "article_page_records": f"""
select page_id as page_key, 0 as position, url, 'article_page' as source, question, answer
from (select *, {_markup_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} as question,
        {_markup_text(_ARTICLE)} as answer from pages)
where question <> '' and answer <> ''""",
        "pages_todo": """
select page_id as page_key, url from pages p
where not exists (select 1 from pages v where v.url = p.url and v.url like '%/fr/%')""",
        "content_unique_insert": f"with {QUOTES}\n"
        "select page_key, position, content_hash, question, answer from fresh",
        "page_outcomes": f"""
select 'https://quotes.example/' || doc_id as url, lang <> 'es' as ok,
  case when lang = 'es' then '{_MISSING}' end as error from documents""",
        "dead_letters": f"""
select 'https://quotes.example/' || doc_id as url, '{_MISSING}' as error
from documents where lang = 'es'""",
        "ingest_summary": f"""with {QUOTES}
select (select count(*) from documents where lang <> 'es') as ok_pages,
  (select count(*) from documents where lang = 'es') as dead_pages,
  (select count(*) from fresh) as new_records""",
        "ingest_totals": f"""with {QUOTES}
select (select count(*) from stored) as records,
  (select count(*) from documents where lang = 'es') as dead_letters""",
        "fetch_summary": """
select count(*) filter (event_type not in ('error', 'signup')) as ok,
  count(*) filter (event_type in ('error', 'signup')) as failed, count(*) as total,
  avg(value) as mean_elapsed_s, avg(value) * count(*) as serial_estimate_s from events""",
    }
