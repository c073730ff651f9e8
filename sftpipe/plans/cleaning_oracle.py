"""DuckDB twins of the cleaning queries, written independently."""

from __future__ import annotations

from sftpipe.plans.cleaning_checks import SECRET

# Fixed values, stated here again.
_PROVINCES = [*range(11, 16), *range(21, 24), *range(31, 38), *range(41, 47), *range(50, 55), *range(61, 66), 71, 81, 82]
_WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
_KINDS = ["resident_id", "mobile", "card", "email", "ipv4", "phone"]

_MOBILE = r"1[3-9][0-9](?:[ -]?[0-9]{4}){2}"
_CANDIDATE = "(?:" + "|".join([
    r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    r"\b[1-9][0-9]{16}[0-9Xx]",
    r"\b[0-9]{4}(?:[ -]?[0-9]{4}){2,3}(?:[0-9]{1,3}|[ -][0-9]{3})?",
    r"\b[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
    r"\+86[ -]?" + _MOBILE,
    r"\b(?:0086[ -]?|86[ -]?)?" + _MOBILE,
    r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}",
    r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}",
    r"\b(?:1[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}",
    r"\b0[0-9]{2,3}[ -][0-9]{7,8}",
]) + r")\b"

_PLANTED = """
  select doc_id, text, '110105' || (1950 + doc_id % 50) || lpad((1 + doc_id % 12)::varchar, 2, '0')
      || lpad((1 + doc_id % 28)::varchar, 2, '0') || lpad((doc_id % 1000)::varchar, 3, '0') as born,
    '4' || lpad((doc_id % 100000000000000)::varchar, 14, '0') as card,
    lpad((doc_id % 10000)::varchar, 4, '0') as four
  from documents"""

_MENTIONS = f"""
planted as ({_PLANTED}),
texts as (
  select doc_id, 'id ' || list_aggregate(list_transform(string_split('0123456789X', ''), lambda c: born || c), 'string_agg', ' ')
    || ' ' || list_aggregate(list_transform(string_split('0123456789X', ''), lambda c: substr(born, 1, 10) || '0230123' || c), 'string_agg', ' ')
    || ' card ' || list_aggregate(list_transform(range(10), lambda n: case when doc_id % 2 = 0 then card || n else
         substr(card, 1, 4) || ' ' || substr(card, 5, 4) || ' ' || substr(card, 9, 4) || ' ' || substr(card, 13, 3) || n end), 'string_agg', '; ')
    || ' call +86 139 ' || four || ' 5678, 139' || four || '5678, 0086-139' || four || '5678 or 1' || four || '5678'
    || ' +1 (743) 555-' || four || ', 1-743-555-' || four || ', 911-555-' || four || ', 010-6' || four || '678'
    || ' mail User.' || (doc_id % 100) || '@Mail.Example.COM, user.' || (doc_id % 100) || '@mail.example.com, user@host'
    || ' from 10.' || (doc_id % 300) || '.1.2 ' || chr(1) || chr(2) || ' ' || text as text
  from planted),
marked as (
  select doc_id, string_split(regexp_replace(replace(text, chr(1), chr(1) || chr(3)), '{_CANDIDATE}',
    chr(1) || chr(2) || '\\0' || chr(1) || chr(2), 'g'), chr(1) || chr(2)) as parts
  from texts where text is not null),
cut as (
  select doc_id, unnest(parts) as part, unnest(range(len(parts))) as place from marked),
read as (
  select *, place % 2 = 1 as candidate, regexp_replace(part, '[^0-9]', '', 'g') as d,
    list_sum(list_transform({_WEIGHTS}, lambda w, i: w * coalesce(try_cast(substr(part, i, 1) as integer), 0))) % 11 as rest
  from cut),
summed as (
  select *, case when candidate and length(d) between 13 and 19 then list_sum(list_transform(range(length(d)), lambda i:
      case when i % 2 = 0 then substr(d, length(d) - i, 1)::integer
        when substr(d, length(d) - i, 1)::integer > 4 then 2 * substr(d, length(d) - i, 1)::integer - 9
        else 2 * substr(d, length(d) - i, 1)::integer end)) end as luhn
  from read),
kinds as (
  select *, case
    when not candidate then null
    when contains(part, '@') then 'email'
    when regexp_full_match(part, '[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}') then
      case when list_bool_and(list_transform(string_split(part, '.'), lambda o:
        try_cast(o as integer) < 256 and (length(o) = 1 or o[1] <> '0' or length(o) = 2))) then 'ipv4' end
    when regexp_full_match(part, '[0-9]{{6}}(19|20)[0-9]{{9}}[0-9Xx]') and try_cast(substr(part, 1, 2) as integer) in {tuple(_PROVINCES)}
      and try_strptime(substr(part, 7, 8), '%Y%m%d') is not null
      and substr('10X98765432', cast(rest as integer) + 1, 1) = upper(substr(part, 18, 1)) then 'resident_id'
    when regexp_full_match(part, '((\\+|00)?86[ -]?)?{_MOBILE}') then 'mobile'
    when luhn % 10 = 0 and replace(d, d[1], '') <> '' then 'card'
    when part[1] <> '0' and regexp_full_match(d, '1?[2-9][0-9]{{2}}[2-9][0-9]{{6}}')
      and substr(right(d, 10), 2, 2) <> '11' and substr(right(d, 10), 5, 2) <> '11' then 'phone'
    when regexp_full_match(part, '0(10|2[0-57-9]|[3-9][0-9]{{2}})[ -]?[2-9][0-9]{{6,7}}')
      or (part[1] = '0' and regexp_full_match(d, '0(10|2[0-57-9]|[3-9][0-9]{{2}})[2-9][0-9]{{6,7}}')) then 'phone'
    end as kind
  from summed),
normal as (
  select *, kind || ':' || case kind when 'email' then lower(part) when 'ipv4' then part
    when 'resident_id' then upper(part) when 'mobile' then right(d, 11)
    when 'phone' then case when length(d) = 11 and d[1] = '1' then right(d, 10) else d end else d end as spelled
  from kinds),
named as (
  select *, translate(substr(sha256(unhex('{bytes(b ^ 0x5C for b in SECRET.ljust(64, bytes(1))).hex()}')
      || unhex(sha256(unhex('{bytes(b ^ 0x36 for b in SECRET.ljust(64, bytes(1))).hex()}') || encode(spelled)))), 1, 20),
    '0123456789', 'ghijklmnop') as pseudonym
  from normal)"""

_REPLACED = """
replaced as (
  select doc_id, string_agg(case when kind is null then replace(part, chr(1) || chr(3), chr(1))
      else '[' || kind || ':' || pseudonym || ']' end, '' order by place) as text, {counts}
  from named group by doc_id)""".format(
    counts=", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in _KINDS)
)


_SITE_LINES = r"""
pages_of as (
  select page_id as page_key, regexp_extract(url, '//([^/]+)', 1) as site, concat_ws(chr(10),
    case when page_id % 3 <> 0 then 'Call ' || regexp_extract(url, '//([^/]+)', 1) || ' now: 400-' || page_id || '!' end,
    regexp_replace(regexp_replace(html, '(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'g'), '<[^>]*>', chr(10), 'g'),
    case when page_id % 2 = 0 then 'Only here: ' || regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) end,
    case when page_id % 5 = 0 then '  SUBSCRIBE to ' || chr(9) || ' our newsletter' else 'Subscribe to our newsletter ' end,
    'subscribe to our newsletter or to ' || regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)) as text
  from pages),
lines as (
  select page_key, site, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as n
  from pages_of),
normal as (
  select *, regexp_replace(lower(trim(regexp_replace(line, '[\t\x0b\f\r \x{a0}\x{3000}]+', ' ', 'g'))), '[0-9]+', '0', 'g') as plain
  from lines),
templates as (
  select site, plain, count(distinct page_key) as pages, any_value(site_pages) as site_pages
  from normal join (select site, count(*) as site_pages from pages_of group by site) using (site)
  where plain <> '' group by site, plain having count(distinct page_key) >= 3 and count(distinct page_key) >= 0.3 * any_value(site_pages))"""

_TAGS = (
    "address article aside blockquote body br caption center col colgroup dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td textarea tfoot th thead title tr ul"
)
_PLAIN_TAGS = "a b i u em font span strong img input label s script style template"
_ATTRIBUTE = r"""(?:\s+(?:[a-z_:][a-z0-9_.:-]*\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''<>=`]+)|noshade|disabled|checked))*\s*/?>"""


def _unmarked(text: str) -> str:
    """One round: comments, scripts, block tags, other tags, then one level of references."""
    steps = [
        (r"(?s)<!--.*?-->", ""),
        (rf"(?is)<script{_ATTRIBUTE}.*?</script\s*>", ""),
        (rf"(?i)</?(?:{_TAGS.replace(' ', '|')}){_ATTRIBUTE}", "\n"),
        (rf"(?i)</?(?:{_PLAIN_TAGS.replace(' ', '|')}){_ATTRIBUTE}", ""),
    ]
    for pattern, to in steps:
        text = f"regexp_replace({text}, '{pattern}', {'chr(10)' if to else repr('')}, 'g')"
    for name, to in (("nbsp", "chr(160)"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("copy", "chr(169)"),
                     ("#60", "'<'"), ("#62", "'>'"), ("#38", "chr(1)"), ("amp", "chr(1)")):
        text = f"replace({text}, '&{name};', {to})"
    # The ampersand last, and both its spellings at once.
    return f"replace({text}, chr(1), '&')"


_RESIDUE = f"""
marked as (
  select doc_id, lang, text as plain, case doc_id % 4 when 0 then '<div id="a>b">' when 1 then '&lt;p align=&quot;left&quot;&gt;'
      when 2 then '&amp;lt;!-- &amp;amp; --&amp;gt;&amp;#60;hr&#38;#62;'
      else '<SCRIPT type=''t''>if (a < b) {{}}</script >&amp;amp;amp;copy; &unknown; AT&T ' end
    || replace(replace(replace(replace(replace(replace(text, '. ', '.<br/>'), ', ', ',&nbsp;'), ' the ', ' <b class=''x''>the</b> '),
      ' de ', ' &lt;i&gt;de&lt;/i&gt; '), ' of ', ' a < b of c > d '), ' in ', ' x<y>z in ')
    || '<!-- end --></div><font color=red size=2 noshade>' as text
  from documents),
rounds as (
  select doc_id, lang, plain, text, 0 as n from marked
  union all
  select doc_id, lang, plain, {_unmarked('text')}, n + 1 from rounds where {_unmarked('text')} <> text),
unmarked as (select doc_id, lang, plain, arg_max(text, n) as text, max(n) as n from rounds group by doc_id, lang, plain)"""

def _grams(letters: str) -> str:
    return f"""list_distinct(case when len({letters}) < 5 then case when len({letters}) = 0 then [] else [array_to_string({letters}, '')] end
      else list_transform(range(1, len({letters}) - 3), lambda i: {letters}[i] || {letters}[i + 1] || {letters}[i + 2] || {letters}[i + 3] || {letters}[i + 4]) end)"""


_PAIRS = f"""
worded as (
  select doc_id, lang, text, list_filter(regexp_split_to_array(text, '[ \n\r\t]+'), lambda w: length(w) > 0) as words from documents),
picked as (
  select doc_id, lang, text, list_filter(words, lambda w, i: (i - 1) % greatest(1, len(words) // 8) = 0)[1:8] as picked from worded),
pairs as (
  select p.doc_id, coalesce(p.lang, '') as of,
    array_to_string(list_concat(p.picked, coalesce(m.picked[1:3], [])), ' ') as question,
    case when p.doc_id % 5 = 0 and o.text is not null then o.text else p.text end as answer,
    p.doc_id % 5 = 0 and o.text is not null as swapped
  from picked p left join documents o on o.doc_id = p.doc_id + 5 left join picked m on m.doc_id = p.doc_id + 7),
plain as materialized (
  select *, list_filter(string_split(regexp_replace(lower(question), '[^\\p{{L}}\\p{{N}}]', '', 'g'), ''), lambda c: c <> '') as pq,
    list_filter(string_split(regexp_replace(lower(answer), '[^\\p{{L}}\\p{{N}}]', '', 'g'), ''), lambda c: c <> '') as pa
  from pairs),
sets as materialized (select doc_id, of, swapped, {_grams('pq')} as q, {_grams('pa')} as a from plain),
placed as materialized (
  select *, case when len(a) = 0 then -1 else length(bin(len(a))) - 1 end as band,
    row_number() over (order by of, md5('42' || doc_id), doc_id) as place from sets),
answer_grams as materialized (select doc_id, of, band, unnest(a) as g from placed),
of_size as (select of, band, count(*) as n from placed group by of, band),
of_all as (select of, count(*) as n from placed group by of),
held as materialized (select of, g, band, count(*) as n from answer_grams group by of, g, band),
weights as (
  select of, g, round(ln((any_value(of_all.n) + 1) / (sum(held.n) + 1)) * 1000000)::bigint as w
  from held join of_all using (of) group by of, g),
sides as (
  select p.doc_id, p.of, p.swapped, p.q, p.band, o.doc_id as other, o.band as other_band
  from placed p left join placed o on o.place = p.place + 1 and o.of = p.of),
asked as (
  select doc_id, of, band, other, other_band, unnest(q) as g from sides),
weighed as (
  select asked.*, coalesce(w, round(ln((of_all.n + 1) / 1) * 1000000)::bigint) as weight,
    own.doc_id is not null as hit, met.doc_id is not null as other_hit,
    round(coalesce(h.n, 0) / s.n * 1000000)::bigint as chance, round(coalesce(oh.n, 0) / os.n * 1000000)::bigint as other_chance
  from asked join of_all using (of) left join weights using (of, g)
    left join answer_grams own on own.doc_id = asked.doc_id and own.g = asked.g
    left join answer_grams met on met.doc_id = asked.other and met.g = asked.g
    left join held h on h.of = asked.of and h.g = asked.g and h.band = asked.band
    left join held oh on oh.of = asked.of and oh.g = asked.g and oh.band = asked.other_band
    left join of_size s on s.of = asked.of and s.band = asked.band
    left join of_size os on os.of = asked.of and os.band = asked.other_band),
summed as (
  select doc_id, sum(weight)::hugeint as whole, coalesce(sum(weight) filter (hit), 0)::hugeint * 1000000 as own,
    coalesce(sum(weight) filter (hit), 0)::hugeint * 1000000 - sum(weight * chance)::hugeint as over,
    coalesce(sum(weight) filter (other_hit), 0)::hugeint * 1000000 - sum(weight * other_chance)::hugeint as other_over
  from weighed group by doc_id),
scores as (
  select sides.doc_id, swapped, band, other_band, (own // whole)::bigint as score,
    ((over - ((over % whole) + whole) % whole) // whole)::bigint as excess,
    ((other_over - ((other_over % whole) + whole) % whole) // whole)::bigint as other_excess
  from sides left join summed on summed.doc_id = sides.doc_id and whole > 0),
cells as (select other_band, floor(other_excess / 1000)::bigint as cell from scores where other_excess is not null),
ranked as (
  select *, row_number() over (partition by other_band order by cell) as r, count(*) over (partition by other_band) as n,
    row_number() over (order by cell) as all_r, count(*) over () as all_n from cells),
bounds as (
  select other_band as band, (min(cell) filter (r >= 0.8 * n) + 1) * 1000 as bound from ranked where n >= 200 group by other_band),
of_every as (select (min(cell) filter (all_r >= 0.8 * all_n) + 1) * 1000 as bound from ranked),
judged as (
  select doc_id, swapped, score / 1000000 as score, excess / 1000000 as excess,
    coalesce(bounds.bound, (select bound from of_every)) / 1000000 as bound,
    coalesce(excess < coalesce(bounds.bound, (select bound from of_every)) and score < 1000000, false) as irrelevant
  from scores left join bounds using (band))"""


def cleaning() -> dict[str, str]:
    return {
        "deidentified_documents": f"""
with {_MENTIONS}, {_REPLACED}
select documents.doc_id, replaced.text, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in _KINDS)}
from documents left join replaced using (doc_id)""",
        "identifier_mentions": f"""
with {_MENTIONS}
select kind, pseudonym, count(*) as mentions from named where kind is not null group by all""",
        "identifiers_left": f"""
with {_MENTIONS}, {_REPLACED}
select count(text) as texts, sum(length(text))::bigint as chars, 0 as "left" from replaced""",
        "ad_lines": f"""
with {_SITE_LINES}
select site, md5('true:' || site || chr(10) || plain) as digest, pages, site_pages from templates""",
        "pages_without_ads": f"""
with {_SITE_LINES},
gone as (select page_key, n from normal join templates using (site, plain))
select page_key, any_value(site) as site,
  coalesce(string_agg(line, chr(10) order by n) filter (gone.n is null), '') as text,
  coalesce(string_agg(n::varchar, ',' order by n) filter (gone.n is not null), '') as removed
from lines left join gone using (page_key, n) group by page_key""",
        "documents_without_residue": f"""
with recursive {_RESIDUE}
select documents.doc_id, unmarked.text from documents left join unmarked using (doc_id)""",
        "residue_counts": f"""
with recursive {_RESIDUE}
select lang, count(*) filter ({_unmarked('plain')} <> plain) as plain_changed, count(*) filter (n > 0) as marked_changed
from unmarked group by lang""",
        "irrelevant_answers": f"""
with {_PAIRS}
select doc_id, score, excess, bound, irrelevant from judged""",
        "relevance_of_swaps": f"""
with {_PAIRS}
select swapped, irrelevant, count(*) as count from judged group by swapped, irrelevant""",
    }
