"""The registered queries that SQL can express, in plain SQL over the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATE = f"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all({_LOWER}, {_ALNUM}) as w from documents),
i as (select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, {_ALNUM}) as w from benchmark),
starts as (select item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) as s from i where len(w) > 0),
wins as (select distinct item, list_slice(w, s + 1, s + 10) as words from starts),
sizes as (select distinct len(words) as n from wins),
places as (select r, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) as s from d, sizes),
spots as (select r, n, s, list_slice(w, s + 1, s + n) as words from places),
hits as (select r, s, n, item from spots join wins using (words)),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from hits) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from hits where item is not null) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join covered using (r) left join items using (r)
"""

URL_FILTER = r"""
with p as (select page_id, url, date '2024-01-01' + cast(page_id * 37 % 365 as integer) as fetched_at,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) as path from pages),
seen as (select distinct host, regexp_extract(path, '^/([^/]+)/', 1) as top, page_id % 20 as r from p where host is not null and page_id % 20 < 9),
names as (select distinct r, case when r < 3 then host when r < 6 then regexp_extract(host, '([^.]+\.[^.]+)$', 1)
    when top <> '' then host || '/' || top end as pattern from seen),
entries as (select case r % 3 when 0 then 'spam' when 1 then 'adult' else 'malware' end as list, pattern,
    date '2023-12-01' + cast(turn * 97 + (length(pattern) * 31 + r * 7) % 90 as integer) as listed_at, turn <> 1 as active
    from names, (values (0), (1), (2)) as t(turn) where pattern <> ''),
dated as (select list, pattern, listed_at, bool_or(active) as active from entries group by all),
valid as (select *, lead(listed_at) over (partition by list, pattern order by listed_at) as until from dated),
parts as (select *, string_split(host, '.') as labels, list_filter(string_split(path, '/'), lambda x: x <> '') as folders from p where host is not null),
asked as (
    select page_id, fetched_at, array_to_string(list_slice(labels, i, len(labels)), '.') as pattern
    from (select *, unnest(range(1, len(labels) + 1)) as i from parts)
    union
    select page_id, fetched_at, host || '/' || array_to_string(list_slice(folders, 1, i), '/')
    from (select *, unnest(range(1, len(folders) + 1)) as i from parts)),
found as (select page_id, count(*) as n_matches, string_agg(distinct list, ',' order by list) as lists, min(listed_at) as since
    from asked join valid using (pattern) where active and fetched_at >= listed_at and (until is null or fetched_at < until) group by page_id)
select page_id as capture_id, host, coalesce(n_matches, 0) as n_matches, coalesce(lists, '') as lists, since, n_matches is not null as blocked
from p left join found using (page_id)
"""

SUBSTRINGS = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w from documents),
places as (select doc_id, w, unnest(range(0, greatest(len(w) - 12, 0))) as s from d),
wins as (select doc_id, s, array_to_string(list_slice(w, s + 1, s + 13), ' ') as words from places),
first as (select words, min(doc_id) as owner from wins group by words),
gone as (select distinct doc_id, unnest(range(s, s + 13)) as spot from wins join first using (words) where doc_id > owner),
words as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as spot from d),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by spot) as kept from words anti join gone using (doc_id, spot) group by doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)
"""


def _quoted(text: str) -> str:
    """SQL for a JSON string of ``text``."""
    out = rf"""replace(replace({text}, '\', '\\'), '"', '\"')"""
    short = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}
    for code in range(1, 32):
        mark = f"\\{short[code]}" if code in short else f"\\u{code:04x}"
        out = f"replace({out}, chr({code}), '{mark}')"
    return f"""'"' || {out} || '"'"""


TOOL_CALLS = f"""
with recursive c as (select conv_id, turn, length(text) as n, {_quoted('text')} as said from conversations where role = 'assistant'),
calls as (select conv_id, turn, 'call-' || conv_id || '-' || turn as call_id,
    case n % 4 when 0 then 'search' when 1 then 'lookup' when 2 then 'compute' when 3 then 'other' end as name,
    case n % 4 when 0 then '{{"limit":' || case when n % 3 = 0 then '"many"' else cast(n % 9 as varchar) end || ',"query":' || said || '}}'
               when 1 then '{{"exact":true,"key":' || said || '}}' when 2 then '{{"expression":' || said || '}}' else '{{"x":1}}' end as arguments,
    case n % 4 when 0 then case when n % 3 = 0 then 'not integer: limit' else '' end when 1 then '' when 2 then 'missing digits' else 'unknown tool' end as errors
    from c),
results as (select conv_id, 'call-' || conv_id || '-' || (turn - 1) as call_id, {_quoted('text')} as content
    from conversations where role <> 'assistant' and turn > 0),
chains as (select conv_id, turn, cast(0 as bigint) as depth from calls
    union select k.conv_id, k.turn, depth + 1 from chains join calls k on k.conv_id = chains.conv_id and k.turn in (chains.turn + 2, chains.turn + 4)),
deep as (select conv_id, turn, max(depth) as depth from chains group by conv_id, turn)
select coalesce(k.conv_id, r.conv_id) as conv_id, coalesce(k.call_id, r.call_id) as call_id, depth,
    case when k.call_id is null then 'orphan' when r.call_id is null then 'unanswered' else 'linked' end as status,
    case when k.call_id is null then 'no call' else errors end as errors,
    k.call_id is not null and r.call_id is not null and errors = '' as valid,
    '{{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || coalesce(k.call_id, r.call_id) || '","name":' ||
        coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(content, 'null') || '}}' as json
from calls k full join results r on k.conv_id = r.conv_id and k.call_id = r.call_id
left join deep on deep.conv_id = k.conv_id and deep.turn = k.turn
"""

NGRAM_JOIN = f"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER}, {_SPACED}) as w from documents),
starts as (select doc_id, w, unnest(range(0, greatest(len(w) - 3, 0) + 1)) as s from d where len(w) > 0),
shingles as (select distinct doc_id, array_to_string(list_slice(w, s + 1, s + 3), ' ') as shingle from starts),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as shared from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 90 * (x.n + y.n - shared)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(max(n), 0) as n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) as component_id
from d left join sizes using (doc_id) left join reach on a = d.doc_id group by d.doc_id
"""

_NEAR = "min(struct_pack(d := list_sum(list_transform(list_zip(parts.v, {book}.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), e := {book}.e))"


def _round(old: str, new: str) -> str:
    """SQL for a round of means: ``new`` from ``old``."""
    return f"""
near_{new} as (select r, p, parts.v as v, {_NEAR.format(book=old)}.e as e from parts join {old} using (p) group by r, p, parts.v),
sums_{new} as (select p, e, i, floor(sum(v[i]) / count(*)) as mean from (select *, unnest(range(1, len(v) + 1)) as i from near_{new}) group by p, e, i),
means_{new} as (select p, e, list(cast(mean as bigint) order by i) as v from sums_{new} group by p, e),
{new} as (select o.p, o.e, coalesce(m.v, o.v) as v from {old} o left join means_{new} m using (p, e)),"""


VECTOR_CODES = f"""
with kept as (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
places as (select *, unnest(range(16)) as p from kept),
parts as (select r, p, list_slice(x, p * len(x) // 16 + 1, (p + 1) * len(x) // 16) as v from places),
book as (select p, r - 1 as e, v from parts where r <= 64),
{_round("book", "book1")}
{_round("book1", "book2")}
found as (select r, p, {_NEAR.format(book="book2")} as best from parts join book2 using (p) group by r, p),
coded as (select r, string_agg(printf('%02x', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error from found group by r),
whole as (select vec_id, label, code, error from coded join kept using (r)),
digest as (select sha256(string_agg(cast(v[i] as varchar), ',' order by p, e, i)) as codebooks_sha256 from (select *, unnest(range(1, len(v) + 1)) as i from book2))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from whole, digest
"""

ORACLE = {
    "op3_decontaminate": DECONTAMINATE,
    "op4_url_filter": URL_FILTER,
    "op5_substring_dedup": SUBSTRINGS,
    "op8_tool_calls": TOOL_CALLS,
    "op9_ngram_join": NGRAM_JOIN,
    "op11_vector_codes": VECTOR_CODES,
}
