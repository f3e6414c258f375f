"""SQL for the queries whose results SQL can express, as DuckDB runs it over the same tables."""

from __future__ import annotations

import string

from ladderlake.llm.chat import CONTROL, TRAINED_ROLE
from ladderlake.llm.quality import DELTA, LEAST_DOCS, RISK, RULES, STEPS
from ladderlake.llm.warc import BASE32, DIGITS32

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

SUBSTRING_DEDUP = r"""
with docs as (
  select doc_id, list_filter(
    regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
windows as (
  select doc_id, s, array_to_string(w[s : s + 19], ' ') as key
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from docs where len(w) >= 20)),
later as (
  select doc_id, s from (
    select doc_id, s, row_number() over (partition by key order by doc_id, s) as n from windows)
  where n > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as place from later),
words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from docs),
marked as (
  select words.*, gone.place is not null as removed
  from words left join gone using (doc_id, place)),
kept as (
  select doc_id, count(*) filter (removed) as n_removed,
    string_agg(word, ' ' order by place) filter (not removed) as left_over
  from marked group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(left_over, '')) as kept_sha256
from docs left join kept using (doc_id)"""

_DIGEST = " || ".join(
    f"to_base(cast('0x' || substr(digest, {5 * k + 1}, 5) as bigint), 32, 4)" for k in range(8)
)
WARC = f"""
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as digest
  from pages),
found as (
  select *, min(page_id) over (partition by digest) as first_id from payloads)
select page_id, payload_bytes, translate({_DIGEST}, '{DIGITS32}', '{BASE32}') as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from found"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
DECONTAMINATION = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
items as (
  select cast(item_id as varchar) as item, {_WORDS} as w, least(len(w), 10) as n
  from benchmark),
item_windows as (
  select distinct item, n, array_to_string(w[s : s + n - 1], ' ') as key
  from (select *, unnest(range(1, len(w) - n + 2)) as s from items where n > 0)),
sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') as key
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s
        from docs, sizes where len(w) >= n)),
hits as (select doc_id, s, n, item from doc_windows join item_windows using (n, key)),
places as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(s, s + n)) as place from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from docs left join places using (doc_id) left join found using (doc_id)"""


def _escaped_chars(column: str) -> str:
    """Code points of a text with a backslash before each backslash and control string."""
    marks = [("\\", 1), *((c, len(c)) for c in CONTROL)]
    counts = [f"(len({column}) - len(replace({column}, '{c}', ''))) // {n}" for c, n in marks]
    return f"(len({column}) + {' + '.join(counts)})"


CHAT = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all
  select -1, k, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, '{TRAINED_ROLE}')) v(k, r)),
summed as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(text, '' order by turn, text) filter (role = '{TRAINED_ROLE}'), '') as loss,
    cast(sum({_escaped_chars("role")} + {_escaped_chars("text")} + 10) as bigint)
      as formatted_chars
  from turns group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, len(loss) as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars
from summed"""

SUFFIX_DEDUP = """
with docs as (
  select doc_id, encode(coalesce(text, '')) as h, strlen(coalesce(text, '')) as n_bytes
  from documents),
windows as (
  select doc_id, s, md5_number(h[s : s + 99]) as key
  from (select doc_id, h, unnest(range(1, n_bytes - 98)) as s from docs where n_bytes >= 100)),
firsts as (
  select key, min((doc_id, s)) as first from windows group by key having count(*) > 1),
later as (
  select doc_id, s from windows join firsts using (key) where (doc_id, s) <> first),
-- Windows that repeat, joined into runs where they touch or overlap.
runs as (
  select doc_id, min(s) as low, max(s) + 99 as high
  from (
    select doc_id, s, sum(fresh) over (partition by doc_id order by s) as run
    from (
      select doc_id, s,
        cast(coalesce(s > lag(s) over (partition by doc_id order by s) + 100, true) as int) as fresh
      from later))
  group by doc_id, run),
-- What stays lies between the runs.
parts as (
  select doc_id, lag(high, 1, 0) over (partition by doc_id order by low) + 1 as a, low - 1 as b
  from runs
  union all
  select docs.doc_id, coalesce(max(high), 0) + 1, any_value(n_bytes)
  from docs left join runs using (doc_id) group by docs.doc_id),
kept as (
  select doc_id, string_agg(hex(h[a : b]), '' order by a) as left_over
  from parts join docs using (doc_id) group by doc_id),
sums as (
  select doc_id, cast(sum(high - low + 1) as bigint) as n_removed, count(*) as n_spans
  from runs group by doc_id)
select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(left_over, ''))) as kept_sha256
from docs left join sums using (doc_id) left join kept using (doc_id)"""

_SHARES = " union all ".join(
    f"select doc_id, lang, base_failed, '{rule}' as rule, "
    f"coalesce(cast(floor({top} * 1000 / nullif({bottom}, 0)) as bigint), 0) as value from judged"
    for rule, (top, bottom) in RULES.items()
)
QUALITY = rf"""
with docs as (
  select doc_id, lang, coalesce(text, '') as t, list_filter(
    regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
windows as (
  select doc_id, s, array_to_string(w[s : s + 4], ' ') as key
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as s from docs where len(w) >= 5)),
repeats as (
  select doc_id, count(distinct place) as n_repeat_words
  from (
    select doc_id, unnest(range(s, s + 5)) as place
    from (select doc_id, s, count(*) over (partition by doc_id, key) as n from windows)
    where n > 1)
  group by doc_id),
lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as line from docs)
  where regexp_matches(line, '[^ \x09-\x0D]') group by doc_id),
labelled as (
  select doc_id, coalesce(max(toxic), 0) = 1 as toxic from labels
  where quality is not null and doc_id is not null group by doc_id),
tokens as (
  select d.doc_id, toxic, {_WORDS} as t from documents d left join labelled using (doc_id)),
held as (select doc_id, toxic, unnest(list_distinct(t)) as term from tokens),
toxic_sizes as (
  select cast(count(*) filter (toxic) as bigint) as n_toxic, cast(count(toxic) as bigint) as n_labelled,
    cast(count(*) filter (toxic is null) as bigint) as n_free from tokens),
toxic_terms as (
  select term
  from (select term, cast(count(*) filter (toxic) as bigint) as n,
      cast(count(*) filter (toxic is null) as bigint) as m from held group by term), toxic_sizes
  where n_free > 0 and n >= {LEAST_DOCS} and 20 * n >= n_toxic and 2 * n * n_free >= m * n_labelled),
toxic_words as (
  select doc_id, count(*) as n_toxic_words
  from (select doc_id, unnest(t) as term from tokens) semi join toxic_terms using (term)
  group by doc_id),
counts as (
  select doc_id, lang, len(w) as n_words, coalesce(n_toxic_words, 0) as n_toxic_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from docs left join lines using (doc_id) left join repeats using (doc_id)
    left join toxic_words using (doc_id)),
judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts),
shares as ({_SHARES}),
good as (
  select doc_id from labels where quality is not null group by doc_id
  having min(quality) = 1 and coalesce(max(toxic), 0) = 0),
kinds as (
  select doc_id, doc_id in (select doc_id from good where doc_id is not null) as is_good
  from (select distinct doc_id from labels where doc_id is not null)),
pool as (
  select rule, value, count(*) filter (is_good is null) as n, count(*) filter (not is_good) as m
  from shares left join kinds using (doc_id)
  where not base_failed and is_good is distinct from true group by rule, value),
sizes as (
  select cast(count(*) filter (is_good is null) as bigint) as n_docs,
    cast(count(is_good) as bigint) as n_labelled
  from judged left join kinds using (doc_id) where not base_failed),
costs as (
  select rule, value, n_docs, n_labelled,
    cast(sum(coalesce(n, 0)) over w as bigint) as above,
    cast(sum(coalesce(n, 0)) over w as bigint) * n_labelled
      - cast(sum(coalesce(m, 0)) over w as bigint) * n_docs as estimate
  from (select distinct rule from shares) cross join (select unnest(range(0, 1001)) as value)
    cross join sizes left join pool using (rule, value)
  window w as (partition by rule order by value desc)),
ranks as (
  select rule, value, (10 * greatest(0, max(estimate) over (partition by rule order by value desc))
      + above * n_labelled) * {STEPS} // (10 * n_docs * n_labelled) as step
  from costs),
steps as (
  select doc_id, min(case when shares.value > 0 then step end) as step
  from shares left join ranks using (rule, value) where not base_failed group by doc_id),
good_steps as (
  select false as pooled, lang, step, count(*) as n
  from judged join steps using (doc_id) join good using (doc_id) group by lang, step),
every as (
  select * from good_steps
  union all select true, null, step, cast(sum(n) as bigint) from good_steps group by step),
totals as (select pooled, lang, cast(sum(n) as bigint) as n_good from every group by pooled, lang),
errors as (
  select {RISK} as p, {DELTA} / (1 + count(distinct coalesce(lang, ''))) as delta from good_steps),
chances as (
  select n_good, k, sum(exp(lgamma(n_good + 1) - lgamma(k + 1) - lgamma(n_good - k + 1)
      + k * ln(p) + (n_good - k) * ln(1 - p))) over (partition by n_good order by k) as up_to
  from (select n_good, unnest(range(0, n_good)) as k from (select distinct n_good from totals)),
    errors),
allowed as (
  select n_good, max(k) as n_allowed from chances, errors where up_to <= delta group by n_good),
rejected as (
  select pooled, lang, step,
    sum(n) over (partition by pooled, lang order by step nulls last) as rejected from every),
stops as (
  select pooled, t.lang, min(case when rejected > n_allowed then step end) as stop
  from totals t join allowed using (n_good) join rejected r using (pooled)
  where r.lang is not distinct from t.lang group by pooled, t.lang),
limits as (
  select j.doc_id, step,
    case when o.pooled is not null then coalesce(o.stop, {4 * STEPS})
      when a.pooled is not null then coalesce(a.stop, {4 * STEPS}) else 0 end as stop
  from judged j join steps using (doc_id)
    left join stops o on not o.pooled and o.lang is not distinct from j.lang
    left join stops a on a.pooled)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and doc_id not in (select doc_id from limits where step < stop) as kept
from judged"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = rf"""
with docs as (
  select doc, doc_id, len(w) as n, w
  from (select row_number() over () as doc, doc_id, {_TERMS} as w from documents) where len(w) > 0),
corpus as (select count(*)::bigint as n_docs, sum(n)::bigint as total from docs),
counted as (
  select doc, doc_id, n, term, count(*) as tf
  from (select doc, doc_id, n, unnest(w) as term from docs) group by all),
asked as (
  select distinct item_id, term from (select item_id, unnest({_TERMS}) as term from benchmark)),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as w
  from counted, corpus group by term, n_docs),
scores as (
  select item_id, doc, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total))))::bigint as score
  from asked join counted using (term) join weights using (term), corpus group by all),
ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id) as rank
  from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10"""

MINHASH = rf"""
with recursive docs as (
  select doc_id, list_filter(regexp_split_to_array({_LOWER}, '[ \x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[s : s + 4], ' ') as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as s from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
ends as (select a, b from links union all select b, a from links),
reached(doc_id, other) as (
  select distinct a, a from ends
  union
  select reached.doc_id, ends.b from reached join ends on ends.a = reached.other),
components as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id,
  coalesce(component_id, doc_id) = doc_id as kept
from docs left join sizes using (doc_id) left join components using (doc_id)"""

SQL = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op3_warc": WARC,
    "op4_decontamination": DECONTAMINATION,
    "op6_quality_rules": QUALITY,
    "op7_chat_formatting": CHAT,
    "op8_suffix_dedup": SUFFIX_DEDUP,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op13_minhash": MINHASH,
}
