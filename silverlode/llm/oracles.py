"""SQL equivalents of the queries of this subpackage, over the whole tables."""

from __future__ import annotations

FILTER_AUDIT = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
failed as (
  select t.part,
    (len(words) < 50)::int
    + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int
    + 16 * coalesce(t.doc_id > min(t.doc_id) over (partition by text), false)::int as mask,
    coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic
  from texts t left join (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id) l
    on t.doc_id = l.doc_id),
cells as (
  select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by part, mask),
letters(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps as (
  select filter_order, step, l.bit,
    (select sum(x.bit) from letters x where instr(left(filter_order, step), x.letter) > 0) - l.bit as before
  from orders, range(1, 6) r(step) join letters l on l.letter = substr(filter_order, step, 1)),
counted as (
  select part, filter_order, step, bit,
    sum(n) filter (where mask & (before | bit) = 0) as kept,
    sum(n) filter (where mask & before = 0 and mask & bit <> 0) as removed,
    sum(n) filter (where mask & before <> 0 and mask & bit <> 0) as redundant,
    sum(n) filter (where mask = bit) as unique_fails,
    sum(good) filter (where mask & before = 0 and mask & bit <> 0) as good_lost,
    sum(toxic) filter (where mask & before = 0 and mask & bit <> 0) as toxic_lost
  from cells, steps group by all)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley
from counted
"""

# Equal stretches of eight words are joined within a text: a maximal stretch that agrees with itself q words
# on shows as an unbroken series of such pairs with distance q. Every run has sixteen such words at least.
PERIODIC_RUNS = r"""
with numbered as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    xor(list_reduce(
      list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''),
        lambda c: list_concat([ascii(c)::bigint], list_transform(range(8), lambda i: (-1)::bigint))))),
      lambda crc, op: case when op >= 0 then xor(crc, op) else xor(crc >> 1, 3988292384 * (crc & 1)) end), 4294967295) as h
  from documents),
placed as (
  select doc_id, words, len(words) as n, h % 10 = 0 and len(words) > 0 as planted, h // 10 as g,
    case when len(words) > 0 then (h // 10) % len(words) end as a
  from numbered),
cyclic as (
  select doc_id, n, case when planted then list_transform(range(n), lambda i:
      case when i < a then words[i + 1] else words[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] end) else words end as words
  from placed),
eights as (
  select doc_id, n, i, array_to_string(words[i + 1 : i + 8], ' ') as eight
  from cyclic, unnest(range(greatest(n - 7, 0))) as u(i)),
pairs as (
  select x.doc_id, x.n, x.i, y.i - x.i as q from eights x join eights y on x.doc_id = y.doc_id and x.eight = y.eight and x.i < y.i
  where 3 * (y.i - x.i) <= x.n),
islands as (
  select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from pairs),
stretches as (
  select doc_id, q, min(i) as start, count(*) + 7 + q as length from islands group by doc_id, q, island),
runs as (
  select doc_id, start, length, min(q) as period from stretches
  where length >= 24 and length >= 3 * q group by doc_id, start, length),
ranked as (
  select *, row_number() over (partition by doc_id order by length::double / period desc, start, period) as place from runs),
best as (select doc_id, start, length, period from ranked where place = 1),
digests as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by doc_id),
dropped as (
  select distinct doc_id, u.i as i from runs, unnest(range(start + period, start + length)) as u(i)),
gone as (select doc_id, list(i) as places from dropped group by doc_id)
select c.doc_id, coalesce(d.n_runs, 0)::bigint as n_runs, b.start::bigint as start, b.length::bigint as length,
  b.period::bigint as period, (1000 * b.length // b.period)::bigint as exponent_milli,
  sha256(coalesce(d.lines, '')) as runs_sha256,
  sha256(case when g.places is null then array_to_string(words, ' ')
    else array_to_string(list_filter(words, lambda w, k: not list_contains(g.places, k - 1)), ' ') end) as collapsed_sha256
from cyclic c left join digests d using (doc_id) left join best b using (doc_id) left join gone g using (doc_id)
"""

LINE_DEDUP = r"""
with texts as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
placed as (
  select r, doc_id, generate_subscripts(lines, 1) as n, unnest(lines) as line from texts),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from placed),
repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
marked as (
  select k.*, p.key is not null and k.doc_id is distinct from p.keeper as gone from keyed k left join repeated p on k.key = p.key)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (where not gone), '')) as kept_sha256
from marked group by r
"""

# Windows and texts are joined on the word sequence itself, window length by window length.
DECONTAMINATE = r"""
with said as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
asked as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
windows as (
  select distinct item_id, least(len(words), 10) as size, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') as passage
  from asked, unnest(range(1, greatest(len(words) - 10, 0) + 2)) as u(i) where len(words) > 0),
sizes as (select distinct size from windows),
stretches as (
  select r, i, size, array_to_string(words[i : i + size - 1], ' ') as passage
  from said, sizes, unnest(range(1, greatest(len(words) - size + 2, 1))) as u(i)),
hits as (
  select s.r, s.i, s.size, w.item_id from stretches s join windows w on s.size = w.size and s.passage = w.passage),
covered as (
  select r, count(distinct u.place) as n_hit from (select distinct r, i, size from hits), unnest(range(i, i + size)) as u(place) group by r),
found as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, item_id::varchar as item from hits where item_id is not null) group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from said left join covered using (r) left join found using (r)
"""

WARC_CHAIN = r"""
with payloads as (
  select page_id, strlen(coalesce(html, '')) as size, sha1(coalesce(html, '')) as digest from pages),
newest as (select digest, max(page_id) as page_id from payloads where size >= 1000 group by digest)
select p.page_id, size::bigint as payload_bytes, p.digest as payload_digest,
  case when n.page_id > p.page_id then 'revisit' else 'response' end as record_type,
  case when n.page_id > p.page_id then n.page_id end as refers_to
from payloads p left join newest n on p.digest = n.digest and p.size >= 1000
"""

# Matches and what lies between them, in turn, give the places.
SECRET_SCAN = r"""
with rules(rank, kind, pattern) as (values
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'),
  (2, 'hex', '[0-9a-f]+'),
  (3, 'pem', '-----BEGIN [A-Z ]*PRIVATE KEY-----'),
  (4, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}'),
  (5, 'jwt', 'eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}')),
texts as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
matched as (
  select r, rank, kind, pattern, string_split_regex(text, pattern) as gaps, regexp_extract_all(text, pattern) as found
  from texts, rules where regexp_matches(text, pattern)),
numbered as (
  select r, rank, kind, u.nth, length(gaps[u.nth]) as gap, found[u.nth] as piece from matched, unnest(range(1, len(found) + 1)) as u(nth)),
placed as (
  select *, (sum(gap + length(piece)) over (partition by r, rank order by nth))::bigint as stop from numbered),
spans as (
  select r, rank, kind, stop - length(piece) as start, kind || ':' || (stop - length(piece)) || ':' || stop as span from placed
  where case rank
    when 0 then length(regexp_extract(piece,
      '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)) >= 6
    when 1 then length(piece) >= 20 when 2 then length(piece) >= 24 else true end),
listed as (
  select r, count(*) filter (where rank = 0) as n_assign, count(*) filter (where rank = 1) as n_access, count(*) filter (where rank = 2) as n_hex,
    string_agg(span, ',' order by start, rank) filter (where rank <= 2) as base, string_agg(span, ',' order by start, rank) as spans
  from spans group by r)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join listed using (r)
"""

QUALITY_RULES = r"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
counted as (
  select r, doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols
  from texts),
windows as (
  select r, i, array_to_string(words[i : i + 4], ' ') as said from texts, unnest(range(1, greatest(len(words) - 3, 1))) as u(i)),
twice as (select r, i from windows qualify count(*) over (partition by r, said) > 1),
repeats as (select r, count(distinct u.place) as n_repeat_words from twice, unnest(range(i, i + 5)) as u(place) group by r),
lines as (
  select r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as words
  from (select r, unnest(string_split(text, chr(10))) as line from texts)),
measured as (
  select r, line, len(words) as n, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as chars,
    len(list_filter(words, lambda w: regexp_matches(w, '[#*$%&<>]|!!'))) as marked,
    len(list_filter(string_split_regex(line, '[ \t]'), lambda t: t in ('|', '»', '·', '>'))) as separators,
    regexp_matches(line, 'all rights reserved|accept cookies|cookie policy|enable javascript|lorem ipsum|privacy policy|sign up for our newsletter|terms of service|terms of use', 'i') as furnished
  from lines),
judged as (
  select r, count(*) filter (where n > 0) - count(distinct line) filter (where n > 0) as n_dup_lines,
    coalesce(sum(chars) filter (where 100 * marked > 50 * n or (separators >= 2 and n < 4 * (separators + 1)) or (furnished and n <= 12)), 0) as lost
  from measured group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
  n_words < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * n_words) and 100 * lost <= 50 * word_chars as kept
from counted join judged using (r) left join repeats using (r)
"""
