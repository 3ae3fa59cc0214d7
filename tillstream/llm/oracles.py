"""SQL, for an engine that is not Spark, of the queries that it can express."""

from __future__ import annotations

from tillstream.llm.decontamination import SHARE, WINDOW
from tillstream.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, {_WORD})"


# Every window of every item, and every run of as many words of every document.
DECONTAMINATION = f"""
with docs as (select doc_id, {_words(_LOWER)} w from documents),
items as (select coalesce(item_id::varchar, 'null') item, w, least({WINDOW}, len(w)) size
  from (select item_id, {_words(_LOWER)} w from benchmark) where len(w) > 0),
windows as (select distinct item, size, array_to_string(w[i:i + size - 1], ' ') passage
  from (select *, unnest(range(1, len(w) - size + 2)) i from items)),
sizes as (select distinct size from items),
runs as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') passage
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) i
    from docs, sizes where len(w) >= size)),
found as (select doc_id, i, size, item from runs join windows using (size, passage)),
hit as (select doc_id, count(distinct place) n_hit
  from (select doc_id, unnest(range(i, i + size)) place from found) group by 1),
held as (select doc_id, list_sort(list(distinct item)) items from found group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0) n_hit,
  coalesce(len(items), 0)::bigint n_items,
  sha256(coalesce(array_to_string(items, ','), '')) items_sha256,
  coalesce(n_hit, 0) > 0 and {SHARE} * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join hit using (doc_id) left join held using (doc_id)"""

_PHRASES = ", ".join(
    f"('{phrase}', {len(phrase.split())}, '{label}')" for phrase, label in PHRASES.items()
)
_TEMPLATES = ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES)

# Every block against every template. Blocks are lines and sentences.
LICENSES = rf"""
with docs as (select doc_id, {_LOWER} low, {_words(_LOWER)} w from documents),
phrases as (select * from (values {_PHRASES}) p(phrase, size, label)),
templates as (select label, list_distinct(string_split(statement, ' ')) words
  from (values {_TEMPLATES}) t(label, statement)),
places as (select doc_id, i - 1 place, label
  from (select doc_id, w, unnest(range(1, len(w) + 1)) i from docs) join phrases
  on w[i] = split_part(phrase, ' ', 1) and array_to_string(w[i:i + size - 1], ' ') = phrase),
base as (select doc_id, count(*) n_base, min(place) first_word, max(place) last_word,
  list(distinct label) labels from places group by 1),
blocks as (select doc_id, row_number() over () block, list_distinct({_words("block")}) words
  from (select doc_id, unnest(string_split(
    regexp_replace(low, '([.!?;])[ \t\n\x0B\f\r]+', '\1' || chr(10), 'g'), chr(10))) block
    from docs)),
shares as (select doc_id, block, label, len(t.words) size,
  len(list_intersect(b.words, t.words)) shared from blocks b, templates t),
best as (select doc_id, block, shared / size share, label from shares
  where shared >= ceil({THRESHOLD} * size - 1e-9)
  qualify row_number() over (partition by block order by shared / size desc, size desc, label desc) = 1),
more as (select doc_id, max(share) share, list(distinct label) labels from best group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0) n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') base_labels,
  array_to_string(list_sort(list_distinct(
    list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0.0)::double end score
from docs left join base using (doc_id) left join more using (doc_id)"""
