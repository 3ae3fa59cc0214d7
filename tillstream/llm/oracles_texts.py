"""SQL, for an engine that is not Spark, of the queries that rewrite texts and conversations."""

from __future__ import annotations

from tillstream.llm.fill_in_middle import MIDDLE, PLAIN, PREFIX, SUFFIX, SUFFIX_FIRST
from tillstream.llm.substrings import WINDOW

# Every window of every document; those whose like starts earlier; the words they cover.
SUBSTRINGS = f"""
with docs as (select row_number() over () r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w
  from documents),
windows as (select r, doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') passage
  from (select *, unnest(range(1, len(w) - {WINDOW - 2})) i from docs where len(w) >= {WINDOW})),
judged as (select r, i, row(doc_id is null, coalesce(doc_id, 0), i) place,
    min(row(doc_id is null, coalesce(doc_id, 0), i)) over (partition by passage) earliest
  from windows),
gone as (select distinct r, unnest(range(i, i + {WINDOW})) i from judged where place <> earliest),
lost as (select r, count(*) n_removed, list(i) places from gone group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed,
  sha256(coalesce(kept, array_to_string(w, ' '))) kept_sha256
from docs left join lost using (r) left join (
  select r, string_agg(word, ' ' order by i) kept
  from (select r, unnest(w) word, unnest(range(1, len(w) + 1)) i from docs semi join lost using (r))
  anti join gone using (r, i) group by r
  union all select r, '' from lost join docs using (r) where n_removed = len(w)) using (r)"""


def _draw(i: int) -> str:
    return f"('0x' || substr(h, {8 * i + 1}, 8))::bigint h{i + 1}"


MIDDLES = f"""
with docs as (select doc_id, coalesce(text, '') t, length(coalesce(text, ''))::bigint n,
    sha256('1:' || coalesce(doc_id::varchar, '')) h from documents),
drawn as (select *, {", ".join(map(_draw, range(4)))} from docs),
cut as (select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
  case when n = 0 or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}')
    or h3 % 100 >= {100 - PLAIN} then 'plain' when h4 % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end form
  from drawn),
parts as (select *, t[1:a] p, t[a + 1:b] m, t[b + 1:] s from cut)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars,
  case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    else '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m end) output_sha256,
  sha256(t) restored_sha256
from parts"""


def _least(options: str) -> str:
    return f"list_sort(list_filter({options}, lambda x: x.c < 1000000000))[1]"


def _before(state: int) -> str:
    """The best of what may be done to a row in a state, from what is best after it."""
    turn = (2, 2, 3, 2)[state]
    kept = {turn - 1: turn} | ({0: 1} if state == 0 else {})
    keep = " ".join(
        f"when not gone and role = {role} then {{c: v{after}.c + 3 * cut, a: 'K' || v{after}.a}}"
        for role, after in kept.items()
    )
    return _least(
        f"list_filter([{{c: 4 + v{state}.c, a: 'D' || v{state}.a}}, case {keep} end,"
        f" case when not gone then {{c: 3 + 3 * cut + v{turn}.c, a: 'R' || v{turn}.a}} end],"
        " lambda x: x is not null)"
    )


def _inserted(state: int) -> str:
    """The best of a state when turns may be inserted first."""
    one = (2, 2, 3, 2)[state]
    two = (2, 2, 3, 2)[one]
    return _least(
        f"[b{state}, {{c: 3 + b{one}.c, a: 'I' || b{one}.a}}, {{c: 6 + b{two}.c, a: 'II' || b{two}.a}}]"
    )


# The checksum is folded over a table of 256 numbers. Costs and letters of all four states go back
# from the last row to the first, a row of every conversation at a time.
CONVERSATIONS = f"""
with recursive crcs as (select list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) t
  from range(256) r(i)),
keyed as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') k from conversations),
kinds as (select *, xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(string_split(k, ''), lambda ch: ascii(ch)::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 kind from keyed, crcs),
damaged as (select conv_id, turn, case when kind = 4 then 'user' else role end role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text,
    unnest(range(case when kind = 3 then 2 else 1 end)) copy
  from kinds where kind <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first,
    md5(length(role) || ':' || role || ':' || text), copy) i,
    case left(role, 1) when 's' then 0 when 'u' then 1 when 'a' then 2 else 3 end initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ended from damaged),
judged as (select *, ended = '' blank, ended <> '' and row_number() over (
    partition by conv_id, role, text order by i) > 1 again,
    lag(initial) over (partition by conv_id order by i) before from placed),
symbols as (select *, blank or again gone,
    (not blank and not again and right(ended, 1) not in ('.', '!', '?'))::bigint cut from judged),
counts as (select conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
    sum(blank::bigint) blank, sum(again::bigint) duplicate, sum(cut) truncated,
    sum((before is not null and (before, initial) not in ((0, 1), (1, 2), (2, 1)))::bigint) illegal
  from symbols group by conv_id),
best as (
  select conv_id, n i, {{c: 0::bigint, a: ''}} v0, {{c: 6::bigint, a: 'II'}} v1, {{c: 3::bigint, a: 'I'}} v2, {{c: 0::bigint, a: ''}} v3
  from counts
  union all
  select conv_id, i, {_inserted(0)}, {_inserted(1)}, {_inserted(2)}, {_inserted(3)} from (
    select b.conv_id, b.i - 1 i, {_before(0)} b0, {_before(1)} b1, {_before(2)} b2, {_before(3)} b3
    from best b join (select conv_id, i, initial role, cut, gone from symbols) s
      on s.conv_id is not distinct from b.conv_id and s.i = b.i)),
solved as (select conv_id, v0.c cost, v0.a audit from best where i = 0),
letters as (select conv_id, j, audit[j] letter,
    length(replace(left(audit, j), 'I', '')) i,
    length(replace(left(audit, j), 'D', '')) made
  from (select *, unnest(range(1, length(audit) + 1)) j from solved)),
turns as (select l.conv_id, j, letter, made, role, initial, text,
    bool_or(letter = 'K' and initial = 0) over (partition by l.conv_id) led
  from letters l left join symbols s
    on s.conv_id is not distinct from l.conv_id and s.i = l.i and letter <> 'I'
  where letter <> 'D'),
hashes as (select conv_id, sha256(string_agg(
    case when letter = 'K' then role when (made - led::bigint) % 2 = 1 then 'user' else 'assistant' end
    || ':' || case when letter = 'I' then '' else text end, chr(10) order by j)) h
  from turns group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank,
  coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
  coalesce(illegal, 0)::bigint illegal, coalesce(cost, 0)::bigint "cost", coalesce(audit, '') audit,
  coalesce(h, sha256('')) repaired_sha256
from (select distinct conv_id from conversations) c
left join counts n on n.conv_id is not distinct from c.conv_id
left join solved s on s.conv_id is not distinct from c.conv_id
left join hashes h on h.conv_id is not distinct from c.conv_id"""
