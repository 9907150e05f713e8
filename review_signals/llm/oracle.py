"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

from review_signals.llm.risk_thresholds import COUNTS, RULES, Risk, Rule, steps

_WORD = r"[^\x20\x09-\x0D]+"


def _preference_format() -> str:
    def completion(side: str, extra: str) -> str:
        """Text and mask of the turns after the prompt; ``place`` is where a turn's text starts in the completion."""
        return f"""
  select x.pair_id,
         string_agg('<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10), '' order by x.n) as txt,
         string_agg(case when x.role = 'assistant' then (x.after - length(x.text) - 11)::varchar || ':' || x.after::varchar end,
                    ',' order by x.n) as mask
  from (select t.*, sum(12 + length(t.role) + 1 + length(t.text) + 11) over (partition by t.pair_id order by t.n) as after
        from {side} t join prefix p using (pair_id) where t.n > p.n_prompt_turns) x
  group by x.pair_id {extra}"""

    return f"""
with turns as (
  select distinct conv_id as pair_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
leaves as (select pair_id, max(turn) as leave from turns where role = 'assistant' group by pair_id),
chosen as (select *, row_number() over (partition by pair_id order by turn nulls first, role, text) as n from turns),
mixed as (
  select t.* from turns t left join leaves l using (pair_id) where coalesce(t.turn < l.leave, true)
  union
  select l.pair_id, t.turn, t.role, t.text from turns t join leaves l on xor(t.pair_id, 1) = l.pair_id and t.turn >= l.leave),
rejected as (select *, row_number() over (partition by pair_id order by turn nulls first, role, text) as n from mixed),
sides as (
  select pair_id, n, c.role as crole, c.text as ctext, r.role as rrole, r.text as rtext, c.n is not null and r.n is not null as both_there
  from (select pair_id, n, n as k, role, text from chosen) c full join (select pair_id, n, n as k, role, text from rejected) r
  using (pair_id, n)),
prefix as (
  select pair_id, coalesce(min(n) filter (not (coalesce(crole = rrole and ctext = rtext, false))) - 1, max(n)) as n_prompt_turns
  from sides group by pair_id),
prompts as (
  select t.pair_id, string_agg('<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10), '' order by t.n) as prompt
  from chosen t join prefix p using (pair_id) where t.n <= p.n_prompt_turns group by t.pair_id),
c as ({completion("chosen", "")}),
r as ({completion("rejected", "")})
select p.pair_id, p.n_prompt_turns, coalesce(q.prompt, '') as prompt,
       coalesce(c.txt, '') as chosen, coalesce(r.txt, '') as rejected,
       coalesce(c.mask, '') as chosen_mask, coalesce(r.mask, '') as rejected_mask
from prefix p left join prompts q using (pair_id) left join c using (pair_id) left join r using (pair_id)"""


MEASURED = f"""
texts as (select row_number() over () as rid, doc_id, lang, coalesce(text, '') as text from documents),
words as (select rid, w, row_number() over (partition by rid order by i) as i
          from (select rid, unnest(regexp_extract_all(text, '{_WORD}')) as w,
                       generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) as i from texts)),
grams as (select rid, i, count(*) over (partition by rid, g) as c
          from (select rid, i, concat_ws(' ', w, lead(w, 1) over o, lead(w, 2) over o, lead(w, 3) over o, lead(w, 4) over o) as g,
                       lead(w, 4) over o as fifth from words window o as (partition by rid order by i))
          where fifth is not null),
again as (select rid, count(distinct i + s) as n from grams, (select unnest(range(5)) as s) where c > 1 group by rid),
per_word as (select rid, count(*) as n_words, sum(length(w)) as word_chars,
                    count(*) filter (regexp_matches(w, '[.,;:!?]$')) as n_closed from words group by rid),
lines as (select rid, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines
          from (select rid, unnest(string_split(text, chr(10))) as l from texts) where regexp_matches(l, '{_WORD}') group by rid),
measured as (
  select doc_id, lang as stratum, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(again.n, 0)::bigint as n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_upper,
         coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_closed, 0)::bigint as n_closed
  from texts left join per_word using (rid) left join lines using (rid) left join again using (rid))"""


def _breaks(rule: Rule, cutoff: str) -> str:
    return f"coalesce({rule.top} / nullif({rule.bottom}, 0)::double {'<' if rule.below else '>'} {cutoff}, false)"


def _risk_thresholds(risk: Risk = Risk()) -> str:  # noqa: B008
    """The binomial test by sums of log gammas; a setting holds if it and all before it pass."""
    base = "(n_words < 10 or 100 * n_repeat_words > 20 * n_words)"
    order = steps(RULES)
    broken = ", ".join(f"case when {_breaks(rule, str(cutoff))} then {step} end" for step, (rule, cutoff) in enumerate(order))
    names = ", ".join(f"'{rule.name}'" for rule, _ in order)
    return f"""
with {MEASURED},
judged as (select *, {base} as base_failed, least({broken}) as first_step from measured),
good as (select * from judged where not base_failed
         and doc_id in (select doc_id from labels group by doc_id having min(quality) = 1)),
sizes as (select stratum, count(*) as n from good group by stratum),
counted as (select s.stratum, s.n, t.step, count(g.doc_id) as k from sizes s cross join (select unnest(range({len(order)})) as step) t
            left join good g on g.stratum is not distinct from s.stratum and g.first_step <= t.step group by all),
tested as (
  select *, case when k > n * {risk.risk} then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk.risk}) + (n - i) * ln(1 - {risk.risk})))) end as p
  from counted),
held as (
  select *, max(case when p > {risk.error} / (select greatest(1, count(*)) from sizes) then 1 else 0 end)
            over (partition by stratum order by step) as failed from tested),
valid as (select stratum, max(step) as last_step from held where failed = 0 group by stratum),
ruled as (select j.*, case when first_step <= last_step then list_extract([{names}], (first_step + 1)::int) end as broken_rule
          from judged j left join valid v on j.stratum is not distinct from v.stratum)
select doc_id, {", ".join(COUNTS)}, base_failed, broken_rule, not base_failed and broken_rule is null as kept from ruled"""


def _spaced_seeds(window: int = 13, least: int = 11) -> str:
    """Counts equal words per alignment, then slides the window where there are enough of them; shorter items are sought whole."""
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
with d as (select doc_id, {words} as w from documents),
b as (select item_id, {words} as w from benchmark),
dw as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) as i from d where len(w) >= {window}),
bw as (select item_id, unnest(w) as w, generate_subscripts(w, 1) as i from b where len(w) >= {window}),
same as (select doc_id, item_id, dw.i - bw.i as shift, bw.i as spot from dw join bw using (w)),
dense as (select doc_id, item_id, shift from same group by all having count(distinct spot) >= {least}),
lens as (select dense.*, len(d.w) as dn, len(b.w) as bn from dense join d using (doc_id) join b using (item_id)),
slid as (
  select doc_id, item_id, s.shift, s.spot, count(*) over (partition by doc_id, item_id, s.shift order by s.spot
         range between current row and {window - 1} following) as c, dn, bn
  from (select distinct * from same) s join lens using (doc_id, item_id, shift))
select doc_id, item_id, max(c) as equal_words, max(c) / {window}.0::double as similarity
from slid where c >= {least}
  and least(bn, dn - shift) - greatest(1, 1 - shift) + 1 >= {window}
group by doc_id, item_id
union all
select distinct doc_id, item_id, len(b.w)::bigint, 1.0::double
from d join b on len(b.w) between 1 and {window - 1}
  and contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(b.w, ' ') || ' ')"""


def _line_windows() -> str:
    return f"""
with raw as (select doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
lines as (select doc_id, pos, line, regexp_matches(line, '{_WORD}') as worded,
                 sum(regexp_matches(line, '{_WORD}')::int) over (partition by doc_id order by pos) as n from raw),
windows as (select doc_id, n, line || chr(10) || lead(line, 1) over o || chr(10) || lead(line, 2) over o as t
            from lines where worded window o as (partition by doc_id order by n)),
later as (select doc_id, n, row_number() over (partition by t order by doc_id, n) as k from windows where t is not null),
gone as (select distinct doc_id, n + s as n from later, (select unnest(range(3)) as s) where k > 1),
spans as (select doc_id, count(*) as n_removed, count(*) filter (n - coalesce(before, -1) > 1) as n_spans
          from (select doc_id, n, lag(n) over (partition by doc_id order by n) as before from gone) group by doc_id),
kept as (select doc_id, string_agg(line, chr(10) order by pos) as text from lines l
         where not (worded and exists (select 1 from gone g where g.doc_id = l.doc_id and g.n = l.n)) group by doc_id)
select d.doc_id, coalesce(c.n_lines, 0)::bigint as n_lines, coalesce(s.n_removed, 0) as n_removed, coalesce(s.n_spans, 0) as n_spans,
       sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join (select doc_id, max(n) as n_lines from lines group by doc_id) c using (doc_id)
left join spans s using (doc_id) left join kept k using (doc_id)"""


def _spelling_variants() -> str:
    """Near words by deleted letters; crc32 byte by byte, with its table made of the polynomial."""
    return r"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
runs as (
  select coalesce(doc_id::varchar, '') || ':' as prefix, run, count(*) as times
  from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\x{C0}-\x{FF}]+')) as run from documents)
  where length(run) >= 7 group by all),
hashed as (
  select run, times, xor(list_reduce(list_transform(range(1, octet_length(encode(prefix || run)) + 1),
      lambda k: ('0x' || substr(hex(encode(prefix || run)), 2 * k::int - 1, 2))::bigint),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) as h
  from runs, crc_table),
words as (
  select word, sum(times)::bigint as n
  from (select times, case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from hashed)
  where length(word) >= 7 group by word having sum(times) >= 2),
less as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
         from (select word, n, unnest(range(1, length(word) + 1))::int as i from words)),
pairs as (
  select a.word, b.word as near, b.n as near_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union
  select a.word, w.word, w.n from less a join words w on w.word = a.rest
  union
  select w.word, a.word, a.n from less a join words w on w.word = a.rest),
ranked as (select *, count(*) over (partition by word) as n_near, row_number() over (partition by word order by near_n desc, near) as k from pairs),
forms as (
  select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when r.near_n >= 10 * w.n then r.near end as form,
         case when r.near_n >= 10 * w.n then r.near_n end as form_n
  from words w left join (select * from ranked where k = 1) r using (word)),
follow as (
  select word, word as at, form from forms
  union all
  select o.word, f.word, f.form from follow o join forms f on f.word = o.form)
select f.word, f.form, o.at as root, f.n, f.n_near, f.form_n from forms f join follow o using (word) where o.form is null"""


ORACLE = {
    "op1_preference_format": _preference_format(),
    "op2_risk_thresholds": _risk_thresholds(),
    "op3_spaced_seeds": _spaced_seeds(),
    "op7_line_windows": _line_windows(),
    "op12_spelling_variants": _spelling_variants(),
}
