"""SQL of the queries that SQL can express."""

from colloquy.llm.quality_rules import STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLES = {
    "op5_quality_rules": rf"""
with d as (
  select row_number() over () id, doc_id, lang, coalesce(text, '') t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents),
g as (
  select id, i, array_to_string(w[i:i+7], ' ') s
  from (select id, w, unnest(range(1, len(w) - 6)) i from d)),
again as (select id, i from (select id, i, count(*) over (partition by id, s) c from g) where c > 1),
cover as (
  select id, count(distinct i + k) n from again, (select unnest(range(0, 8)) k) group by id),
m as (
  select doc_id, lang, len(w) n_words, length(array_to_string(w, '')) word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l,
    coalesce(n, 0) n_repeat_words,
    len(list_filter(w, lambda x: list_contains([{_STOPS}], lower(x)))) n_stop_words
  from d left join cover using (id)),
f as (
  select *, len(l) - len(list_distinct(l)) n_dup_lines,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed
  from m)
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols,
  n_dup_lines::bigint n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
  not base_failed and word_chars between 2.5 * n_words and 12 * n_words
    and n_symbols <= 0.1::double * n_words 
    and (coalesce(lang not in ('en', 'fr', 'de', 'es'), true) or n_stop_words >= 0.04::double * n_words)
    and n_dup_lines <= 0.5 * len(l) kept
from f""",
    "op9_preference": """
with t as (
  select conv_id, turn, role, text from (
    select conv_id, turn, coalesce(role, 'user') role, coalesce(text, '') text,
      row_number() over (partition by conv_id, turn order by coalesce(role, 'user'), coalesce(text, '')) r
    from conversations where conv_id is not null and turn is not null) where r = 1),
e as (
  select conv_id, max(turn) stop, arg_max(text, turn) answer from t where role = 'assistant' group by 1),
o as (
  select e.conv_id, e.stop, coalesce(n.answer, '') other from e left join e n on n.conv_id = e.conv_id + 1),
p as (
  select t.*, stop, other, turn > stop or (turn = stop and text <> other) differs from t join o using (conv_id)),
f as (select *, coalesce(turn >= min(case when differs then turn end) over (partition by conv_id), false) after from p),
s as (
  select conv_id, turn, role, text, 'prompt' part from f where not after
  union all select conv_id, turn, role, text, 'chosen' from f where after
  union all select conv_id, turn, role, case when turn = stop then other else text end, 'rejected'
    from f where after and turn <= stop),
r as (
  select *, turn // 1000 chunk, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) line from s),
c as (
  select *, sum(length(line)) over (partition by conv_id, part, chunk order by turn) - length(line) start from r)
select conv_id, part, chunk::bigint chunk, count(*) n_turns, string_agg(line, '' order by turn) text,
  coalesce(string_agg(case when part <> 'prompt' and role = 'assistant'
    then (start + 13 + length(role))::bigint || ':' || (start + length(line) - 1)::bigint end, ',' order by turn), '') mask
from c group by 1, 2, 3""",
}
