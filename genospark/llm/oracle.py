"""SQL of the queries that SQL can express."""

# Two conversations of one opening: see preferences.pairs_of_conversations and formatted_preferences.
OP2_PREFERENCES = """
with turns as (
    select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn, coalesce(role, ''), coalesce(text, '')) as turns
    from conversations where conv_id is not null group by conv_id
), answered as (
    select *, list_filter(turns, lambda t: t.role = 'assistant') as answers,
           len(turns) - coalesce(list_position(list_reverse(list_transform(turns, lambda t: t.role)), 'assistant'), 0) + 1 as final
    from turns
), pairs as (
    select a.conv_id as pair_id, a.turns as chosen,
           case when len(a.answers) = 0 then a.turns
                else list_concat(a.turns[1:a.final - 1], case when len(b.answers) > 0 then b.answers[-1:] else [] end) end as rejected
    from answered a left join answered b on a.conv_id = xor(b.conv_id, 1)
), counted as (
    select *, coalesce(list_position(list_transform(range(greatest(len(chosen), len(rejected))), lambda i: chosen[i + 1] is not distinct from rejected[i + 1]), false) - 1, len(chosen)) as n
    from pairs
), split as (
    select pair_id, n, chosen[1:n] as shared, chosen[n + 1:] as c, rejected[n + 1:] as r from counted
), rendered as (
    select pair_id, n, c, r,
           list_transform(shared, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as ps,
           list_transform(c, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as cs,
           list_transform(r, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as rs
    from split
)
select pair_id, cast(n as int) as n_prompt_turns,
       coalesce(array_to_string(ps, ''), '') as prompt, coalesce(array_to_string(cs, ''), '') as chosen, coalesce(array_to_string(rs, ''), '') as rejected,
       coalesce(array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'),
           lambda i: cast(length(array_to_string(cs[1:i - 1], '')) + 13 + length(c[i].role) as varchar) || '-' || cast(length(array_to_string(cs[1:i], '')) - 1 as varchar)), ','), '') as chosen_spans,
       coalesce(array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'),
           lambda i: cast(length(array_to_string(rs[1:i - 1], '')) + 13 + length(r[i].role) as varchar) || '-' || cast(length(array_to_string(rs[1:i], '')) - 1 as varchar)), ','), '') as rejected_spans
from rendered
"""

# Words, lines and windows as lists; see quality_rules.text_features and default_rules.
OP11_QUALITY_RULES = r"""
with parts as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents
), numbered as (
    select row_number() over () as row, * from parts
), windows as (
    select row, unnest(range(1, len(words) - 1)) as i, unnest(list_transform(range(1, len(words) - 1), lambda i: [words[i], words[i + 1], words[i + 2]])) as w
    from numbered
), places as (
    select row, i from windows qualify count(*) over (partition by row, w) > 1
), repeated as (
    select row, count(distinct p) as n from (select row, unnest([i, i + 1, i + 2]) as p from places) group by row
), counted as (
    select doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
           cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(lines) as bigint) as n_lines,
           cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
           len(list_filter(words, lambda x: regexp_matches(x, '\pL'))) as n_letters,
           len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[-*\x{2022}\x{2023}\x{25AA}\x{25CF}]'))) as n_bullets,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[ \t\r]*$'))) as n_ellipses
    from numbered left join repeated r using (row)
), based as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or word_chars < 3 * n_words or word_chars > 10 * n_words or 10 * n_symbols > n_words or 10 * n_dup_lines > 3 * n_lines
            or 10 * n_letters < 8 * n_words or 10 * n_bullets > 9 * n_lines or 10 * n_ellipses > 3 * n_lines) as kept
from based
"""

# Costs from each turn to the end, then the edits from the first turn on, as two recursions; states 1 to 4 are nothing,
# system, user and assistant. See conversation_repair.damaged and repaired_turns.
OP13_CONVERSATION_REPAIR = r"""
with recursive hashed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda c: ascii(c)::bigint)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 20 as kind
    from conversations
), damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
           case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy
    from hashed where kind <> 0
), seen as (
    select *, row_number() over (partition by conv_id, role, text order by turn nulls first) as nth from damaged
), placed as (
    select *, left(role, 1) as initial, row_number() over (partition by conv_id order by turn nulls first, role, text, nth) as i from seen
), judged as (
    select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when nth > 1 then 'duplicate' when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
           coalesce(lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au'), false) as wrong
    from placed
), turns as (
    select *, fault in ('', 'truncated') as stays, case when fault = 'truncated' then 1 else 0 end as late from judged
), counted as (
    select conv_id, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated, count(*) filter (wrong) as illegal
    from turns group by conv_id
), costs as (
    select conv_id, n + 1 as i, [0, 4, 2, 0] as g from counted
    union all
    select conv_id, i, [least(h[1], 2 + u), least(h[2], 2 + u), u, a] as g
    from (select conv_id, i, h, least(h[3], 2 + h[4]) as u, least(h[4], 2 + h[3]) as a from (
        select t.conv_id, t.i, [least(3 + g[1], case when stays then least(2 + late + g[3], case initial when 's' then late + g[2] when 'u' then late + g[3] end) end),
                                least(3 + g[2], case when stays then least(2 + late + g[3], case initial when 'u' then late + g[3] end) end),
                                least(3 + g[3], case when stays then least(2 + late + g[4], case initial when 'a' then late + g[4] end) end),
                                least(3 + g[4], case when stays then least(2 + late + g[3], case initial when 'u' then late + g[3] end) end)] as h
        from costs c join turns t on t.conv_id is not distinct from c.conv_id and t.i = c.i - 1))
), steps as (
    select c.conv_id, c.i, c.g, d.g as after, t.role, t.text, t.initial, t.stays, t.late
    from costs c left join costs d on d.conv_id is not distinct from c.conv_id and d.i = c.i + 1 left join turns t on t.conv_id is not distinct from c.conv_id and t.i = c.i
), trace as (
    select conv_id, n, 1::bigint as i, 1 as q, '' as audit, []::varchar[] as lines, 0 as cost from counted
    union all
    select conv_id, n, case when e = 'I' then i else i + 1 end, case e when 'D' then q when 'K' then kept else given end, audit || e,
           case e when 'D' then lines when 'K' then list_append(lines, role || ':' || text) else list_append(lines, case given when 3 then 'user:' else 'assistant:' end || case when e = 'R' then text else '' end) end,
           cost + case e when 'D' then 3 when 'I' then 2 when 'K' then late else 2 + late end
    from (select *, case when 3 + after[q] = g[q] then 'D' when 2 + g[given] = g[q] then 'I' when stays and late + after[kept] = g[q] then 'K' else 'R' end as e
          from (select x.*, s.g, s.after, s.role, s.text, s.stays, s.late, case when q = 3 then 4 else 3 end as given,
                       case when initial = 's' and q = 1 then 2 when initial = 'u' and q <> 3 then 3 when initial = 'a' and q = 3 then 4 end as kept
                from trace x join steps s on s.conv_id is not distinct from x.conv_id and s.i = x.i
                where not (x.i = x.n + 1 and x.q in (1, 4))))
), ended as (
    select conv_id, audit, cost, array_to_string(lines, chr(10)) as repaired from trace where i = n + 1 and q in (1, 4)
)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) a
left join counted c on c.conv_id is not distinct from a.conv_id left join ended e on e.conv_id is not distinct from a.conv_id
"""

SQL: dict[str, str] = {"op2_preferences": OP2_PREFERENCES, "op11_quality_rules": OP11_QUALITY_RULES, "op13_conversation_repair": OP13_CONVERSATION_REPAIR}
