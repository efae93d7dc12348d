"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

from __future__ import annotations

_ORACLES = {
    "op6_quality_rules": r"""
with cut as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select *, list_transform(range(1, len(words) - 1), lambda i: {'a': words[i], 'b': words[i + 1], 'c': words[i + 2]}) as w
  from cut),
places as (
  select doc_id, unnest(w) as three, unnest(range(1, len(w) + 1)) as place, row
  from (select *, row_number() over () as row from windows)),
twice as (
  select row, place, count(*) over (partition by row, three) as n from places),
covered as (
  select row, count(distinct p) as n_repeat_words
  from (select row, unnest([place, place + 1, place + 2]) as p from twice where n > 1) group by row),
base as (
  select c.doc_id, c.text, len(words) as n_words, len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(lines) as n_lines,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(r.n_repeat_words, 0) as n_repeat_words
  from (select *, row_number() over () as row from windows) c left join covered r using (row)),
failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and not 100 * n_symbols > 10 * n_words
       and word_chars between 2 * n_words and 12 * n_words
       and not 100 * n_dup_lines > 40 * n_lines
       and not 100 * len(regexp_replace(text, '[^!]+', '', 'g')) > 50 * n_words
       and not 100 * len(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) > 40 * word_chars
       and not 100 * len(regexp_replace(text, '[^\p{L}]+', '', 'g')) < 60 * word_chars as kept
from failed
""",
    "op7_mixing": r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
per as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from sized group by source),
levels as (
  select *, (sum(source_size) over () * 1.5::double - coalesce(sum(2 * source_size) over (
               order by 2 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by 2 * source_size / weight, source nulls last
                                rows between current row and unbounded following) as level
  from per),
chosen as (select min(level) as level from (
  select level from levels where level <= 2 * source_size / weight order by 2 * source_size / weight limit 1)),
targets as (
  select source, source_size, coalesce(least(2.0::double * source_size, chosen.level * weight), 2.0::double * source_size) as target
  from levels, chosen),
rates as (
  select *, case when source_size > 0 then target / source_size else 0.0::double end as rate from targets)
select doc_id, size, source_size, target,
       (size * (floor(rate) + case when
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / 4503599627370496.0::double
         < rate - floor(rate) then 1 else 0 end))::bigint as taken
from sized left join rates on sized.source is not distinct from rates.source
""",
    "op11_lexical_search": r"""
with cut as (
  select item_id, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select null as item_id, doc_id, text from documents union all select item_id, null, text from benchmark)),
asked as (select item_id, term, count(*) as repeats from cut where item_id is not null group by all),
tf as (select doc_id, term, count(*) as tf from cut where doc_id is not null group by all),
sizes as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
whole as (select count(*) as many, sum(n)::bigint as words from sizes),
weights as (
  select term, floor(1000 * ln((2 * many + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, whole group by term, many),
scores as (
  select item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * many) // words))))::bigint as score
  from asked join tf using (term) join weights using (term) join sizes using (doc_id), whole group by all)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
where rank <= 20
""",
    "op12_exact_search": """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id != c.vec_id)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 20
""",
    "op13_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
sizes as (select lang, sum(len(words))::bigint as n from cut group by lang),
counts as (
  select lang, words, count(*) as f
  from (select lang, unnest(list_transform(range(1, len(words) - k + 2), lambda i: words[i:i + k - 1])) as words
        from cut, range(1, 6) as lengths(k) where len(words) >= k)
  group by all having count(*) >= 100),
longer as (
  select lang, unnest([words[1:len(words) - 1], words[2:]]) as words, f from counts where len(words) > 2),
most as (select lang, words, max(f) as f from longer group by all),
kept as (
  select c.* from counts c left join most m using (lang, words) where len(words) > 1 and coalesce(m.f, 0) < c.f),
cuts as (
  select lang, words, f, unnest(range(1, len(words))) as k from kept),
scored as (
  select c.lang, c.words, c.f as a, k, l.f as l, r.f as r, n,
         ((1000::hugeint * c.f * n) // (l.f::hugeint * r.f))::bigint as score
  from cuts c join counts l on l.lang = c.lang and l.words = c.words[1:k]
  join counts r on r.lang = c.lang and r.words = c.words[k + 1:] join sizes s on s.lang = c.lang),
lowest as (
  select * from scored qualify row_number() over (partition by lang, words order by score, k) = 1),
ranked as (
  select lang, array_to_string(words, ' ') as phrase, a, l, r, n, score,
         row_number() over (partition by lang order by score desc, a desc, array_to_string(words, ' ')) as rank
  from lowest)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
""",
}


def llm_oracles() -> dict[str, str]:
    return dict(_ORACLES)
