"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

from lanewise.llm import quality_rules

_NGRAMS = "\n".join(
    f""", g{n} as (
    select doc_id, sum(case when hit then chars else 0 end) as inside
    from (
        select p.doc_id, p.chars, max(coalesce(w.times, 0)) over (
            partition by p.doc_id order by p.i rows between {n - 1} preceding and current row) > 1 as hit
        from positions p left join (
            select doc_id, i, count(*) over (partition by doc_id, gram) as times
            from (
                select doc_id, i, list(word) over (
                    partition by doc_id order by i rows between current row and {n - 1} following) as gram
                from positions
            ) where len(gram) = {n}
        ) w using (doc_id, i)
    ) group by doc_id
)"""
    for n in (3, *quality_rules.NGRAM_LIMITS)
)
_LIMITS = " and ".join(f"g{n}.inside <= {limit} * c.word_chars" for n, limit in quality_rules.NGRAM_LIMITS.items())
_JOINS = "\n".join(f"left join g{n} using (doc_id)" for n in quality_rules.NGRAM_LIMITS)

QUALITY_RULES = rf"""
with texts as (select doc_id, coalesce(text, '') as text from documents)
, words as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from texts)
, positions as (
    select doc_id, i, words[i] as word, length(words[i]) as chars
    from (select doc_id, words, unnest(range(1, len(words) + 1)) as i from words)
)
, lines as (
    select doc_id, line, row_number() over (partition by doc_id, line) as turn
    from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
    where regexp_matches(line, '[^\x20\x09-\x0D]')
)
, line_sums as (
    select doc_id, count(*) filter (turn > 1) as dup, sum(length(line)) as chars, sum(case when turn > 1 then length(line) else 0 end) as dup_chars
    from lines group by doc_id
)
, counts as (
    select doc_id, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols
    from words
)
, repeats as (
    select doc_id, count(*) filter (hit) as n
    from (
        select p.doc_id, max(coalesce(w.times, 0)) over (
            partition by p.doc_id order by p.i rows between 2 preceding and current row) > 1 as hit
        from positions p left join (
            select doc_id, i, count(*) over (partition by doc_id, gram) as times
            from (
                select doc_id, i, list(word) over (partition by doc_id order by i rows between current row and 2 following) as gram
                from positions
            ) where len(gram) = 3
        ) w using (doc_id, i)
    ) group by doc_id
)
{_NGRAMS}
select doc_id, c.n_words::bigint as n_words, c.word_chars::bigint as word_chars, c.n_symbols::bigint as n_symbols,
    coalesce(l.dup, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
    (c.n_words < {quality_rules.MIN_WORDS} or 100 * coalesce(r.n, 0) > 50 * c.n_words) as base_failed,
    not (c.n_words < {quality_rules.MIN_WORDS} or 100 * coalesce(r.n, 0) > 50 * c.n_words)
        and {_LIMITS}
        and l.dup_chars <= {quality_rules.LINE_LIMIT} * l.chars
        and c.n_symbols <= {quality_rules.SYMBOL_LIMIT} * c.word_chars as kept,
    coalesce(g{max(quality_rules.NGRAM_LIMITS)}.inside, 0)::bigint as chars_in_longest,
    coalesce(l.dup_chars, 0)::bigint as chars_in_dup_lines
from counts c left join line_sums l using (doc_id) left join repeats r using (doc_id)
{_JOINS}
"""

NEAR_VECTORS = """
with recursive units as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
)
, links as (
    select a.vec_id as a, b.vec_id as b from units a join units b on a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.9
)
, reach as (
    select vec_id as a, vec_id as b from embeddings
    union
    select reach.a, links.b from reach join links on reach.b = links.a
)
, low as (select a as vec_id, min(b) as component_id from reach group by a)
, degree as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from low left join degree using (vec_id)
"""

MIXING = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
)
, items as (select doc_id, source, size, count(*)::bigint as n from sized group by all)
, sizes as (select source, sum(size * n)::bigint as source_size from items group by source)
, ranked as (
    select *, row_number() over (order by source nulls last) as rank, 3 * source_size as most from sizes
)
, weighed as (select *, [5, 2, 1][((rank - 1) % 3 + 1)::int] as weight from ranked)
, levels as (
    select *,
        (sum(source_size) over () - coalesce(sum(most) over before, 0))::double
            / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as level
    from weighed
    window before as (order by most / weight, rank rows between unbounded preceding and 1 preceding)
)
, targets as (
    select rank, source, source_size, least(most::double, weight * max(level) over ()) as target from levels
)
, streams as (
    select i.*, t.source_size, t.target, floor(t.target + 0.5)::bigint as words,
        coalesce(sum(i.size * i.n) over (
            partition by t.rank order by md5(coalesce(i.doc_id::varchar, '')), i.doc_id nulls first, i.size
            rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from items i join targets t on i.source is not distinct from t.source
)
, sums as (
    select *, case when source_size = 0 then 0 else
        (words // source_size) * size * n
        + greatest(0, least(start + size * n, words % source_size) - start) end as taken_all
    from streams
)
select doc_id, size, source_size, target, (taken_all // n)::bigint as taken from (select *, unnest(range(n)) from sums)
"""


def _trees(entries: str, out: str, levels: int, claim: bool) -> str:
    """CTEs that build the trees over `entries` (g, p, n, d) level by level: <out>_top (g, d), and <out>_proof with each entry's
    siblings up to its root as `proof`, and its `c` folded with them. n is the number of nodes on the level of a group."""
    parts = [f", {out}_0 as (select g, p, n, d from {entries})", f", {out}_p0 as (select g, p, d as leaf, {'c' if claim else 'd as c'}, '' as proof, {'doc_id' if claim else '0 as doc_id'} from {entries})"]
    for i in range(levels):
        span = 8**i
        parts.append(f""", {out}_r{i} as (select g, p // 8 as run, list(d order by p) as ds from {out}_{i} where n > 1 group by g, p // 8)
, {out}_{i + 1} as (select g, run as p, 1 as n, sha256(array_to_string(ds, '')) as d from {out}_r{i})
, {out}_s{i} as (
    select x.*, array_to_string(ds[1 : p // {span} % 8], '') as lefts, array_to_string(ds[p // {span} % 8 + 2 :], '') as rights, ds is not null as up
    from {out}_p{i} x left join {out}_r{i} r on x.g is not distinct from r.g and x.p // {span * 8} = r.run
)
, {out}_p{i + 1} as (
    select g, p, leaf, case when up then sha256(lefts || c || rights) else c end as c, case when up then proof || lefts || rights else proof end as proof, doc_id
    from {out}_s{i}
)""")
        parts[-1] = parts[-1].replace("1 as n", "count(*) over (partition by g) as n")
    return "\n".join(parts)


_CRC = """list_reduce(list_concat([4294967295], list_transform(range(1, length(t) + 1), lambda i: ascii(substring(t, i, 1))::bigint)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _row(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("t", "source", "lang", "n_chars::varchar", text)) + ")"


#: Trees of up to 8 ** 8 documents a language and 8 ** 4 languages.
MERKLE = f"""
with docs as (
    select doc_id, doc_id::varchar as t, source, lang, n_chars, text,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered
    from documents
)
, leaves as (
    select doc_id, lang as g, {_row("text")} as d,
        case when t is not null and xor({_CRC}, 4294967295) % 3 = 0 then {_row("lowered")} else {_row("text")} end as c
    from docs
)
, entries as (
    select *, row_number() over (partition by g order by doc_id nulls first, d) - 1 as p, count(*) over (partition by g) as n from leaves
)
{_trees("entries", "lower", 8, True)}
, tops as (select g as lang, d from lower_0 where n = 1 {" ".join(f"union all select g, d from lower_{i} where n = 1" for i in range(1, 9))})
, subroots as (
    select 0 as g, lang, d, row_number() over (order by lang nulls first) - 1 as p, count(*) over () as n
    from (select lang, any_value(d) as d from tops group by lang)
)
{_trees("subroots", "upper", 4, False)}
, roots as (select d from upper_0 where n = 1 {" ".join(f"union all select d from upper_{i} where n = 1" for i in range(1, 5))})
, above as (select lang, s.d as subroot, u.p from subroots s join upper_p4 u on s.p = u.p)
, folded as (
    select x.doc_id, x.leaf, a.subroot, (select any_value(d) from roots) as root, x.proof as low, a.p, x.c
    from lower_p8 x join above a on x.g is not distinct from a.lang
)
"""


def _refold() -> str:
    """Fold what leads to a subroot on to the root, with the siblings that the upper tree keeps per level."""
    parts = [", up0 as (select *, '' as high from folded)"]
    for i in range(4):
        span = 8**i
        parts.append(f""", up{i + 1} as (
    select doc_id, leaf, subroot, root, low, p, case when ds is null then c else sha256(lefts || c || rights) end as c,
        case when ds is null then high else high || lefts || rights end as high
    from (select x.*, r.ds, array_to_string(ds[1 : p // {span} % 8], '') as lefts, array_to_string(ds[p // {span} % 8 + 2 :], '') as rights
        from up{i} x left join upper_r{i} r on x.p // {span * 8} = r.run)
)""")
    return "\n".join(parts)


MERKLE += f"""{_refold()}
select doc_id, leaf, subroot, root, sha256(low || high) as proof_sha256, c as folded_root, c = root as verified from up4
"""


def _step(state: str, cost: str, edit: str, row: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t || {row}}}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


_U, _A = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
#: Rows put in, then one row edited, from each of the states 0 (nothing yet), 1 (after s), 2 (after u) and 3 (after a).
_PUT_IN = f"""s0 as t0, s1 as t1,
    {_least("s2", _step("s0", "5", "I", _U), _step("s1", "5", "I", _U), _step("s3", "5", "I", _U))} as t2,
    {_least("s3", _step("s2", "5", "I", _A), _step("s0", "10", "II", f"{_U} || {_A}"), _step("s1", "10", "II", f"{_U} || {_A}"))} as t3"""


def _kept(state: str, initial: str, name: str) -> str:
    """The row under its own role where that fits, else under the role that does; not at all if it has to go."""
    keep = _step(state, "cut", "K", "chr(10) || role || ':' || text")
    change = _step(state, "(1 + cut)", "R", f"chr(10) || '{name}:' || text")
    return f"case when gone then {_step(state, '1000000', 'X')} when initial = '{initial}' then {keep} else {change} end"


_ONLY_S = f"case when gone or initial <> 's' then {_step('t0', '1000000', 'X')} else {_step('t0', 'cut', 'K', "chr(10) || role || ':' || text")} end"
_EDITED = f"""{_step("t0", "2", "D")} as s0, {_least(_step("t1", "2", "D"), _ONLY_S)} as s1,
    {_least(_step("t2", "2", "D"), *[_kept(t, "u", "user") for t in ("t0", "t1", "t3")])} as s2,
    {_least(_step("t3", "2", "D"), _kept("t2", "a", "assistant"))} as s3"""

CONVERSATIONS = rf"""
with recursive drawn as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor({_CRC}, 4294967295) % 20 as draw
    from (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as t from conversations)
)
, damaged as (
    select conv_id, turn, case when draw = 4 then 'user' else role end as role,
        case draw when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
    from (select *, unnest(range(case draw when 0 then 0 when 3 then 2 else 1 end)) as copy from drawn)
)
, placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, substring(role, 1, 1) as initial,
        not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last
    from damaged
)
, marked as (
    select *, case when blank then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
        when last not in ('.', '!', '?') then 'truncated' else '' end as fault,
        lag(initial) over (partition by conv_id order by i) as before
    from placed
)
, turns as (
    select conv_id, i, initial, role, text, fault in ('blank', 'duplicate') as gone, case when fault = 'truncated' then 5 else 0 end as cut from marked
)
, ids as (select distinct conv_id from conversations)
, walk as (
    select conv_id, 0 as i, {{'c': 0, 'a': '', 't': ''}} as s0, {{'c': 1000000, 'a': '', 't': ''}} as s1, {{'c': 1000000, 'a': '', 't': ''}} as s2,
        {{'c': 1000000, 'a': '', 't': ''}} as s3
    from ids
    union all
    select conv_id, i + 1, {_EDITED}
    from (select w.conv_id, w.i, {_PUT_IN}, r.role, r.text, r.initial, r.gone, r.cut
        from walk w join turns r on w.conv_id is not distinct from r.conv_id and r.i = w.i + 1)
)
, ends as (
    select conv_id, {_least("t0", "t3")} as best
    from (select conv_id, {_PUT_IN} from walk qualify row_number() over (partition by conv_id order by i desc) = 1)
)
, counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
    from marked group by conv_id
)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
    coalesce(illegal, 0) as illegal, best.c::bigint as cost, best.a as audit, sha256(substring(best.t, 2)) as repaired_sha256
from ends e left join counts c on e.conv_id is not distinct from c.conv_id
"""
