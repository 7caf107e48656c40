"""SQL for DuckDB of linkage, find-or-create, slugs and word similarities.

Written from the definitions, one by one: words are paired by joins, greedy
orders and slugs by recursion in key order.
"""

from __future__ import annotations

from catalink.plans import sql as q

#: Longest common subsequence and edit distance of two lists.
LIST_LCS = "list_reduce({a}, lambda row, ch: list_reduce(range(1, len(row)), lambda acc, j: acc || [case when ({b})[j] = ch then row[j] + 1 else greatest(row[j + 1], acc[len(acc)]) end], [0]::bigint[]), list_transform(range(0, len({b}) + 1), lambda z: 0::bigint))[len({b}) + 1]"
LIST_LEV = "list_reduce({a}, lambda row, ch: list_reduce(range(1, len(row)), lambda acc, j: acc || [least(row[j + 1] + 1, acc[len(acc)] + 1, row[j] + case when ({b})[j] = ch then 0 else 1 end)], [row[1] + 1]), list_transform(range(0, len({b}) + 1), lambda z: z::bigint))[len({b}) + 1]"


def paired(p: str, source: str, keep: str = "true") -> str:
    """CTEs that end in ``{p}n`` (a, b, ta, tb, x, y): the different pairs of texts of
    ``source``, their words, and these as numbers, a word of a and its likeliest word of b alike."""
    same = q.LCS.format(a="w", b="v")
    return f"""{p}t as materialized (select row_number() over (order by a, b) as id, a, b, {q.words('a', True)} as ta, {q.words('b', True)} as tb from (select distinct a, b from {source} where a is not null and b is not null)),
{p}k as materialized (select * from {p}t where {keep}),
{p}a as (select id, unnest(range(1, len(ta) + 1)) as i, unnest(ta) as w from {p}k), {p}b as (select id, unnest(range(1, len(tb) + 1)) as j, unnest(tb) as v from {p}k),
{p}da as (select id, w, min(i) as i from {p}a group by all), {p}db as (select id, v, min(j) as j from {p}b group by all),
{p}w as materialized (select distinct w, v from {p}da join {p}db on {p}da.id = {p}db.id and w[1] = v[1]),
{p}s as materialized (select w, v from {p}w where starts_with(w, v) or starts_with(v, w) or {same} > 0.9 * least(length(w), length(v))),
{p}best as (select {p}da.id, {p}da.w, i, {p}db.v from {p}da join {p}db on {p}da.id = {p}db.id join {p}s on {p}s.w = {p}da.w and {p}s.v = {p}db.v
 qualify row_number() over (partition by {p}da.id, {p}da.w order by least(length({p}da.w), length({p}db.v)) / greatest(length({p}da.w), length({p}db.v)) desc, j) = 1),
{p}as as (select id, v, arg_max(w, i) as n from {p}best group by all),
{p}x as (select id, list('a' || w order by i) as x from {p}a group by id),
{p}y as (select {p}b.id, list(coalesce('a' || n, 'b' || {p}b.v) order by j) as y from {p}b left join {p}as on {p}as.id = {p}b.id and {p}as.v = {p}b.v group by {p}b.id),
{p}n as materialized (select a, b, ta, tb, coalesce(x, []) as x, coalesce(y, []) as y from {p}k left join {p}x using (id) left join {p}y using (id))"""


def by_words(score: str) -> str:
    """A word similarity of ``{p}n`` with its rules for equal and empty texts."""
    return f"case when a = b then 1 when ta = tb then case when len(ta) > 0 then 1 else 0 end when len(ta) = 0 or len(tb) = 0 then 0 else {score} end"


LONGER = by_words(LIST_LCS.format(a="x", b="y") + " / greatest(len(x), len(y))")
SHORTER = by_words(LIST_LCS.format(a="x", b="y") + " / least(len(x), len(y))")
#: Names as long as they must be to match above 0.9.
NEAR = "a = b or least(len(ta), len(tb)) > 0.9 * greatest(len(ta), len(tb))"
ORG = f"case when a = b then 1 when len(x) <= 2 or len(y) <= 2 or len(x) <= len(y) // 2 or len(y) <= len(x) // 2 or x[len(x)] <> y[len(y)] then 0 else {LIST_LCS.format(a='x', b='y')} / least(len(x), len(y)) end"


def token_pairs() -> str:
    cut = lambda x: f"list_distinct(list_transform(range(1, len({x}) - 1), lambda i: {x}[i] || '|' || {x}[i + 1] || '|' || {x}[i + 2]))"
    threes = by_words(f"case when len(list_distinct({cut('x')} || {cut('y')})) > 0 then len(list_intersect({cut('x')}, {cut('y')})) / len(list_distinct({cut('x')} || {cut('y')})) else 0 end")
    lev = by_words(f"1 - {LIST_LEV.format(a='x', b='y')} / greatest(len(x), len(y))")
    words = lambda x: rf"list_filter(string_split_regex(lower({x}), '[ \t\n\r\f\-&.,:()=\[\]''/]+'), lambda z: z <> '' and not list_contains([{', '.join(repr(w) for w in q.STOP_WORDS)}], z) and not regexp_matches(z, '^\p{{Nd}}+$'))"
    plain = "regexp_matches(s, '^[A-Za-z0-9_]+$') and regexp_matches(t, '^[A-Za-z0-9_]+$')"
    return f"""with {q.PAIRS}, src as (select journal as a, r_journal as b from pairs), {paired('p_', 'src')},
m0 as materialized (select row_number() over (order by a, b) as id, a, b, {words('a')} as u, {words('b')} as v from (select distinct a, b from src where a is not null and b is not null)),
mu as (select id, unnest(range(1, len(u) + 1)) as i, unnest(u) as s from m0), mv as (select id, unnest(range(1, len(v) + 1)) as j, unnest(v) as t from m0),
mw as materialized (select distinct s, t from mu join mv using (id)), me as materialized (select s, t from mw where starts_with(s, t) or starts_with(t, s) or (not ({plain}) and {q.LCS.format(a='s', b='t')} > 0.8 * least(length(s), length(t)))),
mm as (select mu.id, list(i * 1000 + j) as m from mu join mv on mu.id = mv.id join me on me.s = mu.s and me.t = mv.t group by mu.id),
mp as materialized (select a, b, case when len(u) = 0 or len(v) = 0 then 0 else list_reduce(list_transform(range(1, len(u) + 1), lambda i: [i]), lambda row, i: list_reduce(range(1, len(row)), lambda acc, j: acc || [case when list_contains(m, i[1] * 1000 + j) then row[j] + 1 else greatest(row[j + 1], acc[len(acc)]) end], [0]::bigint[]), list_transform(range(0, len(v) + 1), lambda z: 0::bigint))[len(v) + 1] / least(len(u), len(v)) end as prefix_words from (select m0.*, coalesce(m, []) as m from m0 left join mm using (id))),
z as materialized (select a, b, {LONGER} as lcs, {SHORTER} as relaxed, {lev} as lev, {threes} as threes from p_n)
select left_id, right_id, round(coalesce(lcs, 0), 6) as token_lcs, round(coalesce(relaxed, 0), 6) as relaxed, round(coalesce(lev, 0), 6) as token_lev, round(coalesce(threes, 0), 6) as token_jaccard, round(coalesce(prefix_words, 0), 6) as prefix_words, coalesce(lcs, 0) >= 0.9 as close
from pairs left join z on z.a = journal and z.b = r_journal left join mp on mp.a = journal and mp.b = r_journal"""


def author_pairs() -> str:
    return f"""with {q.PAIRS}, n as (select left_id, right_id, list_filter(string_split(author, ' and '), lambda x: x <> '') as l, list_filter(string_split(r_author, ', '), lambda x: x <> '') as r from pairs),
src as (select unnest(l) as a, r from n), both_ as (select distinct a, unnest(r) as b from src), {paired('p_', 'both_')}, s as (select a, b from p_n where {LONGER} >= 1 - 0.4),
lu as (select left_id, unnest(l) as a, r from n), u as (select left_id, a, unnest(range(1, len(r) + 1)) as j, unnest(r) as b from lu),
m as (select u.left_id, count(distinct j) as met from u join s on s.a = u.a and s.b = u.b group by u.left_id)
select n.left_id, right_id, len(l)::bigint as n_left, len(r)::bigint as n_right, coalesce(least(len(l), len(r)) > 0 and coalesce(met, 0) / greatest(least(len(l), len(r)), 1) > 0.8, false) as same from n left join m using (left_id)"""


TABLE = "list_reduce(list_transform({a}, lambda c: [[c]]), lambda tab, c: tab || [list_reduce(range(1, len(tab[len(tab)])), lambda acc, j: acc || [case when ({b})[j] = c[1][1] then (tab[len(tab)][j]::bigint + 1)::varchar else greatest(tab[len(tab)][j + 1]::bigint, acc[len(acc)]::bigint)::varchar end], ['0']::varchar[])], [list_transform(range(0, len({b}) + 1), lambda z: '0')]::varchar[][])"


def back(source: str) -> str:
    """CTE ``walk`` (id, i, j, places): from ``source`` (id, a, b as lists) the places in b of
    one longest common subsequence; going back through the table, up only if that is longer."""
    return f"""tab as materialized (select id, a, b, {TABLE.format(a='a', b='b')} as t from {source}),
walk as (select id, len(a) as i, len(b) as j, []::bigint[] as places from tab union all
 select w.id, case when a[i] = b[j] or t[i][j + 1]::bigint > t[i + 1][j]::bigint then i - 1 else i end, case when a[i] = b[j] or not t[i][j + 1]::bigint > t[i + 1][j]::bigint then j - 1 else j end, case when a[i] = b[j] then [j] || places else places end
 from walk w join tab using (id) where i > 0 and j > 0)"""


def org_pairs() -> str:
    pairs = q.PAIRS.replace("i.author,", "i.author, i.affiliation, s.affiliations,")
    return f"""with recursive {pairs}, o as (select left_id, right_id, affiliation, unnest(string_split(affiliations, '; ')) as other from pairs),
src as (select affiliation as a, other as b from o), {paired('p_', 'src')}, z as materialized (select row_number() over (order by a, b) as id, a as na, b as nb, x, y, {ORG} as score from p_n),
sized as (select id, case when len(x) < len(y) then x else y end as a, case when len(x) < len(y) then y else x end as b from z where score > 0 and na <> nb), {back('sized')},
spread as (select id, stddev_pop(list_position(b, b[p])) as spread from (select walk.id, b, unnest(places) as p from walk join tab using (id) where i = 0 or j = 0) group by id)
select left_id, right_id, other, round(coalesce(score, 0), 6) as score, round(case when affiliation = other then 1 else coalesce(spread, 0) end, 6) as spread from o left join z on na = affiliation and nb = other left join spread using (id)"""


def subsequence_pairs() -> str:
    return f"""with recursive {q.PAIRS}, src as (select left_id as id, case when title = '' then [] else string_split(title, '') end as a, case when r_title = '' then [] else string_split(r_title, '') end as b from pairs where title is not null and r_title is not null), {back('src')},
done as (select walk.id, array_to_string(list_transform(places, lambda p: b[p]), '') as common from walk join tab using (id) where i = 0 or j = 0)
select left_id, right_id, common from pairs left join done on done.id = left_id"""


def find_pairs() -> str:
    """A cell of the edit table is a million times its cost plus the begin of its best match."""
    cell = "least(row[i + 1] + case when p[i] = t[j[1]] then 0 else 1000000 end, row[i + 2] + 1000000, acc[len(acc)] + 1000000)"
    inner = f"list_reduce(range(1, len(p) + 1), lambda acc, i: acc || [{cell}], [j[1]]::bigint[])"
    whole = f"list_reduce(list_transform(range(1, len(t) + 1), lambda j: [j]), lambda row, j: list_transform([{inner}], lambda new: [least(row[1], new[len(new)])] || new)[1], [1000000000000000]::bigint[] || list_transform(range(0, len(p) + 1), lambda z: z * 1000000))[1]"
    return f"""with {q.PAIRS}, s as (select left_id, right_id, lower(r_title) as text, lower(title) as pattern, case when text = '' then [] else string_split(text, '') end as t, case when pattern = '' then [] else string_split(pattern, '') end as p, floor(0.3 * length(pattern))::bigint as most from pairs),
f as (select *, instr(text, pattern) as exact, case when text is null or pattern is null or instr(text, pattern) > 0 or most = 0 then null else {whole} end as best from s)
select left_id, right_id, (case when exact > 0 then exact - 1 when best // 1000000 <= most then best % 1000000 else -1 end)::int as place, round(case when exact > 0 then 1 when best // 1000000 <= most then 1 - (best // 1000000) / length(pattern) else 0 end, 6) as similarity from f"""


def greedy(order: str, edges: str) -> str:
    """CTE ``led`` (k, leader): nodes 1, 2, ... join the best earlier one that was made, else are made.

    ``edges`` has (k, o, pref) with pref as an order clause over its columns."""
    return f"""c as materialized (select k, list(o order by {order}) as o from {edges} group by k),
g as (select 0::bigint as k, []::bigint[] as made, null::bigint as leader union all
 select k + 1, case when l is null then made || [k + 1] else made end, coalesce(l, k + 1) from (select g.k, g.made, list_filter(coalesce(c.o, []), lambda x: list_contains(g.made, x))[1] as l from g left join c on c.k = g.k + 1 where g.k < (select max(k) from nodes))),
led as (select k, leader from g where k > 0)"""


def journal_nodes(records: str) -> str:
    """CTEs from ``records`` (position, name, issn) to ``led``."""
    return f"""nodes as materialized (select row_number() over (order by position) as k, name, issn, position from (select name, issn, min(position) as position from {records} where trim(name) <> '' group by name, issn)),
names as (select n.name as a, m.name as b from nodes n join nodes m on m.k < n.k), {paired('p_', 'names', NEAR)}, alike as materialized (select a, b, {LONGER} as score from p_n where {LONGER} > 0.9),
e as (select n.k, m.k as o, 0 as rank, 1.0::double as score from nodes n join nodes m on upper(n.issn) = upper(m.issn) and m.k < n.k union all
 select n.k, m.k, 1, score from alike join nodes n on n.name = a join nodes m on m.name = b and m.k < n.k), {greedy('rank, score desc, o', 'e')}"""


UNIFIED = f"select row_number() over (order by is_isi, id) as position, name, issn from (select id, false as is_isi, source_title as name, {q.issn('issn')} as issn from scopus union all select id, true, journal, {q.issn('issn')} from isi)"


def journal_entities() -> str:
    return f"""with recursive {q.ISI}, {q.SCOPUS}, records as ({UNIFIED}), {journal_nodes('records')}
select n.name, n.issn, l.name as leader_name, l.issn as leader_issn, n.k = l.k as created from nodes n join led using (k) join nodes l on l.k = led.leader"""


def organisation_nodes(records: str) -> str:
    """CTEs from ``records`` (position, name) to ``led``."""
    return f"""nodes as materialized (select row_number() over (order by position, name) as k, name from (select name, min(position) as position from {records} where trim(name) <> '' group by name)),
names as (select n.name as a, m.name as b from nodes n join nodes m on m.k < n.k), {paired('p_', 'names')}, alike as materialized (select a, b, {ORG} as score from p_n where {ORG} >= 0.95),
e as (select n.k, m.k as o, score from alike join nodes n on n.name = a join nodes m on m.name = b and m.k < n.k), {greedy('score desc, o desc', 'e')}"""


def organisation_entities() -> str:
    return f"""with recursive records as (select id as position, name from organizes), {organisation_nodes('records')}
select n.name, l.name as leader_name, n.k = l.k as created from nodes n join led using (k) join nodes l on l.k = led.leader"""


def merged_journals() -> str:
    merged = q.MERGED.replace("document_type as type from scopus", f"document_type as type, source_title as journal, {q.issn('issn')} as issn from scopus").replace("title, year, type from isi", f"title, year, type, journal, {q.issn('issn')} from isi").replace("year, type, l from both_", "year, type, l, journal, issn from both_")
    return f"""with recursive {merged}, records as (select id as position, journal as name, issn, (src = 0)::int as is_scopus, (src = 1 or l is not null)::int as is_isi from merged), {journal_nodes('records')},
made as (select k, name, issn, 1 + row_number() over (order by k) as id from nodes join led using (k) where leader = k),
flags as (select coalesce(made.id, 1) as id, max(is_scopus) as is_scopus, max(is_isi) as is_isi from records r left join nodes n on n.name = r.name and n.issn is not distinct from r.issn left join led on led.k = n.k left join made on made.k = led.leader group by 1),
full_ as (select 1 as id, 'Uncategorized' as name, null::varchar as issn union all select id, name, issn from made)
select id, name, issn, coalesce(is_scopus, 0) as is_scopus, coalesce(is_isi, 0) as is_isi, 0 as is_vci, 1 as is_international from full_ left join flags using (id)"""


def merged_people() -> str:
    docs = "docs as (select a.id, authors_json from articles a join isi i on i.id = a.raw_isi_id union all select a.id, authors_json from articles a join scopus s on s.id = a.raw_scopus_id)"
    return f"""with recursive {q.ISI}, {q.SCOPUS}, {docs}, {q.json_rows('docs')}, people as (select id, p, label as name from label_rows where q = 0 and label is not null),
held as (select distinct id, p, label as name from label_rows where q > 0 and u = 0 and label is not null), records as (select id as position, name from held), {organisation_nodes('records')},
lead as (select n.name, l.name as leader from nodes n join led using (k) join nodes l on l.k = led.leader), of_ as (select distinct held.id, p, coalesce(leader, 'Uncategorized') as organisation from held left join lead using (name))
select people.id as article_id, people.name, organisation from people left join of_ on of_.id = people.id and of_.p = people.p"""


def matches(identifiers: bool = False) -> str:
    """CTEs that end in ``found``: all matches with the rank of their candidate."""
    top = q.top_k()
    top = top[: top.rindex("select left_id")]
    side = lambda left: q.common(left)
    title = f"lower({q.fold('x.title')})", f"lower({q.fold('y.title')})"
    dois = "(starts_with(x.doi, '10.') and starts_with(y.doi, '10.'))"
    verdict = f"case when {dois} and x.doi = y.doi then true when {dois} or upper(x.issn) <> upper(y.issn) then false end" if identifiers else "null::boolean"
    return f"""{top}, lc as materialized ({side(True)}), rc as materialized ({side(False)}),
near0 as (select left_id, right_id, rank, x.title as left_title, x.journal as aj, x.journal_iso as ai, y.journal as bj, y.journal_iso as bi, x.title = y.title as equal, {title[0]} as a, {title[1]} as b, {verdict} as verdict, {q.year('x.year')} as ya, {q.year('y.year')} as yb
 from k join lc x on x.original_id = left_id join rc y on y.original_id = right_id where rank <= 10),
near as materialized (select *, least(length(a), length(b)) / greatest(length(a), length(b), 1) as bound from near0 where (ya is null or yb is null or ya = yb) and coalesce(verdict, true)),
titles as materialized (select a, b, case when length(a) = 0 or length(b) = 0 then 0 when a = b then 1 else {q.LCS.format(a='a', b='b')} / greatest(length(a), length(b)) end as score from (select distinct a, b from near where a is not null and b is not null and (bound >= 0.7 or verdict))),
titled as materialized (select near.*, case when equal then 1 else coalesce(t.score, 0) end as ts from near left join titles t on t.a = near.a and t.b = near.b where verdict or case when equal then 1 else coalesce(t.score, 0) end >= 0.7),
src as (select aj as a, bj as b from titled union select ai, bi from titled), {paired('p_', 'src')}, js as materialized (select a, b, {LONGER} as score from p_n),
judged as (select titled.*, coalesce(f.score, 0) as full_, coalesce(s.score, 0) as short from titled left join js f on f.a = aj and f.b = bj left join js s on s.a = ai and s.b = bi),
scored as (select *, case when full_ >= 0.8 then full_ when short >= 0.8 then short else greatest(full_, short) end as j from judged),
found as materialized (select left_id, right_id, rank, round(ts, 6) as title_score, round(j, 6) as journal_score, case when verdict then 'DUPLICATED' when ts = 1 and length(left_title) > 20 then 'DUPLICATED' when ts >= 0.8 then case when j >= 0.85 then 'DUPLICATED' else 'POSSIBLY' end else 'POSSIBLY' end as match_type from scored),
cut as (select left_id, min(rank) as first from found where match_type = 'DUPLICATED' group by left_id),
logged as (select found.* from found left join cut using (left_id) where first is null or rank <= first)"""


def slugs(t: str, text: str) -> str:
    suffixed = "substr(base, 1, 255 - length('-' || n)) || '-' || n"
    return f"""with recursive r as materialized (select id, slug as given, {q.slug(text)} as base, coalesce(slug in ('', 'add-slug-here'), true) as open from {t}),
todo as materialized (select row_number() over (order by id) as k, id, base from r where open),
s as (select 0::bigint as k, coalesce((select list(given) from r where not open), [])::varchar[] as taken, ''::varchar as slug union all
 select k + 1, taken || [new], new from (select s.k, taken, case when not list_contains(taken, base) then base else list_filter(list_transform(range(1, len(list_filter(taken, lambda x: starts_with(x, substr(base, 1, 200)))) + 2), lambda n: {suffixed}), lambda x: not list_contains(taken, x))[1] end as new from s join todo on todo.k = s.k + 1))
select id, given as slug from r where not open union all select id, slug from s join todo using (k)"""


def best_journal() -> str:
    lev = "case when greatest(length(a), length(b)) = 0 then 0 else 1 - levenshtein(a, b) / greatest(length(a), length(b)) end"
    return f"""with t as (select distinct journal, {q.fold('journal')} as a from isi_documents where trim(journal) <> ''), k as (select id, {q.fold('name')} as b from journals where trim(name) <> ''),
p as (select journal, id, round({lev}, 6) as score from t, k) select journal, id as journal_id, score from p qualify row_number() over (partition by journal order by score desc, id) = 1"""


def linked_people() -> str:
    return f"""with {q.PAIRS}, docs as (select id, authors_json from isi where id in (select left_id from pairs)), {q.json_rows('docs')}, people as (select id, p, label as name from label_rows where q = 0 and label is not null),
held as (select distinct id, p, label as organisation from label_rows where q > 0 and u = 0 and label is not null)
select people.id as isi_id, people.name, organisation from people left join held on held.id = people.id and held.p = people.p"""


def journal_pairs() -> str:
    pairs = q.PAIRS.replace("i.author,", "i.author, i.journal_iso as iso, s.abbreviated_source_title as r_iso,")
    return f"""with {pairs}, src as (select journal as a, r_journal as b from pairs union select iso, r_iso from pairs), {paired('p_', 'src')}, z as materialized (select a, b, {LONGER} as score from p_n),
j as (select left_id, right_id, coalesce(f.score, 0) as full_, coalesce(s.score, 0) as short from pairs left join z f on f.a = journal and f.b = r_journal left join z s on s.a = iso and s.b = r_iso)
select left_id, right_id, round(case when full_ >= 0.8 then full_ when short >= 0.8 then short else greatest(full_, short) end, 6) as journal_score from j"""


def person_pairs() -> str:
    return f"""with {q.PAIRS}, n as (select left_id, right_id, list_filter(string_split(author, ' and '), lambda x: x <> '')[1] as a, list_filter(string_split(r_author, ', '), lambda x: x <> '')[1] as b from pairs),
{paired('p_', 'n')}, z as (select a, b, {LONGER} as score from p_n) select left_id, right_id, coalesce(score >= 1 - 0.4, false) as same from n left join z using (a, b)"""


def linkage() -> dict[str, str]:
    log = "select left_id as isi_id, case when match_type = 'DUPLICATED' then m.id end as duplication_of, case when match_type <> 'DUPLICATED' then m.id end as possible_duplication_of, title_score::float as title_score, journal_score::float as journal_score, match_type = 'DUPLICATED' as is_merged from logged join (select row_number() over (order by id) as id, id as rid from scopus) m on m.rid = right_id"
    outcome = "select isi.id as left_id, linked_to, coalesce(n_logged, 0) as n_logged from isi left join (select left_id, arg_min(right_id, rank) filter (match_type = 'DUPLICATED') as linked_to, count(*) as n_logged from logged group by left_id) g on g.left_id = isi.id"
    rows = "select left_id, right_id, rank, title_score, journal_score, match_type from logged"
    return {
        "journal_pairs": journal_pairs(), "person_pairs": person_pairs(), "linked_people": linked_people(),
        "token_pairs": token_pairs(), "org_pairs": org_pairs(), "subsequence_pairs": subsequence_pairs(), "find_pairs": find_pairs(), "author_pairs": author_pairs(), "best_journal": best_journal(),
        "link_matches": f"{matches()} {rows}", "link_outcome": f"{matches()} {outcome}", "merge_log": f"{matches()} {log}", "link_matches_strict": f"{matches(True)} {rows}",
        "journal_entities": journal_entities(), "organisation_entities": organisation_entities(), "merged_journals": merged_journals(), "merged_people": merged_people(),
        "article_slugs": slugs("articles", "title"), "journal_slugs": slugs("journals", "name"), "organize_slugs": slugs("organizes", "name"),
    }
