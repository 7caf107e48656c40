"""SQL for DuckDB that gives the rows of the queries SQL can express."""

from __future__ import annotations

#: Links as in the query: isi 0, article 1, scopus 2, each in a number space of its own.
EDGES = """i as (select distinct id, trim(raw_scopus_id) r from isi_documents where id is not null),
e0 as (select id as u, (2::bigint << 60) + r::bigint as v from i where regexp_matches(r, '^[+-]?[0-9]{1,18}$')
 union select isi_id, (1::bigint << 60) + duplication_of from merge_logs where isi_id is not null and duplication_of is not null
 union select (2::bigint << 60) + raw_scopus_id, (1::bigint << 60) + id from articles where raw_scopus_id is not null
 union select raw_isi_id, (1::bigint << 60) + id from articles where raw_isi_id is not null),
e as (select u, v from e0 union select v, u from e0)"""

COMPONENTS = f"""with recursive {EDGES}, reach(n, m) as (select u, u from e union select v, m from reach join e on u = n),
top as (select n, min(m) as c from reach group by n), isi as (select n, c from top where n < (1::bigint << 60)),
big as (select c from isi group by c having count(*) > 1) select n as isi_id, c as group_id from isi where c in (select c from big)"""

SPANS = """with d as (select doc_id, text from documents where length(text) >= 300),
w as (select distinct doc_id, md5(substr(text, k, 300)) as h from (select doc_id, text, unnest(range(1, length(text) - 298)) as k from d))
select distinct a.doc_id as doc_a, b.doc_id as doc_b from w a join w b on a.h = b.h and a.doc_id < b.doc_id"""


COVERAGE = """with d as (select doc_id, text from documents where length(text) >= 300),
w as (select doc_id, k, md5(substr(text, k, 300)) as h from (select doc_id, text, unnest(range(1, length(text) - 298)) as k from d)),
s as (select h from w group by h having count(distinct doc_id) > 1),
c as (select doc_id, sum(least(300, coalesce(nk - k, 300)))::bigint as n from (select doc_id, k, lead(k) over (partition by doc_id order by k) as nk from w where h in (select h from s)) group by doc_id),
r as (select text, min(doc_id) as rep from documents where text is not null group by text)
select d.doc_id, coalesce(rep, d.doc_id) as rep, coalesce(length(d.text), 0)::bigint as n_chars, coalesce(n, 0)::bigint as shared_chars, case when length(d.text) > 0 then round(coalesce(n, 0) / length(d.text), 6) else 0 end as shared_part
from documents d left join r on r.text = d.text left join c on c.doc_id = d.doc_id"""


def best_records(votes: bool = False) -> str:
    """The record whose value survives, for each DOI and field."""
    from catalink.llm.survivors import PLACEHOLDERS

    none = ", ".join(f"'{p}'" for p in PLACEHOLDERS)
    plain = lambda x: rf"regexp_replace(regexp_replace(regexp_replace(lower({x}), '<[^<>]{{1,40}}>', '', 'g'), '&[a-z]{{2,8}};', ' ', 'g'), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    bare = lambda x: rf"regexp_replace(regexp_extract(lower({x}), '(10\.\d{{4,9}}/[^\s\"<>]+)', 1), '[.,;:]+$', '')"
    words = lambda x: rf"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}]+', ' ', 'g'), ' '), lambda z: length(z) >= 4)"
    once = lambda x: f"list_filter({x}, lambda z, i: list_position({x}, z) = i)"
    unlike = lambda m: f"2 * len(list_intersect(x.{m}, y.{m})) < least(len(x.{m}), len(y.{m}))"
    order = "size > 0 desc, votes desc, size desc" if votes else "size desc, votes desc"
    trust = "trust" if votes else "1.0"
    picked = f"""select doi, field_name, id as isi_id from v join k using (doi, field_name) where size > 0 qualify row_number() over (partition by doi, field_name order by {order}, crawled_at desc, id) = 1"""
    out = f"picked as ({picked}) select doi, max(isi_id) filter (field_name = 'abstract') as abstract, max(isi_id) filter (field_name = 'keyword') as keyword, max(isi_id) filter (field_name = 'funding_text') as funding_text from picked group by doi" if votes else picked
    return rf"""with i as (select * from isi_documents where id is not null qualify row_number() over (partition by id order by crawled_at desc) = 1),
rated as (select publisher, round((count(*) filter ({bare('doi')} <> '') + 1) / (count(*) + 2), 6) as trust from isi_documents group by publisher),
about as (select id, {words('title')} as t0, {words('author')} as a0 from i), known as (select id, {once('t0')} as t, {once('a0')} as a from about where len(t0) > 0),
prose as (select id, crawled_at, publisher, 'abstract' as field_name, {plain("coalesce(abstract, '')")} as c from i union all select id, crawled_at, publisher, 'funding_text', {plain("coalesce(funding_text, '')")} from i),
ends as (select field_name, c, min({{'place': array_to_string(t, ' '), 't': t, 'a': a}}) as x, max({{'place': array_to_string(t, ' '), 't': t, 'a': a}}) as y from prose join known using (id) where not c in ({none}) group by field_name, c),
notices as (select field_name, c, true as notice from ends where {unlike('t')} and {unlike('a')}),
kw as (select id, crawled_at, publisher, list_sort(list_distinct(list_filter(list_transform({{values}}, lambda x: {plain('x')}), lambda x: not x in ({none})))) as v from i),
rows_ as (select id, crawled_at, publisher, field_name, case when c in ({none}) or notice then '' else c end as c, length(c) as size from prose left join notices using (field_name, c)
 union all select id, crawled_at, publisher, 'keyword', array_to_string(v, '|'), len(v) * 1000000000 + length(array_to_string(v, '|')) from kw),
g0 as (select distinct {bare('doi')} as doi, raw_isi_id as id from articles where raw_isi_id is not null),
g as (select * from g0 where doi <> '' and doi in (select doi from g0 group by doi having count(*) > 1)),
x as (select doi, field_name, id, c, case when c = '' then 0 else size end as size, crawled_at, trust from g join rows_ using (id) join rated on rated.publisher is not distinct from rows_.publisher),
v as (select *, round(sum({trust} * pow(2.0, epoch(crawled_at) // 1 / (86400.0 * 730.0) - 20.0)) over (partition by doi, field_name, c), 6) as votes from x),
k as (select doi, field_name from x group by 1, 2 having count(distinct c) > 1){', ' if votes else ' '}{out}"""


def canonical_names() -> str:
    """The entry of every typed name: equal, abbreviated, or near by plain edit distance to every entry."""
    from catalink.llm.canonical_names import LEFT_OUT

    accents = "àáâãäåāăạảấầẩẫậắằẳẵặèéêëēẹẻẽếềểễệìíîïĩỉịòóôõöøōọỏốồổỗộớờởỡợơùúûüũūụủứừửữựưýỳỹỷỵñçđ", "aaaaaaaaaaaaaaaaaaaaeeeeeeeeeeeeeiiiiiiiooooooooooooooooooouuuuuuuuuuuuuuyyyyyncd"
    words = lambda x: rf"list_filter(string_split(trim(regexp_replace(regexp_replace(translate(replace(lower({x}), '&amp;', '&'), '{accents[0]}', '{accents[1]}'), '\((?:online|print|electronic|cd-rom|e-journal|paper)\)', ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda z: z <> '' and not z in ({', '.join(repr(w) for w in LEFT_OUT)}))"
    letters = lambda z: f"list_sort(string_split({z}, ''))"
    filler = "(length(z) <= 4 and (" + " or ".join(f"levenshtein(z, '{f}') <= 1 or {letters('z')} = {letters(repr(f))}" for f in ("and", "for", "in", "of", "on", "the")) + "))"
    stem = lambda z: f"case when {z} in ('journal', 'j', 'jour', 'jnl') then 'j' else substr({z}, 1, 4) end"
    most = "case when t[1] = x[1] then floor(length(x) * 0.45) else least(2, greatest(1, floor(length(x) / 2))) end"
    minus = lambda a, b: f"list_filter({a}, lambda z, i: not list_contains({b}, z) and list_position({a}, z) = i)"
    return f"""with typed as (select distinct 'isi_documents' as table_name, id as record_id, journal as name from isi_documents where trim(journal) <> '' union select 'journals', id, name from journals where trim(name) <> ''),
names as (select distinct name from typed), f0 as (select name, 0 as tail, name as r from names union all select name, 1, regexp_replace(name, ',[^,]*$', '') from names where regexp_replace(name, ',[^,]*$', '') <> name),
f1 as (select name, tail, {words('r')} as w from f0), f2 as (select * from f1 union all select name, tail + 2, list_filter(w, lambda z: not {filler}) from f1),
forms as materialized (select name, tail, w, array_to_string(w, ' ') as plain from f2 where len(w) > 0),
entries as materialized (select *, array_to_string(rw, ' ') as rplain from (select ref_id, {words('canonical_name')} as rw from journal_reference) where len(rw) > 0), known as (select distinct unnest(rw) as term from entries),
equal_ as materialized (select name, tail, ref_id, 0 as edits from forms join entries on plain = rplain),
open_ as materialized (select * from forms where name not in (select name from equal_)),
short_ as materialized (select name, tail, ref_id, 0 as edits from open_ join entries on len(w) = len(rw) where len(list_filter(range(1, len(w) + 1), lambda i: {stem('w[i]')} = {stem('rw[i]')} and (starts_with(rw[i], w[i]) or (w[i] = 'j' and rw[i] = 'journal')))) = len(w)),
n0 as materialized (select name, tail, ref_id, levenshtein(plain, rplain) as edits, {minus('w', 'rw')} as tw, {minus('rw', 'w')} as xw from open_ join entries on abs(length(plain) - length(rplain)) <= 4 where name not in (select name from short_) and levenshtein(plain, rplain) <= 4),
p as (select *, unnest(tw) as t, unnest(xw) as x from n0 where len(tw) = len(xw)), bad as (select distinct name, tail, ref_id from p where levenshtein(t, x) > {most}),
wrong as (select distinct name, tail, ref_id from (select name, tail, ref_id, unnest(tw) as term from n0) join known using (term)),
near as (select name, tail, ref_id, edits from n0 where (name, tail, ref_id) not in (select (name, tail, ref_id) from bad) and (len(tw) = len(xw) or levenshtein(array_to_string(tw, ''), array_to_string(xw, '')) <= 2) and (name, tail, ref_id) not in (select (name, tail, ref_id) from wrong)),
best as (select name, ref_id from (select * from equal_ union all select * from short_ union all select * from near) qualify row_number() over (partition by name order by edits, tail, ref_id) = 1)
select table_name, record_id, coalesce(ref_id, 0)::bigint as ref_id from typed left join best using (name)"""


def leaks(kind: bool = False) -> str:
    """Chains of equal words, a word longer in every round: the fewest skipped up to each end."""
    cut = lambda x: rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"
    label = ", case when bool_or(k = 15 and s = 0) then 'phrase' else 'near' end as kind" if kind else ""
    return f"""with recursive d0 as (select doc_id, {cut('text')} as w from documents where text is not null), i0 as (select item_id, {cut('item_text')} as w from eval_items where item_text is not null),
d as materialized (select doc_id, unnest(range(1, len(w) + 1)) as j, unnest(w) as t from d0), i as materialized (select item_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as t from i0 where len(w) >= 15),
m0 as materialized (select doc_id, item_id, i, j from d join i using (t)), likely as (select doc_id, item_id from m0 group by all having count(distinct i) >= 15 and count(distinct j) >= 15),
m as materialized (select m0.* from m0 join likely using (doc_id, item_id)),
r as (select doc_id, item_id, i, j, 1 as k, 0 as s from m union all
 select m.doc_id, m.item_id, m.i, m.j, r.k + 1, min(r.s + greatest(m.i - r.i, m.j - r.j) - 1) from r join m on m.doc_id = r.doc_id and m.item_id = r.item_id and m.i between r.i + 1 and r.i + 3 and m.j between r.j + 1 and r.j + 3
 where r.k < 29 and r.s <= 7 group by all)
select doc_id, item_id{label} from r where k >= 15 and s <= 0.25 * k group by doc_id, item_id"""


KEYWORDS = r"""flatten(list_transform(string_split(array_to_string(list_transform(string_split(keyword, '"'), lambda s, i: case when len(string_split(keyword, '"')) % 2 = 1 and i % 2 = 0 then s else regexp_replace(s, ';|；|\n|\||·|\s/\s', chr(1), 'g') end), '"'), chr(1)),
 lambda y: string_split(array_to_string(list_transform(string_split(y, '"'), lambda s, i: case when len(string_split(y, '"')) % 2 = 1 and i % 2 = 0 then s else regexp_replace(s, ',\s+', chr(1), 'g') end), '"'), chr(1))))"""


def oracle_sql() -> dict[str, str]:
    values = f"coalesce({KEYWORDS}, [])"
    return {
        "p2_found": canonical_names(), "p3_found": best_records().replace("{values}", values), "p3_votes": best_records(True).replace("{values}", values),
        "p4_found": COMPONENTS, "p8_found": leaks(), "p8_matches": leaks(True), "p10_found": SPANS, "p10_coverage": COVERAGE,
    }
