"""SQL for DuckDB that gives the rows of the queries."""

from __future__ import annotations

from catalink.functions.text import STOP_WORDS, VIETNAMESE, VIETNAMESE_PLAIN

ISI = "isi as (select * from isi_documents where id is not null qualify row_number() over (partition by id order by crawled_at desc) = 1)"
SCOPUS = "scopus as (select * from scopus_documents where id is not null qualify row_number() over (partition by id order by crawled_at desc) = 1)"


def trim(x: str) -> str:
    return rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def clean(x: str) -> str:
    return rf"lower(regexp_replace({trim(x)}, '\s+', ' ', 'g'))"


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


def issn(x: str) -> str:
    t = trim(f"replace({x}, 'x', 'X')")
    return f"case when length({x}) < 8 then null when length({t}) = 8 then substr({t}, 1, 4) || '-' || substr({t}, 5, 4) when length({t}) = 9 then {t} end"


def country(x: str) -> str:
    for s in ("Viet nam", "Việt nam", "Viet Nam", "Việt Nam"):
        x = f"replace({x}, '{s}', 'Vietnam')"
    return x


def year(x: str) -> str:
    return f"case when regexp_matches({x}, '^[+-]?[0-9]{{1,9}}$') and {x}::int >= 1600 then {x}::int end"


def kind(x: str) -> str:
    return f"case when {x} is null then 'journal' when contains(lower({x}), 'proceeding') or contains(lower({x}), 'conference') then 'conference' when contains(lower({x}), 'article') then 'journal' else 'other' end"


def words(x: str, stop: bool) -> str:
    parts = rf"regexp_split_to_array(lower({fold(x)}), '[^a-z0-9_'']+')"
    out = f" and not list_contains([{', '.join(repr(w) for w in STOP_WORDS)}], x)" if stop else ""
    return f"list_filter({parts}, lambda x: x <> ''{out})"


def slug(x: str) -> str:
    return f"substr(regexp_replace(regexp_replace(lower({fold(f'''coalesce({x}, '')''')}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 255)"


def json_rows(source: str) -> str:
    """CTEs that end in ``label_rows`` (id, p, q, u, label) of authors_json."""
    member = lambda m: f"case when json_type(x, '$.{m}') <> 'NULL' then json_extract(x, '$.{m}') end"
    orgs = ", ".join(member(m) for m in ("organize", "organizes", "organization", "organizations"))
    label = lambda v: f"case when json_type({v}) = 'VARCHAR' then json_extract_string({v}, '$') else json_extract_string({v}, '$.name') end"
    return f"""
v as (select id, authors_json::json j from {source} where json_valid(authors_json)),
s as (select id, case when json_type(j) = 'VARCHAR' then try_cast(json_extract_string(j, '$') as json) else j end j from v),
l as (select id, case when json_type(j) = 'ARRAY' then j else coalesce(json_extract(j, '$.authors'), json_extract(j, '$.data.authors')) end a from s),
au as (select id, unnest(range(1, json_array_length(a)::bigint + 1)) p, a from l where a is not null),
ax as (select id, p, json_extract(a, '$[' || (p - 1) || ']') x from au),
o as (select id, p, coalesce({orgs}) g from ax),
ol as (select id, p, case when json_type(g) = 'ARRAY' then g else json_array(g) end g from o where g is not null),
ox as (select id, p, q, json_extract(g, '$[' || (q - 1) || ']') y from (select id, p, g, unnest(range(1, json_array_length(g)::bigint + 1)) q from ol)),
ux as (select id, p, q, u, json_extract(y, '$.units[' || (u - 1) || ']') z from (select id, p, q, y, unnest(range(1, json_array_length(y, '$.units')::bigint + 1)) u from ox where json_type(y) = 'OBJECT')),
label_rows as (
select id, p, 0 q, 0 u, coalesce(nullif(json_extract_string(x, '$.fullName'), ''), trim(json_extract_string(x, '$.first_name')) || ' ' || trim(json_extract_string(x, '$.last_name'))) label from ax
union all select id, p, q, 0, {label('y')} from ox
union all select id, p, q, u, {label('z')} from ux)"""


def nested() -> str:
    return f"with {ISI}, {json_rows('isi')} select id as isi_id, p::int as author_pos, q::int as org_pos, u::int as unit_pos, label from label_rows where label is not null"


def packed() -> str:
    """The values of the packed fields."""

    def cut(x: str, pattern: str) -> str:
        mark = f"regexp_replace(s, '{pattern}', chr(1), 'g')"
        return f"string_split(array_to_string(list_transform(string_split({x}, '\"'), lambda s, i: case when len(string_split({x}, '\"')) % 2 = 1 and i % 2 = 0 then s else {mark} end), '\"'), chr(1))"

    edge = lambda x: rf"regexp_replace({x}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"
    bare = edge(rf"regexp_replace({edge('v')}, '^(?:\[\d{{1,4}}\]|\(\d{{1,4}}\)|\d{{1,4}}[.)](?:\s))\s*', '')")
    fields = {
        "author": f"""flatten(list_transform({cut('t', r';|\n|\||\s&\s|\s(?i:and)\s')}, lambda y: case when regexp_matches(y, '^\\s*[^\\s,"]+,[^,"]*$') then [y] else {cut('y', r',\s+')} end))""",
        "keyword": f"flatten(list_transform({cut('t', r';|；|\n|\||·|\s/\s')}, lambda y: {cut('y', r',\s+')}))",
        # no look-ahead here: a numbered value is marked before its number
        "cited_references": cut("t", r";|\n|\s\|\s|\[\d{1,4}\]\s"),
    }
    arms = " union all ".join(f"select id, '{f}' as field_name, {f} as t, {items.replace('t,', 't,')} as items from (select id, {f}, {f} as t from isi where trim({f}) <> '')" for f, items in fields.items())
    unquoted = """case when length(w) >= 2 and starts_with(w, '"') and ends_with(w, '"') and not contains(replace(substr(w, 2, length(w) - 2), '""', ''), '"') then replace(substr(w, 2, length(w) - 2), '""', '"') else w end"""
    return f"""with {ISI}, a as ({arms}),
b as (select id, field_name, unnest(items) as v, unnest(range(1, len(items) + 1)) as k from a),
c as (select id, field_name, k, {bare} as w from b),
d as (select id, field_name, k, {edge(unquoted)} as item_value from c)
select id as isi_id, field_name, row_number() over (partition by id, field_name order by k)::int as pos, item_value from d where item_value <> ''"""


PAIRS = f"""{ISI}, {SCOPUS}, pairs as (select i.id as left_id, s.id as right_id, i.title, s.title as r_title, i.journal, s.source_title as r_journal, i.author, s.authors as r_author from isi i
 join scopus s on s.id = case when regexp_matches(trim(i.raw_scopus_id), '^[0-9]{{1,18}}$') then trim(i.raw_scopus_id)::bigint end)"""


def common(left: bool) -> str:
    """One catalogue on the common schema."""
    from catalink.sources.catalogues import COMMON

    out = []
    for field, names in COMMON.items():
        x = names[0] if left else names[1] or "page_start || '-' || page_end"
        x = country(x) if field in ("affiliation", "authors_json") else issn(x) if field == "issn" else rf"regexp_replace({x}, '\r\n|\n|\r', ' ', 'g')" if field == "title" else x
        out.append(f"{x} as {field}")
    return f"select {', '.join(out)}, {not left} as is_scopus, {left} as is_isi from {'isi' if left else 'scopus'}"


def top_k() -> str:
    term = lambda t: f"select id, len(t) as dl, unnest(t) as term from (select id, {words('title', False)} as t from {t}) where len(t) > 0"
    return f"""with {ISI}, {SCOPUS}, r0 as ({term('scopus')}), l0 as ({term('isi')}),
r as (select id, term, dl, count(*) as tf from r0 group by all), l as (select id, term, count(*) as qf from l0 group by all),
n as (select count(*)::double as n, avg(dl) as a from (select distinct id, dl from r0)), f as (select term, count(*) as df from r group by term),
w as (select r.id, r.term, ln(1 + (n.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / n.a)) as w from r join f using (term), n),
s as (select l.id as left_id, w.id as right_id, round(sum(qf * w), 6) as score from l join w using (term) group by all),
k as (select *, row_number() over (partition by left_id order by score desc, right_id)::int as rank from s)
select left_id, right_id, score, rank from k where rank <= 10"""


LCS = "list_reduce(string_split({a}, ''), lambda row, ch: list_reduce(range(1, len(row)), lambda acc, j: acc || [case when ({b})[j] = ch then row[j] + 1 else greatest(row[j + 1], acc[len(acc)]) end], [0]::bigint[]), list_transform(range(0, length({b}) + 1), lambda z: 0::bigint))[length({b}) + 1]"


def shingle(x: str) -> str:
    return f"case when length({x}) >= 3 then list_distinct(list_transform(range(1, length({x}) - 1), lambda i: substr({x}, i, 3))) else [] end"


def variants() -> str:
    w = f"string_split({clean('''replace(name, '.', '. ')''')}, ' ')"
    front = "w[1:len(w)-1]"
    dots = f"array_to_string(list_transform({front}, lambda x: substr(x, 1, 1) || '.'), ' ')"
    forms = f"""[case when len(w) > 1 then w[len(w)] || ' ' || array_to_string({front}, ' ') else w[len(w)] || ' ' end, {dots} || ' ' || w[len(w)], w[len(w)] || ' ' || {dots}, w[len(w)] || ', ' || substr(w[1], 1, 1) || '.', substr(w[1], 1, 1) || '. ' || w[len(w)]]"""
    return f"""with n as (select unnest(string_split(authors, ', ')) as name from scopus_documents union select unnest(string_split(author, ' and ')) from isi_documents), x as (select name, {w} as w from n where trim(name) <> '')
select name, unnest(list_distinct([name] || case when length(name) - length(replace(name, '.', '')) >= len(w) - 1 then [] else {forms} end)) as variant from x"""


ORGS = f"""{json_rows('isi').replace('label_rows', 'left_rows')}, left_orgs as (select distinct id, label as name from left_rows where q > 0 and u = 0 and label is not null)"""


def organisations() -> str:
    """CTE ``orgs`` (article_id, name) over both catalogues."""
    import re

    right = re.sub(r"\b(v|s|l|au|ax|o|ol|ox|ux)\b(?= as \()|(?<=from )(v|s|l|au|ax|o|ol|ox|ux)\b", lambda m: "r_" + (m[1] or m[2]), json_rows("scopus")).replace("label_rows", "right_rows")
    return f"""{ISI}, {SCOPUS}, {ORGS}, {right}, right_orgs as (select distinct id, label as name from right_rows where q > 0 and u = 0 and label is not null),
orgs as (select a.id as article_id, name from articles a join left_orgs g on g.id = a.raw_isi_id union all select a.id, name from articles a join right_orgs g on g.id = a.raw_scopus_id)"""


MERGED = f"""{ISI}, {SCOPUS}, links as (select i.id as left_id, s.id as right_id from isi i join scopus s on s.id = case when regexp_matches(trim(i.raw_scopus_id), '^[0-9]{{1,18}}$') then trim(i.raw_scopus_id)::bigint end),
both_ as (select 0 as src, id as oid, title, year, document_type as type from scopus union all select 1, id, title, year, type from isi where raw_scopus_id = ''),
last as (select right_id, max(left_id) as l from links group by right_id),
merged as (select row_number() over (order by src, oid) as id, src, oid, regexp_replace(title, '\\r\\n|\\n|\\r', ' ', 'g') as title, year, type, l from both_ left join last on src = 0 and right_id = oid)"""


LABEL = "rpad(case when is_scopus then 'Scopus' else 'ISI' end || '-' || original_id, 18, ' ') || ':  ' || substr(title, 1, 50)"


def reference() -> dict[str, str]:
    phrase = "%university of technology%"
    one = lambda x, column, source=ISI, t="isi": f"with {source} select id, {x} as {column} from {t}"
    a, b = fold("title"), fold("r_title")
    folded = f"with {PAIRS}, p as (select left_id, right_id, lower({a}) as a, lower({b}) as b, title, r_title from pairs)"
    plain = f"with {PAIRS}, p as (select left_id, right_id, {a} as a, {b} as b from pairs)"
    lev = lambda x, y: f"case when {x} is null or {y} is null then 0 when greatest(length({x}), length({y})) = 0 then 0 else 1 - levenshtein({x}, {y}) / greatest(length({x}), length({y})) end"
    return {
        "clean_text": one(clean("title"), "cleaned"),
        "alnum_key": one(f"regexp_replace(lower({trim('title')}), '[^a-z0-9]', '', 'g')", "key"),
        "char_count": one("length(abstract) - length(replace(abstract, 'a', ''))", "n_a"),
        "ascii_fold": one(fold("title"), "folded"),
        "vietnamese": f"with {ISI} select id, regexp_matches(author, '[{VIETNAMESE}]') as is_vietnamese, translate(author, '{VIETNAMESE}', '{VIETNAMESE_PLAIN}') as plain from isi",
        "doi_flag": one("starts_with(doi, '10.')", "is_doi"),
        "pages_range": one("page_start || '-' || page_end", "pages", SCOPUS, "scopus"),
        "issn_norm": one(issn("issn"), "issn"),
        "country_corrected": one(country("affiliation"), "affiliation"),
        "json_escaped": one(r"""'"' || coalesce(replace(replace(replace(replace(replace(replace(keyword, '\', '\\'), '"', '\"'), '/', '\/'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r'), '') || '"'""", "literal"),
        "number_flag": one(rf"coalesce(regexp_matches({trim('pages')}, '^[+-]?(?:NaN|Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?)$'), false)", "is_number"),
        "year_parse": one(year("year"), "year"),
        "type_class": one(kind("type"), "document_type"),
        "stopword_tokens": one(f"array_to_string({words('title', True)}, ' ')", "tokens"),
        "name_variants": variants(),
        "org_suffixes": rf"with a as (select affiliation as x from isi_documents union all select unnest(string_split(affiliations, '; ')) from scopus_documents), t as (select x, replace({trim('lower(x)')}, 'viet nam', 'vietnam') as t from a) select distinct {trim('''regexp_extract(t, '(?s)^.*[ ,.;]([^ ,.;]*.)$', 1)''')} as suffix from t where length(x) >= 2 and regexp_matches(t, '(?s)[ ,.;][^ ,.;]*.$')",
        "slug_bases": f"select id, {slug('title')} as slug from articles",
        "id_gaps": "select 'isi' as catalogue, g as missing_id from (select unnest(generate_series(0, (select max(id) from isi_documents))) as g) where g not in (select id from isi_documents) union all select 'scopus', g from (select unnest(generate_series(0, (select max(id) from scopus_documents))) as g) where g not in (select id from scopus_documents)",
        "catalogue_union": f"with {ISI}, {SCOPUS} {common(True)} union all {common(False)}",
        "link_state": f"with {ISI} select id, case when raw_scopus_id = '' then 'unlinked' else 'linked' end as state from isi where raw_scopus_id is not null",
        "given_links": f"with {PAIRS} select left_id, right_id from pairs",
        "articles_journals": "select a.id as original_id, title, year, name as journal, doi, a.is_isi = 1 as is_isi, a.is_scopus = 1 as is_scopus, uri, journal_id from articles a join journals j on j.id = a.journal_id",
        "catalogue_lookup": f"with {ISI}, {SCOPUS}, u as ({common(True)} union all {common(False)}) select original_id, title, journal, is_isi, is_scopus from u where (is_isi and original_id = (select max(id) from isi)) or (is_scopus and original_id = (select max(id) from scopus))",
        "resumed_ids": "select distinct id from isi_documents where id >= (select max(id) // 2 from isi_documents)",
        "journals_index": f"select id as original_id, name, {issn('issn')} as issn, coalesce(is_isi = 1, false) as is_isi, coalesce(is_scopus = 1, false) as is_scopus, coalesce(is_vci = 1, false) as is_vci from journals",
        "organisations_index": "select id as original_id, name from organizes",
        "article_labels": f"with {ISI}, {SCOPUS}, u as ({common(True)} union all {common(False)}) select original_id, is_isi, {LABEL} as label from u",
        "year_pairs": f"with {PAIRS}, y as (select left_id, right_id, {year('i.year')} as a, {year('s.year')} as b from pairs join isi i on i.id = left_id join scopus s on s.id = right_id) select left_id, right_id, a is null or b is null or a = b as compatible from y",
        "max_ids": " union all ".join(f"select '{t}' as table_name, max(id) as max_id from {t}" for t in ("isi_documents", "scopus_documents", "articles", "journals", "organizes")),
        "lcs_pairs": f"{folded}, s as (select *, case when a is null or b is null then null when length(a) = 0 or length(b) = 0 then 0 else {LCS.format(a='a', b='b')} end as lcs from p) select left_id, right_id, lcs, round(case when title = r_title then 1 when a is null or b is null then 0 when a = b then 1 when greatest(length(a), length(b)) = 0 then 0 else lcs / greatest(length(a), length(b)) end, 6) as title_score from s",
        "lev_pairs": f"{plain}, c as (select *, {clean('a')} as ca, {clean('b')} as cb from p) select left_id, right_id, levenshtein(a, b)::bigint as lev, round({lev('a', 'b')}, 6) as lev_sim, round({lev('ca', 'cb')}, 6) as lev_sim_clean from c",
        "shingle_pairs": f"{plain}, s as (select *, {shingle('a')} as x, {shingle('b')} as y from p) select left_id, right_id, round(case when a is null or b is null then 0 when len(list_distinct(x || y)) > 0 then len(list_intersect(x, y)) / len(list_distinct(x || y)) else 0 end, 6) as jaccard from s",
        "candidate_topk": top_k(),
        "journal_by_issn": f"with {ISI}, k as (select min(id) as journal_id, upper({issn('issn')}) as issn from journals group by 2) select id as record, journal_id from isi join k on upper({issn('isi.issn')}) = k.issn",
        "nested_bounds": "select id, 2 * row_number() over (order by id) - 1 as _lft, 2 * row_number() over (order by id) as _rgt from organizes",
        "merged_articles": f"with {MERGED} select id, title, ({year('year')})::varchar as year, {kind('type')} as document_type, (src = 0)::int as is_scopus, (src = 1 or l is not null)::int as is_isi, case when src = 0 then oid end as raw_scopus_id, case when src = 1 then oid else l end as raw_isi_id from merged",
        "import_log": f"with {MERGED} select left_id as isi_id, id as duplication_of, null::bigint as possible_duplication_of, null::float as title_score, null::float as journal_score, true as is_merged from links join merged on src = 0 and oid = right_id",
        "rep_phrase_members": f"with {organisations()} select distinct a.id, a.title from articles a join orgs on article_id = a.id where name ilike '{phrase}'",
        "rep_not_in": "select id, duplication_of from merge_logs where duplication_of::varchar not in (select raw_scopus_id from isi_documents where raw_scopus_id <> '')",
        "rep_counts": "select (select count(*) from scopus_documents) as crawled_scopus, (select count(*) from isi_documents) as crawled_isi, count(*) filter (is_scopus = 1) as merged_scopus, count(*) filter (is_isi = 1) as merged_isi, count(*) filter (is_scopus = 1 and is_isi = 1) as in_both from articles",
        "rep_disagree": f"""with {organisations()}, m as (select distinct isi_id, duplication_of from merge_logs where duplication_of is not null),
g as (select m.isi_id, m.duplication_of, i.affiliation as isi_organizes, s.affiliations as scopus_organizes, array_to_string(list_sort(list(distinct name)), chr(10)) as merged_organizes from m join isi i on i.id = m.isi_id join scopus s on s.id = try_cast(trim(i.raw_scopus_id) as bigint) join orgs on article_id = m.duplication_of group by 1, 2, 3, 4)
select * from g where not ((isi_organizes ilike '{phrase}' and merged_organizes ilike '{phrase}' and scopus_organizes ilike '{phrase}') or (not isi_organizes ilike '{phrase}' and not merged_organizes ilike '{phrase}' and not scopus_organizes ilike '{phrase}'))""",
        "rep_mismatch": f"""with {organisations()}, g as (select a.id, a.title, i.affiliation, array_to_string(list_sort(list(distinct name)), chr(10)) as merged_organizes from articles a join isi i on i.id = a.raw_isi_id join orgs on article_id = a.id group by 1, 2, 3)
select * from g where (merged_organizes ilike '{phrase}' and not affiliation ilike '{phrase}') or (not merged_organizes ilike '{phrase}' and affiliation ilike '{phrase}')""",
        "link_compare": f"""with {PAIRS}, f as (select distinct isi_id as left_id, raw_scopus_id as t from merge_logs m join articles a on a.id = m.duplication_of where raw_scopus_id is not null)
select coalesce(p.left_id, f.left_id) as left_id, right_id as given_target, t as found_target, case when t is null then 'only_given' when right_id is null then 'only_found' else 'different' end as status from pairs p full join f on f.left_id = p.left_id where t is null or right_id is null or t <> right_id""",
    }
