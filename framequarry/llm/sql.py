"""DuckDB SQL of queries that SQL can express whole: the URL filter, the Jaccard join, sharding and spelling variants."""

from __future__ import annotations

from framequarry.llm.url_filter import DIGITS, MAX_MEAN, MIN_CHILDREN, REJECT, RULES, SPLIT, M

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filter_sql() -> str:
    host = "regexp_extract(rest, '^[^/?#]*', 0)"
    fits, verdicts = "null", "null"
    for verdict, rule in sorted(RULES, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        test = f"(host = '{name}' or suffix(host, '.{name}')) and starts_with(path, '/{rest}')"
        fits, verdicts = f"case when {test} then '{rule}' else {fits} end", f"case when {test} then '{verdict}' else {verdicts} end"
    ll = lambda b, n: f"(case when {b} > 0 then {b} * ln({b} / {n}) else 0 end + case when {n} - ({b}) > 0 then ({n} - ({b})) * ln(({n} - ({b})) / {n}) else 0 end)"
    variable = f"kinds >= {MIN_CHILDREN} and (n <= {MAX_MEAN} * kinds or digits >= {DIGITS} * kinds)"
    parts = [
        "r as (select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages)",
        f"h as (select page_id, url, coalesce({_LOW.format(host)}, '') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from r)",
        f"p as (select *, {fits} as rule, {verdicts} as rv from h)",
        "t(host, path, segs, d, tpl) as (select distinct host, path, case when path = '' then [] else string_split(regexp_replace(path, '^/', ''), '/') end, 0, '' from p union all"
        f" select host, path, segs, d + 1, tpl || '/' || case when {variable} then '*' else segs[d + 1] end from"
        " (select *, count(*) over w as n, count(distinct segs[d + 1]) over w as kinds, count(distinct case when regexp_matches(segs[d + 1], '[0-9]') then segs[d + 1] end) over w as digits"
        " from t where len(segs) > d window w as (partition by host, tpl)))",
        "leaf as (select host, path, tpl as template, regexp_replace(tpl, '/[^/]*[0-9][^/]*', '/*', 'g') as tpl from t where len(segs) = d)",
        "u as (select host, path, url, avg(case when rule is not null then cast(rv = 'block' as int) end) as bad from p group by all)",
        r"g as (select host, tpl, regexp_replace(tpl, '^((?:/\*)*)/[^/*]+', '\1/{}') as shape, count(bad) as labelled, coalesce(sum(bad), 0) as bad from u join leaf using (host, path) group by all)",
        "pr as (select least(0.5, (coalesce(sum(bad), 0) + 1) / (coalesce(sum(labelled), 0) + 2)) as prior from g)",
        "l0 as (select g.*, prior, cast(labelled > 0 as int) as own, cast(round(100 * bad / nullif(labelled, 0)) as int) as level, case when labelled > 0 then (bad + 0.5 * prior) / (labelled + 0.5) else 0 end as s from g, pr)",
        "lt as (select template, count(*) as k_t, sum(s) as s_t from (select *, tpl as template from l0) where own = 1 group by all)",
        "lh as (select host, count(*) as k_h, sum(s) as s_h from l0 where own = 1 group by all)",
        "lg as (select host, shape, count(*) as k_g, sum(s) as s_g, count(*) filter (where s >= 0.5) as up from l0 where own = 1 group by all)",
        "lv as (select host, shape, level, sum(labelled) as n, sum(bad) as b from l0 where own = 1 group by all)",
        "rn as (select host, shape, level, sum(n) over u as n1, sum(b) over u as b1, sum(n) over (partition by host, shape) as n0, sum(b) over (partition by host, shape) as b0 from lv window u as (partition by host, shape order by level))",
        f"gn as (select *, case when n0 > n1 then round(2 * ({ll('b1', 'n1')} + {ll('(b0 - b1)', '(n0 - n1)')} - {ll('b0', 'n0')}), 6) else 0 end as gain from rn)",
        f"sp as (select host, shape, case when gain >= {SPLIT} then level end as cut, n1, b1, n0, b0 from (select *, row_number() over (partition by host, shape order by gain desc, level) as place from gn) where place = 1)",
        "x0 as (select l0.*, coalesce(k_t, 0) - own as kt, coalesce(s_t, 0) - own * s as st, k_h, coalesce(k_h, 0) - own as kh, coalesce(s_h, 0) - own * s as sh, k_g, coalesce(k_g, 0) - own as kg, coalesce(s_g, 0) - own * s as sg, up, cut, n1, b1, n0, b0"
        " from l0 left join lt on tpl = template left join lh using (host) left join lg using (host, shape) left join sp using (host, shape))",
        "x1 as (select *, case when kh > 0 then pow(abs(2 * sh / kh - 1), 3) else 0 end as ah, case when kg > 0 then pow(abs(2 * sg / kg - 1), 3) else 0 end as ag, case when kt > 0 then pow(abs(2 * st / kt - 1), 3) else 0 end as at_ from x0)",
        "x2 as (select *, (ag * sg + (ah * sh + prior) / (ah * kh + 1)) / (ag * kg + 1) as beside from x1)",
        f"x3 as (select *, (at_ * st + beside) / (at_ * kt + 1) as back, {M} * (case when s >= 0.5 then up else k_g - up end) / (1 + kg) as m from x2)",
        "b as (select host, tpl, shape || ' ' || case when own = 0 then 'none' when cut is null then 'all' when level <= cut then 'low' else 'high' end as branch, case when own = 1"
        " then (case when cut is null then b0 when level <= cut then b1 else b0 - b1 end + m * back) / (case when cut is null then n0 when level <= cut then n1 else n0 - n1 end + m) when k_h is null then least(back, 0.5) else back end as bad_share from x3)",
    ]
    return f"with recursive {', '.join(parts)} select page_id, p.host, p.path, rule, coalesce(rv, case when bad_share >= {REJECT} then 'block' else 'allow' end) as verdict, l.template, b.branch, round(bad_share, 6) as bad_share from p join leaf l on p.host = l.host and p.path = l.path join b on l.host = b.host and l.tpl = b.tpl"


JACCARD_SQL = rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) end) as s from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all),
e as (select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from e union all select b, a from e),
reach(d, r) as (select doc_id, doc_id from documents union select d, b from reach join both_ways on a = r)
select doc_id, coalesce(n, 0) as n_shingles, least_id as component_id from documents left join n using (doc_id) join (select d as doc_id, min(r) as least_id from reach group by d) using (doc_id)
"""

#: CRC-32 of a text's UTF-8 bytes: the table by its rule, then one lookup for each byte.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i))"
_CRC = "xor(list_reduce(list_transform(regexp_extract_all(hex(encode({})), '..'), lambda x: cast('0x' || x as bigint)), lambda c, x: xor(c >> 8, crc_table[1 + (xor(c, x) & 255)]), 4294967295), 4294967295)"

SHARDING_SQL = f"""
with t as (select {_CRC_TABLE} as crc_table),
d as (select doc_id, row_number() over () as r, coalesce(text, '') as text, octet_length(encode(coalesce(text, ''))) + 1 as size from documents),
s as (select doc_id, r, size, {_CRC.format("text")} as crc, sum(size) over (order by doc_id nulls first, r) - size as before, sum(size) over () as total from d, t),
p as (select *, cast(least(7, (2 * before + size) * 8 // (2 * total)) as int) as shard from s)
select doc_id, cast(size as bigint) as size, cast(crc as bigint) as text_crc32, 'bytes' as law, shard,
  cast(row_number() over (partition by shard order by doc_id nulls first, r) - 1 as bigint) as slot, cast(null as int) as grown_shard from p
"""

#: Near words share what is left after taking one letter out, at the same place (a letter replaced) or as a whole (one more or less).
SPELLING_SQL = rf"""
with recursive t as (select {_CRC_TABLE} as crc_table),
r as (select coalesce(cast(doc_id as varchar), 'null') as id, unnest(regexp_extract_all({_LOW.format("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) as w from documents),
c as (select id, w, count(*) as n from r where length(w) >= 6 group by all),
h as (select w, n, {_CRC.format("id || ':' || w")} as h from c, t),
d as (select case when h % 199 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from h),
v as (select word, sum(n) as n from d where length(word) >= 6 group by word having sum(n) >= 5),
s as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(length(word))) as i from v)),
near as (select a.word, b.word as other, b.n as other_n from s a join s b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select s.word, v.word, v.n from s join v on s.rest = v.word union select v.word, s.word, s.n from s join v on s.rest = v.word),
best as (select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from near group by word),
f as (select word, n, coalesce(n_near, 0) as n_near, case when other_n >= 5 * n then other end as form, case when other_n >= 5 * n then other_n end as form_n from v left join best using (word)),
chain as (select word, word as link, 0 as d from f union all select chain.word, f.form, d + 1 from chain join f on chain.link = f.word where f.form is not null),
ends as (select word, arg_max(link, d) as root from chain group by word)
select word, form, root, cast(n as bigint) as n, cast(n_near as bigint) as n_near, cast(form_n as bigint) as form_n from f join ends using (word)
"""
