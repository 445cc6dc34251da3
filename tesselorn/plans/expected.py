"""SQL that tells from the relational tables what every feature must be."""

from __future__ import annotations

from tesselorn.functions.fixed import FILE_PREFIX, HYPER_TRIG, LIVE_GENS, NOT_VARIATIONS, VARIATIONS

LIVE_BASE, ARCHIVE_BASE, FETCHED_AT = "http://live.example", "http://archive.example", "2026-01-01T00:00:00Z"


def _list(names) -> str:
    return "[" + ",".join(f"'{n}'" for n in names) + "]"


KEY = f"gen::varchar || '/' || printf('%05d', k // 10000 * 10000) || '/' || printf('{FILE_PREFIX}.%d.%05d.flam3', gen, k)"

#: it: xforms; x: their folds; o: orders and their classes; d: whole texts;
#: r: what the index says of each document.
BASE = f"""
with it as (
  select l_orderkey as k, l_linenumber as ln, l_partkey as p, l_suppkey as s, l_quantity::int - 10 as w, l_returnflag as rf,
    list_transform([l_partkey, l_suppkey] || list_transform(case l_partkey % 13 when 0 then [11] when 1 then [11, 23, 37, 59] else []::int[] end, lambda d: l_partkey + d), lambda v: v % 101 + 1) as every
  from lineitem
), iv as (
  select *, list_transform(list_filter(every, lambda v, i: list_position(every, v) = i), lambda v: ({_list(VARIATIONS)})[v]) as vl from it
), xf as (
  select *, '<xform weight="' || w || '" color="0" coefs="' || case when k % 53 = 0 then 'nan' else ln::varchar end || ' 0 0 ' || p % 12 || ' 0 0"'
    || case p % 3 when 0 then ' post="0.5 0 0 1 0 0"' when 1 then ' post="1 0 0 1 0 0"' else '' end
    || case when rf = 'R' then ' chaos="1 0"' else '' end
    || array_to_string(list_transform(vl, lambda v, i: ' ' || v || case i when 1 then '="1"' else '="0.5"' end), '') || ' julian_power="2"/>' as t
  from iv
), x as (
  select k, count(*)::int as n, bool_or(p % 3 = 0) as post, bool_or(rf = 'R') as xaos, count(*) filter (where w < 0)::int as neg,
    max(greatest(case when k % 53 = 0 then 0 else ln end, p % 12, case when p % 3 = 0 then 1 else 0 end)) as coef,
    greatest(max(w), 0)::double as weight, list_distinct(flatten(list(vl))) as vs,
    list(len(vl)::int order by ln, p, s, t) as cnts, list(p % 3 = 0 order by ln, p, s, t) as posts, string_agg(t, '' order by ln, p, s, t) as ts
  from xf group by k
), o as (
  select o_orderkey as k, o_custkey as c, o_orderstatus as st, o_orderpriority as pr, (240 + o_orderkey % 10)::int as gen, o_orderkey % 20 as m,
    case when o_orderkey % 20 = 0 then 'animation' when o_orderkey % 20 < 5 then 'corrupt' else 'genome' end as kind,
    case when o_orderkey % 2 = 0 then ({_list(VARIATIONS)})[o_custkey % 101 + 1] end as fv
  from orders
), f as (
  select o.*, coalesce(n, 0) as n, coalesce(post, false) as post, coalesce(xaos, false) as xaos, coalesce(neg, 0) as neg, coalesce(cnts, []) as cnts, coalesce(posts, []) as posts,
    greatest(coalesce(coef, 0), case when fv is null then 0 else 1 end)::double as coef, coalesce(weight, 0.0) as weight, coalesce(vs, []) as vs,
    list_sort(list_distinct(coalesce(vs, []) || case when fv is null then [] else [fv] end)) as used,
    case when k % 7 = 6 then null when k % 97 = 5 then 70 else k % 7 - 3 end as sym,
    '<flame name="{FILE_PREFIX}.' || gen || '.' || k || '"'
    || case when c % 2 = 0 then ' nick="' || pr || '"' else '' end
    || case when c % 5 = 0 then '' else ' version="V-' || st || c % 7 || '"' end
    || case when c % 3 = 0 then ' gamma="3.5"' else '' end || case when c % 4 = 0 then ' vibrancy="0.5"' else '' end
    || case when c % 3 = 1 then ' palette_mode="linear"' else '' end || case when c % 6 = 0 then ' background="0 0 0.5"' else '' end
    || ' rotate="' || (c % 4) * 10 || '" supersample="' || 1 + c % 2 || '"'
    || case when c % 7 = 0 then ' highlight_power="1"' else '' end || case when c % 8 = 0 then ' filter_shape="bell"' else '' end
    || case when c % 9 = 0 then ' estimator_radius="9"' else '' end
    || case when c % 10 = 0 then ' estimator_minimum="1" estimator_curve="0.6"' else '' end
    || case when k % 59 = 0 then ' center="0 NaN"' else '' end || '>'
    || case when k % 7 = 6 then '' else '<symmetry kind="' || case when k % 97 = 5 then 70 else k % 7 - 3 end || '"/>' end || coalesce(ts, '')
    || case when fv is null then '' else '<finalxform coefs="1 0 0 1 0 0" ' || fv || '="1"/>' end || '</flame>' as flame
  from o left join x using (k)
), d as (
  select *, m = 2 and k % 3 = 0 as bad,
    case when k % 2000 = 0 then 600 when k % 1000 = 0 then 150 when k % 400 = 0 then 70 when k % 100 = 0 then 20 else 2 + k % 3 end::int as nf,
    case m when 0 then repeat(flame, nf) when 1 then '' when 2 then flame || ' tail' when 3 then 'none'
    when 4 then '<t' || k % 17 || '><body>x</body></t' || k % 17 || '>' when 5 then '<get>' || flame || '</get>'
    else case when k % 2 = 0 then '<?xml version="1.0"?>' else '' end || flame end as content
  from f
), r as (
  select *, printf('%d/%05d', gen, k) as id, {KEY} as seq, encode(content) || case when bad then '\\xFF'::blob else ''::blob end as raw, strlen(content) + case when bad then 1 else 0 end as bytes,
    case when bad then 'parse: not well-formed (invalid token): line 1, column ' || strlen(content) else case m when 1 then 'zero-byte' when 2 then 'junk-after-document' when 3 then 'no-flame-elements' when 4 then 'no-flame-in-t' || k % 17 end end as error,
    case kind when 'animation' then nf when 'genome' then 1 end::int as frames,
    list_has_any(used, {_list(HYPER_TRIG)}) as trig, list_contains(used, 'edisc') as edisc,
    (n + case when sym > 1 then sym - 1 when sym < 0 then 2 * abs(sym) - 1 else 0 end)::int as psym,
    k % 53 = 0 and n > 0 as nanx, k % 59 = 0 as nanc
  from d
), g as (select * from r where kind = 'genome')
"""


def counts(tests: dict[str, str]) -> str:
    return BASE + " union all ".join(f"select '{n}' as feature, count(*) filter (where {c}) as genomes from g" for n, c in tests.items())


def ids(where: str) -> str:
    return BASE + f"select id, seq as scan_seq from g where {where}"


STRUCTURAL = counts({
    "has_post_affine": "post", "has_final_xform": "fv is not null", "has_symmetry": "sym is not null", "has_xaos": "xaos", "nick": "c % 2 = 0",
    "palette_linear": "c % 3 = 1", "palette_step": "c % 3 <> 1", "background": "c % 6 = 0", "rotate": "c % 4 <> 0", "supersample": "c % 2 = 1",
    "highlight_power": "c % 7 = 0", "negative_weights": "neg > 0", "filter_shape": "c % 8 = 0",
})
SAFETY = counts({"hyper_trig": "trig", "edisc": "edisc", "wide_coef": "coef > 5", "post_symmetry": "psym > 64", "density_estimator": "c % 9 = 0"})
TONE = counts({"gamma": "c % 3 = 0", "vibrancy": "c % 4 = 0", "estimator_minimum": "c % 10 = 0", "estimator_curve": "c % 10 = 0"})

SUMMARY = BASE + """
select count(*) as total, count(*) filter (where kind = 'genome') as genomes, count(*) filter (where kind = 'animation') as animations,
  count(*) filter (where kind = 'corrupt') as corrupt, (select count(distinct v) from (select unnest(used) as v from g)) as variations from r
"""
SHAPE = BASE + """
select gen, count(*) as total, count(*) filter (where kind = 'genome') as genome, count(*) filter (where kind = 'animation') as animation,
  count(*) filter (where kind = 'corrupt') as corrupt, case when grouping(gen) = 0 then min(bytes) end as min_bytes,
  case when grouping(gen) = 0 then max(bytes) end as max_bytes
from r group by rollup (gen)
"""
HISTOGRAM = BASE + """
select v as variation, count(*) as genomes, min(seq) as first_seq from (select unnest(used) as v, seq from g) group by v
"""
VERSIONS = BASE + """
select case when c % 5 = 0 then '(unset)' else 'V-' || st || c % 7 end as version, count(*) as genomes, min(seq) as first_seq
from g group by 1 order by 2 desc, 3 limit 10
"""
MALFORMATIONS = BASE + """
select gen, count(*) filter (where kind = 'genome' and nanc) as nan_camera, count(*) filter (where kind = 'genome' and nanx) as nan_xforms
from r group by rollup (gen)
"""
XFORMS = BASE + "select n as xform_count, count(*) as genomes from g group by n"
DENSITY = BASE + """
, h as (select v as variations, count(*) as xforms from (select unnest(cnts || case when fv is null then []::int[] else [1] end) as v from g) group by v)
select variations, xforms, 100.0::double * xforms / (select sum(xforms)::bigint from h) as percent from h
"""
DENSE = BASE + "select count(*) filter (where len(list_filter(cnts, lambda v: v >= 5)) > 0) as genomes from g"
FRAMES = BASE + """
select low, high, (select count(*) from r where kind = 'animation' and frames between low and high) as animations
from (values (1, 1), (2, 10), (11, 50), (51, 100), (101, 500), (501, 100000)) b(low, high)
"""
ERRORS = BASE + "select error, count(*) as documents, min(seq) as first_seq from r where kind = 'corrupt' group by error order by 2 desc, 3 limit 10"

SAFE = "not trig and not edisc and c % 9 <> 0 and not nanc and not nanx and psym <= 64 and coef <= 5"
PARITY = "not xaos and c % 2 = 0 and c % 7 <> 0"
SYMMETRY = BASE + "select sym::int as symmetry_kind, count(*) as genomes from g group by sym"
TONAL = BASE + """
select id, case when c % 5 = 0 then '' else 'V-' || st || c % 7 end as version, case when c % 3 = 0 then 3.5 else 4 end::double as gamma,
  case when c % 4 = 0 then 0.5 else 1 end::double as vibrancy, seq as scan_seq from g where c % 3 = 0 or c % 4 = 0
"""

RARE = BASE + """
, u as (select id, seq, unnest(used) as v from g), c as (select v, count(*) as n from u group by v order by 2, 1 limit 5)
select id, seq as scan_seq, min({'n': n, 'v': v}).v as variation from u join c using (v) group by id, seq
"""
DENSEST = BASE + """
select id, coalesce(list_max(cnts), 0)::int as max_var_per_xform, case when n = 0 then 0 else round_even(list_sum(cnts)::double / n, 2) end::double as mean_var_per_xform, seq as scan_seq
from g order by 2 desc, 3 desc, 4 limit 10
"""

#: Fields of genomes, as the tables tell them; arrays as joined texts.
GENOME_FIELDS = {
    "name": f"'{FILE_PREFIX}.' || gen || '.' || k", "nick": "case when c % 2 = 0 then pr else '' end", "url": "''", "dims": "''",
    "version": "case when c % 5 = 0 then '' else 'V-' || st || c % 7 end", "rotate": "(c % 4 * 10)::double", "brightness": "4::double",
    "palette_mode": "case when c % 3 = 1 then 'linear' else 'step' end", "filter_shape": "case when c % 8 = 0 then 'bell' else 'gaussian' end",
    "background": "case when c % 6 = 0 then '0.0,0.0,0.5' else '0.0,0.0,0.0' end", "supersample": "(1 + c % 2)::int",
    "highlight_power": "case when c % 7 = 0 then 1 else -1 end::double", "has_nan_camera": "nanc", "has_density_estimator": "c % 9 = 0",
    "gamma": "case when c % 3 = 0 then 3.5 else 4 end::double", "vibrancy": "case when c % 4 = 0 then 0.5 else 1 end::double",
    "estimator_minimum": "case when c % 10 = 0 then 1 else 0 end::double", "estimator_curve": "case when c % 10 = 0 then 0.6 else 0.4 end::double",
    "has_symmetry": "sym is not null", "symmetry_kind": "sym::int", "xform_count": "n", "has_final_xform": "fv is not null", "has_post_affine": "post",
    "has_xaos": "xaos", "has_nan_in_xforms": "nanx", "negative_weight_xforms": "neg", "variations": "array_to_string(used, ',')",
    "xform_var_counts": "array_to_string(cnts, ',')", "max_var_per_xform": "coalesce(list_max(cnts), 0)::int",
    "mean_var_per_xform": "case when n = 0 then 0 else round_even(list_sum(cnts)::double / n, 2) end::double",
    "xforms_with_5plus_vars": "len(list_filter(cnts, lambda v: v >= 5))::int", "final_xform_var_count": "case when fv is not null then 1 end::int",
    "has_post_affine_per_xform": "array_to_string(posts, ',')", "max_xform_weight": "weight", "has_hyper_trig": "trig", "has_edisc": "edisc",
    "max_abs_affine_coef": "coef", "xform_count_post_symmetry": "psym",
}
RECORDS = BASE + "select id, gen, k as sheep_id, bytes::bigint as byte_size, kind, kind <> 'corrupt' as valid, frames as frame_count, error, false as sealed, " + ", ".join(f"case when kind = 'genome' then {sql} end as {name}" for name, sql in GENOME_FIELDS.items()) + " from r"
LOOKUP = BASE + "select id, kind, frames as frame_count from r where id = '246/00006'"

_SEEN = "m not in (1, 3, 4) and not bad"
MANIFEST = BASE + f"""
select gen, k as id, sha256(raw) as sha256, bytes::bigint as file_size_bytes, '{FETCHED_AT}' as fetched_at,
  case when gen in ({", ".join(map(str, LIVE_GENS))}) then printf('{LIVE_BASE}/gen/%d/%d/{FILE_PREFIX}.%d.%05d.flam3', gen, k, gen, k)
    else printf('{ARCHIVE_BASE}/generation-%d/%d/spex', gen, k) end as source_url,
  case when {_SEEN} then printf('{FILE_PREFIX}.%d.%d', gen, k) else '' end as name,
  case when {_SEEN} and c % 2 = 0 then pr else '' end as nick, '' as url, case when {_SEEN} then n else -1 end::int as xform_count,
  {_SEEN} and fv is not null as final_xform,
  case when {_SEEN} and n > 0 then array_to_string(list_sort(list_filter(list_distinct(vs || ['julian_power']), lambda v: not list_contains({_list(NOT_VARIATIONS)}, v))), ';') else '' end as variations
from r
"""
VALID = BASE + f"select gen, k as sheep_id, {_SEEN} as valid from r"
SERVED = BASE + "select gen, k as sheep_id, sha256(case when kind = 'genome' then content else flame end) as sha256 from r where kind <> 'corrupt'"
TEXTS = BASE + "select gen, k as sheep_id, sha256(content) as sha256 from r where not bad"
