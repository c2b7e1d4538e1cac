"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

from textpulse.llm import pareto_mix, secret_scan, url_cascade

OP3_EXACT_DEDUP = r"""
with plain as (
  select doc_id, length(coalesce(text, '')) as chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
  from documents
), ranked as (
  select *, first_value(doc_id) over w as keep_id, row_number() over w as rank,
    count(*) over (partition by body) as group_size
  from plain window w as (partition by body order by chars desc, doc_id)
)
select doc_id, keep_id, group_size, rank = 1 as kept, sha256(body) as text_sha256 from ranked
"""

def _found(kind: str, order: int, pattern: str) -> str:
    """Matches of a pattern with positions: lengths of gaps and matches before them, added up."""
    quoted = pattern.replace("'", "''")
    return f"""
{kind}_pieces as (
  select doc_id, source, unnest(range(len(m))) as i, unnest(m) as v, unnest(g[1:len(m)]) as gap
  from (
    select doc_id, source, regexp_extract_all(coalesce(text, ''), '{quoted}') as m,
      string_split_regex(coalesce(text, ''), '{quoted}') as g
    from documents
  )
), {kind}_spans as (
  select doc_id, source, {order} as kind_order, '{kind}' as kind, v,
    sum(length(gap) + length(v)) over w - length(v) as a, sum(length(gap) + length(v)) over w as b
  from {kind}_pieces window w as (partition by doc_id order by i)
)"""


_HEAD = secret_scan.ASSIGN_HEAD.replace("'", "''")

OP2_SECRET_SCANS = f"""
with {_found("assign", 0, secret_scan.ASSIGN)}, {_found("access", 1, secret_scan.ACCESS)},
{_found("hex", 2, secret_scan.HEX)}, {_found("owned", 3, secret_scan.CANDIDATE)},
base as (
  select *, regexp_replace(v, '^{_HEAD}', '') as value from assign_spans
  where length(regexp_replace(v, '^{_HEAD}', '')) >= {secret_scan.MIN_ASSIGNED}
  union all select *, v from access_spans
  union all select *, v from hex_spans
), tokens as (
  select *, v as value from owned_spans where regexp_matches(v, '{secret_scan.HAS_BOTH}')
), candidates as (
  select * from base union all select * from tokens
), judged as (
  select value, count(distinct source) <= {secret_scan.MAX_OWNERS} as live
  from candidates group by value
), own as (
  select t.* from tokens t join judged j on t.value = j.value and j.live
  where not exists (
    select 1 from base b where b.doc_id = t.doc_id and b.a < t.b and b.b > t.a
  )
), listed as (
  select doc_id, kind_order, kind, a, b from base
  union all select doc_id, kind_order, kind, a, b from own
), spans as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign,
    count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    count(*) filter (kind = 'owned') as n_owned,
    coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, kind_order, b)
      filter (kind <> 'owned'), '') as base_text,
    string_agg(kind || ':' || a || ':' || b, ',' order by a, kind_order, b) as spans
  from listed group by doc_id
), counts as (
  select c.doc_id, count(distinct c.value) filter (j.live) as n_live_values,
    count(distinct c.value) filter (not j.live) as n_copied_values
  from candidates c join judged j on c.value = j.value group by c.doc_id
)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base_text, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_owned, 0) as n_owned,
  coalesce(n_live_values, 0) as n_live_values, coalesce(n_copied_values, 0) as n_copied_values
from documents d left join spans s on d.doc_id = s.doc_id left join counts c on d.doc_id = c.doc_id
"""


def _mixing_rounds(rounds: int) -> str:
    """Each round takes, by rank, what still fits into the words that a source has left."""
    steps = []
    for n in range(rounds):
        steps.append(f"""
left_{n} as (
  select *, greatest(floor(target - sum(certain * size + taken * size) over (partition by source)
    + 0.5), 0) as room
  from round_{n}
), open_{n} as (
  select doc_id, sum(size) over (partition by source order by rank, doc_id) <= room as fits
  from left_{n} where able and taken = 0 and size <= room
), round_{n + 1} as (
  select l.* exclude (taken, room), case when coalesce(o.fits, false) then 1 else taken end as taken
  from left_{n} l left join open_{n} o on l.doc_id = o.doc_id
)""")
    return ",".join(steps)


OP8_MIXING_SOURCES = rf"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double
    as weight, 2 * source_size::double as bound
  from sources
), rising as (
  select *, bound / weight as full_at from weighed
), sums as (
  select *,
    coalesce(sum(bound) over (w rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (w rows between current row and unbounded following) as onward,
    1.5::double * sum(source_size) over () as everything
  from rising window w as (order by full_at, source nulls last)
), levels as (
  select *, case when (everything - before) / onward <= full_at
    then (everything - before) / onward end as level
  from sums
), true_level as (
  select arg_min(level, full_at) filter (level is not null) as level from levels
), targets as (
  select source, source_size, least(bound, coalesce(t.level * weight, bound)) as target
  from levels, true_level t
), expected as (
  select s.*, source_size, target,
    case when source_size > 0 then least(target / source_size, 2.0::double) else 0.0::double end as copies,
    (('0x' || substr(md5('mix:' || doc_id), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double as u
  from sized s join targets t on s.source is not distinct from t.source
), ranked as (
  select *, floor(copies)::bigint as certain, copies - floor(copies) as chance from expected
), round_0 as (
  select doc_id, source, size, source_size, target, certain, 0 as taken,
    certain < 2 and chance > 1e-9 and size > 0 as able,
    (u / (1 - u)) / (least(greatest(chance, 1e-9::double), 1 - 1e-9::double)
      / (1 - least(greatest(chance, 1e-9::double), 1 - 1e-9::double))) as rank
  from ranked
), {_mixing_rounds(pareto_mix.ROUNDS)}
select doc_id, size, source_size, target, ((certain + taken) * size)::bigint as taken,
  (certain + taken)::bigint as copies
from round_{pareto_mix.ROUNDS}
"""

OP9_JACCARD_JOIN = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), placed as (
  select doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) as i from worded
), shingles as (
  select distinct doc_id, array_to_string(w[i + 1:i + 5], ' ') as s from placed
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), links as (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, m.n, n.n
  having 100 * count(*) >= 75 * (m.n + n.n - count(*))
), reached as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b from reached r join links l on r.other = l.a
)
select r.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
from reached r left join sizes s on r.doc_id = s.doc_id group by r.doc_id
"""

def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{value}'" for value in row) + ")" for row in rows)


OP11_URL_FILTERS = f"""
with parts as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path,
    row_number() over () as i
  from pages
), rules(rule_host, rule_path, verdict) as (
  values {_values([(r.host, r.path, r.verdict) for r in url_cascade.RULES])}
), domains(domain) as (
  values {_values([(domain,) for domain in url_cascade.LISTED_DOMAINS])}
), best as (
  select i, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(r.verdict, length(rule_host || rule_path)) as verdict
  from parts join rules r on (host = rule_host or ends_with(host, '.' || rule_host))
    and starts_with(path, rule_path)
  group by i
), listed as (
  select distinct i from parts join domains on host = domain or ends_with(host, '.' || domain)
)
select page_id, host, path, rule,
  coalesce(verdict, case when l.i is not null then 'block' else 'allow' end) as verdict
from parts p left join best b on p.i = b.i left join listed l on p.i = l.i
"""

OP12_HARD_NEGATIVES = """
with given as (
  select vec_id, label::bigint as label, [floor(256 * x::double) for x in embedding] as v
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), vectors as (
  select vec_id, v, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
  from given
), scores as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
    list_inner_product(a.v, r.v)::bigint as score
  from vectors a join vectors r on a.vec_id <> r.vec_id
  where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int
      as rank
  from positives p join scores s on p.anchor_id = s.anchor_id and not s.same
    and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""

ORACLES: dict[str, str] = {
    "op2_secret_scans": OP2_SECRET_SCANS,
    "op3_exact_dedup": OP3_EXACT_DEDUP,
    "op8_mixing_sources": OP8_MIXING_SOURCES,
    "op9_jaccard_join": OP9_JACCARD_JOIN,
    "op11_url_filters": OP11_URL_FILTERS,
    "op12_hard_negatives": OP12_HARD_NEGATIVES,
}
