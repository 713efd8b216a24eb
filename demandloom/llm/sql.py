"""SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

_UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))


def words(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


LOWERED = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"

#: Smallest id reachable by the links (x, y) of a CTE ``links``, for all ids of ``nodes``.
REACHED = """
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached(id, low) AS (SELECT id, id FROM nodes UNION SELECT b.y, r.low FROM reached r JOIN both_ways b ON r.id = b.x WHERE r.low < b.y),
labels AS (SELECT id, MIN(low) AS component_id FROM reached GROUP BY 1)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {words(LOWERED)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
nodes AS (SELECT doc_id AS id FROM documents), {REACHED}
SELECT id AS doc_id, COALESCE(n, 0) AS n_shingles, component_id FROM labels LEFT JOIN sizes ON doc_id = id
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings), {REACHED},
counts AS (SELECT id, COUNT(*) AS n FROM (SELECT x AS id FROM links UNION ALL SELECT y FROM links) GROUP BY 1)
SELECT l.id AS vec_id, COALESCE(n, 0) AS n_links, component_id, l.id = component_id AS kept FROM labels l LEFT JOIN counts c ON c.id = l.id
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {words("text")} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
earliest AS (SELECT g, MIN(doc_id) AS low FROM windows GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k FROM windows JOIN earliest USING (g) WHERE low < doc_id)),
placed AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT placed.doc_id, string_agg(word, ' ' ORDER BY placed.p) AS t, COUNT(*) AS k FROM placed
  LEFT JOIN gone ON gone.doc_id = placed.doc_id AND gone.p = placed.p WHERE gone.p IS NULL GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - COALESCE(k, 0) AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

#: Unsigned crc32 of a decimal number's digits, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, [ascii(c)::bigint for c in string_split(cast(doc_id as varchar), '')]),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
    lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""


def _leaf(n_chars: str) -> str:
    parts = [f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", f"({n_chars})", "text")]
    return f"sha256({' || '.join(parts)})"


MANIFEST = f"""
with recursive chosen as (
  select *, doc_id is not null and n_chars is not null and {_CRC32} % 7 = 0 as tamper from documents
), leaves as (
  select row_number() over () as row, doc_id, coalesce('=' || lang, '') as g, {_leaf("n_chars")} as leaf,
    case when tamper then {_leaf("n_chars::hugeint + 1")} end as tampered
  from chosen
), placed as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by g) as n from leaves
), nodes as (
  select g, 0 as lvl, pos, n, leaf as h from placed
  union all
  select g, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from nodes where n > 1 group by g, lvl, pos // 2, n
), langs as (
  select g, h, row_number() over (order by g) - 1 as pos, count(*) over () as n from nodes where n = 1
), upper_nodes as (
  select 0 as lvl, pos, n, h from langs
  union all
  select lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from upper_nodes where n > 1 group by lvl, pos // 2, n
), steps as (
  select p.row, l.lvl as lvl, (p.pos >> l.lvl) as at, s.h as h
  from placed p join (select distinct g, lvl from nodes where n > 1) l on l.g = p.g
  left join nodes s on s.g = p.g and s.lvl = l.lvl and s.pos = xor(p.pos >> l.lvl, 1)
  union all
  select p.row, 100 + l.lvl, (t.pos >> l.lvl), s.h
  from placed p join langs t on t.g = p.g cross join (select distinct lvl from upper_nodes where n > 1) l
  left join upper_nodes s on s.lvl = l.lvl and s.pos = xor(t.pos >> l.lvl, 1)
), path as (
  select *, row_number() over (partition by row order by lvl) as k from steps
), proof as (
  select row, sha256(string_agg(coalesce(h, ''), '' order by k)) as proof, max(k) as k from path group by row
), fold as (
  select row, 0::bigint as k, coalesce(tampered, leaf) as h from placed
  union all
  select f.row, f.k + 1, sha256(case when s.h is null then f.h when s.at % 2 = 0 then f.h || s.h else s.h || f.h end)
  from fold f join path s on s.row = f.row and s.k = f.k + 1
)
select p.doc_id, p.leaf, t.h as subroot, r.h as root, coalesce(o.proof, sha256('')) as proof_sha256, f.h as folded_root, f.h = r.h as verified
from placed p join langs t on t.g = p.g cross join (select h from upper_nodes where n = 1) r
left join proof o on o.row = p.row join fold f on f.row = p.row and f.k = coalesce(o.k, 0)
"""

#: Mines every subset of tokens; equal to the query while no labelled URL has more tokens than the mining takes (12).
URL_FILTERS = r"""
with cut_urls as (
  select page_id, coalesce(url, '') as url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, url, rest, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) as query
  from cut_urls
), ruled as (
  select *, case
      when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
      when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
      when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
      when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end as rule,
    case when instr(url, '://') > 0 then list_sort(list_distinct(list_concat(list_concat(
      ['host:' || t for t in string_split(host, '.') if t <> ''],
      ['path:' || t for t in string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/') if t <> '']), list_concat(
      ['field:' || t for t in [split_part(f, '=', 1) for f in string_split(query, '&')] if t <> ''],
      case when contains(rest, '#') then ['fragment'] else [] end)))) else [] end as tokens
  from parts
), labelled as (
  select tokens, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as label from ruled where rule is not null
), subsets as (
  select label, list_filter(tokens, lambda t, i: (mask >> (i - 1)) & 1 = 1) as tokens
  from (select label, tokens, unnest(range(1, (1::bigint << len(tokens)))) as mask from labelled)
), totals as (
  select tokens, count(*) as n, count(*) filter (where label = 'block') as block, count(*) filter (where label = 'allow') as allow from subsets group by tokens
), found as (
  select tokens, v.verdict, v.support, v.support / n as confidence
  from totals, lateral (select unnest(['block', 'allow']) as verdict, unnest([block, allow]) as support) v
  where v.support > 0 and v.support >= ceil(0.005 * (select count(*) from labelled))
), shorter as (
  select tokens, verdict, confidence, unnest([list_filter(tokens, lambda t: t <> w) for w in tokens]) as less from found where len(tokens) > 1
), kept as (
  select * from found f where confidence >= 0.9 and not exists (
    select 1 from shorter s join found g on g.tokens = s.less and g.verdict = s.verdict
    where s.tokens = f.tokens and s.verdict = f.verdict and g.confidence >= s.confidence)
), best as (
  select r.tokens, max({'c': k.confidence, 's': k.support, 'z': len(k.tokens), 't': k.tokens, 'v': k.verdict}) as best
  from (select distinct tokens from ruled where rule is null) r join kept k on list_has_all(r.tokens, k.tokens) group by r.tokens
)
select r.page_id, r.host, r.path, r.rule, case when r.rule in ('net/', 'example.com/de/') then 'block' when r.rule is not null then 'allow'
    else coalesce(b.best.v, (select max({'n': n, 'l': label}).l from (select label, count(*) as n from labelled group by label)), 'allow') end as verdict,
  case when r.rule is null then array_to_string(b.best.t, ' ') end as mined
from ruled r left join best b on b.tokens = r.tokens
"""
