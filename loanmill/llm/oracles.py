"""SQL for DuckDB of the operators that SQL can state, over the same tables."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

TOP_K = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 50 = 0
),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

NEAR_DEDUP = f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) as ws from documents
),
shingles as (
  select distinct doc_id, case when len(ws) < 3 then ws else ws[s:s + 2] end as shingle
  from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) as s from words where len(ws) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by 1),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2
),
links as (
  select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c.n >= 85 * (x.n + y.n - c.n)
),
reached as (
  select doc_id as node, doc_id as other from words
  union
  select r.node, l.b from reached r join links l on l.a = r.other
),
components as (select node, min(other) as component_id from reached group by 1)
select w.doc_id, coalesce(n, 0) as n_shingles, component_id, component_id = w.doc_id as kept
from words w left join sizes s on s.doc_id = w.doc_id join components on node = w.doc_id
"""

WORD_REPEATS = f"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) as ws from documents
),
windows as (
  select doc_id, s, array_to_string(ws[s:s + 19], ' ') as w
  from (select doc_id, ws, unnest(generate_series(1, len(ws) - 19)) as s from words)
),
later as (
  select doc_id, s from (select doc_id, s, row_number() over (partition by w order by doc_id, s) as r from windows)
  where r > 1
),
gone as (select distinct doc_id, unnest(generate_series(s, s + 19)) as p from later),
placed as (select doc_id, unnest(ws) as word, unnest(generate_series(1, len(ws))) as p from words),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as kept
  from placed anti join gone using (doc_id, p) group by 1
)
select w.doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words w left join kept k on k.doc_id = w.doc_id
"""

BYTE_REPEATS = """
with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
strings as (
  select doc_id, s, substr(h, 2 * s - 1, 100) as w
  from (select doc_id, h, unnest(generate_series(1, length(h) // 2 - 49)) as s from bytes)
),
later as (
  select doc_id, s from (select doc_id, s, min(doc_id) over (partition by w) as first from strings) where doc_id > first
),
marked as (
  select doc_id, s, case when s > lag(s) over (partition by doc_id order by s) + 50 then 1 else 0 end as new from later
),
numbered as (select doc_id, s, sum(new) over (partition by doc_id order by s) as run from marked),
runs as (select doc_id, min(s) as a, max(s) + 50 as b from numbered group by doc_id, run),
edges as (
  select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 1) as before from runs
),
pieces as (
  select e.doc_id, a as place, substr(h, 2 * before - 1, 2 * (a - before)) as piece from edges e join bytes using (doc_id)
  union all
  select doc_id, length(h), substr(h, 2 * coalesce(last, 1) - 1)
  from bytes left join (select doc_id, max(b) as last from runs group by 1) using (doc_id)
),
kept as (select doc_id, string_agg(piece, '' order by place) as k from pieces group by 1),
counts as (select doc_id, sum(b - a) as n, count(*) as spans from runs group by 1)
select doc_id, length(h) // 2 as n_bytes, coalesce(n, 0)::bigint as n_removed, coalesce(spans, 0) as n_spans,
  sha256(unhex(k)) as kept_sha256
from bytes join kept using (doc_id) left join counts using (doc_id)
"""


def _lloyd(rounds: int = 4) -> str:
    """Codebooks of 256 entries for four parts; doubles hold all numbers here
    exactly."""
    steps = [
        """
kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (
  select vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] as p from kept, range(4) as t(part)
),
book0 as materialized (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, p as e
  from parts where vec_id in (select vec_id from kept order by vec_id limit 256)
)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""
code{r} as materialized (
  select vec_id, part, any_value(p) as p, min({{'dist': list_dot_product(p, p) + list_dot_product(e, e)
    - 2 * list_dot_product(p, e), 'entry': entry}}) as best
  from parts join book{r} using (part) group by 1, 2
)"""
        )
        if r < rounds:
            steps.append(
                f"""
mean{r} as (
  select part, entry, list(m order by place) as e from (
    select part, best.entry as entry, place, floor(sum(x) / count(*)) as m
    from (select part, best, unnest(p) as x, unnest(range(len(p))) as place from code{r}) group by 1, 2, 3)
  group by 1, 2
),
book{r + 1} as materialized (
  select part, entry, coalesce(m.e, b.e) as e from book{r} b left join mean{r} m using (part, entry)
)"""
            )
    return (
        "with"
        + ",".join(steps)
        + f""",
coded as (
  select vec_id, string_agg(printf('%02x', best.entry), '' order by part) as code, sum(best.dist)::bigint as error
  from code{rounds} group by 1
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(array_to_string(e::bigint[], ','), ',' order by part, entry)) from book{rounds}) as codebooks_sha256
from coded join kept using (vec_id)"""
    )



def _merkle(source_levels: int = 6, levels: int = 4) -> str:
    """Parents of sixteen, so many levels over a source's rows and over sources
    (a tree that has one node left stays as it is)."""

    def told(value: str) -> str:
        return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"

    fields = " || ".join(told(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""
crcs as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, bit: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc_of
),
hashed as (
  select doc_id, coalesce('=' || source, '-') as tree, sha256({fields} || {told("text")}) as leaf,
    sha256({fields} || {told(lower)}) as other,
    xor(list_reduce([4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
      lambda crc, b: xor(crc >> 8, crc_of[(xor(crc, b) & 255) + 1])), 4294967295) % 5 = 0 as changed
  from documents, crcs
),
placed as materialized (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos from hashed
),
nodes0 as (select tree, pos, leaf as node from placed),
rows0 as (
  select doc_id, leaf, tree, pos, '' as proof, case when changed then other else leaf end as folded from placed
)"""
    ]

    def climb(first: int, last: int) -> None:
        for k in range(first, last):
            steps.append(
                f"""
runs{k} as materialized (
  select tree, pos // 16 as up, list(node order by pos) as kids, any_value(n) as n
  from (select *, count(*) over (partition by tree) as n from nodes{k}) group by 1, 2
),
nodes{k + 1} as (
  select tree, up as pos, case when n > 1 then sha256(array_to_string(kids, '')) else kids[1] end as node from runs{k}
),
rows{k + 1} as materialized (
  select r.* replace (pos // 16 as pos,
    proof || array_to_string(kids[1 : pos % 16] || kids[pos % 16 + 2 :], '') as proof,
    case when n > 1 then sha256(array_to_string(kids[1 : pos % 16] || [folded] || kids[pos % 16 + 2 :], ''))
      else folded end as folded)
  from rows{k} r join runs{k} u on u.tree = r.tree and u.up = r.pos // 16
)"""
            )

    climb(0, source_levels)
    top, over = source_levels, source_levels + 1
    steps.append(
        f"""
ranked as (select tree as name, node as subroot, row_number() over (order by tree) - 1 as pos from nodes{top}),
nodes{over} as (select '' as tree, pos, subroot as node from ranked),
rows{over} as (
  select doc_id, leaf, subroot, '' as tree, ranked.pos, proof, folded from rows{top} join ranked on name = tree
)"""
    )
    climb(over, over + levels)
    return (
        "with"
        + ",".join(steps)
        + f"""
select doc_id, leaf, subroot, node as root, sha256(proof) as proof_sha256, folded as folded_root, folded = node as verified
from rows{over + levels}, nodes{over + levels}"""
    )


ORACLES: dict[str, str] = {
    "op3_topk": TOP_K,
    "op5_near_dedup": NEAR_DEDUP,
    "op8_substring_dedup": WORD_REPEATS,
    "op10_suffix_array_dedup": BYTE_REPEATS,
    "op11_manifest": _merkle(),
    "op13_vector_codes": _lloyd(),
}
