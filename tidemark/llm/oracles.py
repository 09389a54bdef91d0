"""SQL counterparts of the operators that SQL can express on whole tables; the others are tested against brute force."""

from __future__ import annotations

import string

#: The table of CRC-32 (reflected polynomial 0xEDB88320), made by its rule.
_CRC_TABLE = """crc_table as (
  select list(c order by b) as t from (
    select b, list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, b) as c
    from range(256) r(b))
)"""


def _crc32(bytes_of: str) -> str:
    """Unsigned CRC-32 of a list of bytes, with ``crc_table`` in scope."""
    return f"xor(4294967295, list_reduce({bytes_of}, lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295))"


def _points(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: unicode(c)::bigint)"


def _merkle_levels(prefix: str, levels: int) -> str:
    """Nodes and sibling steps of a tree over ``{prefix}0 (g, r, h)``, and the fold of ``{prefix}f0 (g, r, acc, proof, ...)``."""
    parts = []
    for k in range(1, levels + 1):
        parts.append(f"""{prefix}c{k} as (select *, count(*) over (partition by g) as c from {prefix}{k - 1}),
{prefix}s{k} as (
  select g, r, c > 1 as step,
    coalesce(string_agg(h, '') over (partition by g, r // 8 order by r rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(h, '') over (partition by g, r // 8 order by r rows between 1 following and unbounded following), '') as after
  from {prefix}c{k}
),
{prefix}{k} as (
  select g, r // 8 as r, case when max(c) = 1 then any_value(h) else sha256(string_agg(h, '' order by r)) end as h
  from {prefix}c{k} group by g, r // 8
),
{prefix}f{k} as (
  select f.* replace (f.r // 8 as r, case when step then sha256(before || acc || after) else acc end as acc, f.proof || before || after as proof)
  from {prefix}f{k - 1} f join {prefix}s{k} s on f.g is not distinct from s.g and f.r = s.r
)""")
    return ",\n".join(parts)


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Seven levels hold two million documents of a language, four levels 4,096 languages.
_MERKLE = f"""
with {_CRC_TABLE}, leaves as (
  select doc_id, lang, {_leaf("text")} as leaf,
    case when {_crc32(_points("doc_id::varchar"))} % 3 = 0
      then {_leaf(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} end as tampered
  from documents, crc_table
), ranked as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place from leaves
),
a0 as (select lang as g, place as r, leaf as h from ranked),
af0 as (select lang as g, place as r, doc_id, leaf, coalesce(tampered, leaf) as acc, '' as proof from ranked),
{_merkle_levels("a", 7)},
tops as (select g as lang, h as subroot, row_number() over (order by g nulls first) - 1 as place from a7),
b0 as (select 0 as g, place as r, subroot as h from tops),
bf0 as (select 0 as g, place as r, doc_id, leaf, subroot, acc, proof from af7 join tops on af7.g is not distinct from tops.lang),
{_merkle_levels("b", 4)}
select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, acc as folded_root, acc = h as verified
from bf4 join b4 on true
"""

_UTF8 = "flatten(list_transform({points}, lambda c: case when c < 128 then [c] else [192 + (c >> 6), 128 + (c & 63)] end))"

#: All characters hashed here are below U+0100.
_SPELLING = f"""
with recursive {_CRC_TABLE}, runs as (
  select doc_id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents)
  group by all
), hashed as (
  select run, n, {_crc32(_UTF8.format(points=_points("doc_id::varchar || ':' || run")))} as h from runs, crc_table
), words as (
  select word, sum(n)::bigint as n from (
    select case when h % 199 = 0 then left(run, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as word, n from hashed
  ) where length(word) >= 6 group by word having sum(n) >= 5
), cuts as (
  select word, n, i, left(word, i::int) || substring(word, i::int + 2) as cut from (select *, unnest(range(length(word))) as i from words)
), pairs as (
  select a.word, b.word as other, b.n as other_n from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
  union
  select c.word, w.word, w.n from cuts c join words w on w.word = c.cut
  union
  select w.word, c.word, c.n from cuts c join words w on w.word = c.cut
), best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from pairs group by word
), formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 5 * w.n then other end as form, case when other_n >= 5 * w.n then other_n end as form_n
  from words w left join best b on w.word = b.word
), chains as (
  select word, word as root, 0 as steps from formed
  union all
  select chains.word, formed.form, steps + 1 from chains join formed on formed.word = chains.root where formed.form is not null
), ends as (
  select word, arg_max(root, steps) as root from chains group by word
)
select formed.word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n from formed join ends on formed.word = ends.word
"""

SQL: dict[str, str] = {
    "op11_merkle": _MERKLE,
    "op13_spelling": _SPELLING,
    "op2_embedding_dedup": """
with recursive v as (
  select distinct vec_id, embedding::double[] as e,
    coalesce(len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as ok
  from embeddings
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.ok and b.ok and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95
), reach as (
  select vec_id as node, vec_id as least from v
  union
  select links.b, reach.least from reach join links on links.a = reach.node
), components as (
  select node, min(least) as component_id from reach group by node
), counted as (
  select a, count(*) as n from links group by a
)
select v.vec_id, coalesce(n, 0)::bigint as n_links, component_id, v.vec_id = component_id as kept
from v join components on node = v.vec_id left join counted on a = v.vec_id
""",
}
