"""What DuckDB gives for the queries that SQL can express, written on its own from the contracts."""

from __future__ import annotations

from .divergence_rules import COMMON, MIN_REFERENCE, MIN_WORDS, MOST_CLASS_DISTANCE, MOST_WORD_DIVERGENCE, SAMPLING

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def _words(pattern: str, text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


_LOWERED = f"translate(text, '{_UPPER}', '{_LOWER}')"

WINNOWING = f"""
with d as (
  select doc_id, {_words(_ALNUM, _LOWERED)} as w from documents
), b as (
  select cast(item_id as varchar) as item_id, {_words(_ALNUM, _LOWERED)} as w from benchmark where item_id is not null
), sized as (
  select item_id, w, least(len(w), 10) as n from b where len(w) > 0
), item_windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)
), doc_windows as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from sized))
), hits as (
  select doc_id, i, n, item_id from doc_windows join item_windows using (n, win)
), words_hit as (
  select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from hits) group by doc_id
), items_hit as (
  select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words_hit using (doc_id) left join items_hit using (doc_id)"""


SUPER_KMERS = f"""
with d as (
  select doc_id, {_words(_SPACED, "text")} as w from documents
), p as (
  select doc_id, w, unnest(range(1, len(w) + 1)) as i from d
), k as (
  select doc_id, i, w[i] as word, case when i <= len(w) - 12 then array_to_string(w[i:i + 12], ' ') end as win from p
), f as (
  select win, min(doc_id) as owner from k where win is not null group by win
), r as (
  select doc_id, i, word, max(cast(coalesce(owner < doc_id, false) as int))
    over (partition by doc_id order by i rows between 12 preceding and current row) as gone
  from k left join f using (win)
), s as (
  select doc_id, sum(gone) as n_removed, string_agg(case when gone = 0 then word end, ' ' order by i) as kept from r group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join s using (doc_id)"""


RUN_LENGTH = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), k as (
  select doc_id, i, substr(h, 2 * i - 1, 2) as b, case when i <= n - 49 then substr(h, 2 * i - 1, 100) end as win
  from (select doc_id, h, n, unnest(range(1, n + 1)) as i from d)
), f as (
  select win, min(doc_id) as owner from k where win is not null group by win
), r as (
  select doc_id, i, b, max(cast(coalesce(owner < doc_id, false) as int))
    over (partition by doc_id order by i rows between 49 preceding and current row) as gone
  from k left join f using (win)
), t as (
  select doc_id, i, b, gone, gone = 1 and coalesce(lag(gone) over (partition by doc_id order by i), 0) = 0 as opens from r
), s as (
  select doc_id, sum(gone) as n_removed, count(case when opens then 1 end) as n_spans,
    string_agg(case when gone = 0 then b end, '' order by i) as kept
  from t group by doc_id
)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, ''))) as kept_sha256
from d left join s using (doc_id)"""


def _count(pattern: str) -> str:
    return f"length(regexp_replace(t, '[^{pattern}]', '', 'g'))"


_DISTANCE = """sqrt(greatest(sum((case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end
    + case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end) / 2), 0))"""

DIVERGENCE = f"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(text, '') as t, {_words(_SPACED, "text")} as w from documents
), base as (
  select doc_id, lang, t, w, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars, {_count("#*$%&|<>")} as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from d
), win as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') as win, i <= len(w) - 7 as whole
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d)
), again as (
  select doc_id, i, case when whole and count(*) over (partition by doc_id, win, whole) > 1 then 1 else 0 end as twice from win
), covered as (
  select doc_id, i, max(twice) over (partition by doc_id order by i rows between 7 preceding and current row) as hit from again
), repeats as (
  select doc_id, cast(sum(hit) as bigint) as n_repeat_words from covered group by doc_id
), classes as (
  select doc_id, lang, unnest(range(7)) as bin,
    unnest([length(t) - word_chars, n_symbols, {_count("A-Z")}, {_count("0-9")}, {_count(".,;:!?")}, {_count("!?")},
      greatest(length(t) - (length(t) - word_chars + n_symbols + {_count("A-Z")} + {_count("0-9")} + {_count(".,;:!?")} + {_count("!?")}), 0)]) as x
  from base
), class_reference as (
  select lang, bin, sum(x) / greatest(sum(sum(x)) over (partition by lang), 1) as q from classes group by lang, bin
), class_shares as (
  select doc_id, lang, bin, x / greatest(sum(x) over (partition by doc_id), 1) as p from classes
), class_distance as (
  select doc_id, {_DISTANCE} as class_distance from class_shares join class_reference using (lang, bin) group by doc_id
), words as (
  select doc_id, lang, word, count(*) as x from (select doc_id, lang, unnest(w) as word from base)
  group by doc_id, lang, word
), ranked as (
  select lang, word, sum(x) as x, row_number() over (partition by lang order by sum(x) desc, word) as place from words group by lang, word
), top as (
  select lang, word, x from ranked where place <= {COMMON}
), sizes as (
  select lang, sum(n_words) as n from base group by lang
), word_reference as (
  select lang, word, x / greatest(n, 1) as q from top join sizes using (lang)
  union all
  select lang, null, (n - coalesce((select sum(x) from top where top.lang = sizes.lang), 0)) / greatest(n, 1) from sizes
), found as (
  select words.doc_id, words.lang, words.word, words.x from words join top using (lang, word)
), word_counts as (
  select doc_id, lang, word, x from found
  union all
  select doc_id, lang, null, n_words - coalesce(s, 0) from base left join (select doc_id, sum(x) as s from found group by doc_id) using (doc_id)
), word_shares as (
  select base.doc_id, r.q, coalesce(c.x, 0) / greatest(n_words, 1) as p
  from base join word_reference r using (lang) left join word_counts c on c.doc_id = base.doc_id and c.word is not distinct from r.word
), word_distance as (
  select doc_id, {_DISTANCE} as word_distance from word_shares group by doc_id
)
select doc_id, n_words, word_chars, n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words,
  n_words < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * n_words)
    and not (n_words >= {MIN_WORDS} and n >= {MIN_REFERENCE}
      and (class_distance > {MOST_CLASS_DISTANCE} or word_distance * word_distance - {SAMPLING} / n_words > {MOST_WORD_DIVERGENCE})) as kept
from base left join repeats using (doc_id) join class_distance using (doc_id) join word_distance using (doc_id) join sizes using (lang)"""

BOND_SCAN = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as vector
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same, cast(list_inner_product(a.vector, r.vector) as bigint) as score
  from v a join v r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select p.anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as place
  from positives p join scored s on p.anchor_id = s.anchor_id and not same
    and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
)
select anchor_id, positive_id, cast(place as int) as rank, negative_id, positive_score, negative_score from ranked where place <= 5"""

# the 256 remainders of CRC-32, by its rule, as a list t
_REMAINDERS = """(
  select list(list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, n) order by n) as t
  from (select unnest(range(256)) as n)
)"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's bytes, folded byte by byte with the list t."""
    value = "instr('0123456789ABCDEF', p[1]) * 16 + instr('0123456789ABCDEF', p[2]) - 17"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: {value})"
    return f"xor(list_reduce({octets}, lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295), 4294967295)"


BYTE_SHARDS = f"""
with d as (
  select doc_id, strlen(coalesce(text, '')) + 16 as size, cast({_crc32("coalesce(text, '')")} as bigint) as text_crc32
  from documents, {_REMAINDERS}
), placed as (
  select *, sum(size) over (order by doc_id) - size as start, sum(size) over () as total, row_number() over (order by doc_id) as n from d
), cut as (
  select *, cast(least(39, ((2 * start + size) * 40) // (2 * total)) as int) as shard from placed
)
select doc_id, cast(size as bigint) as size, text_crc32, 'bytes' as law, shard,
  cast(row_number() over (partition by shard order by n) - 1 as bigint) as slot, cast(null as int) as grown_shard
from cut"""


def _leaf(text: str) -> str:
    fields = (f"coalesce(strlen(cast({x} as varchar)) || ':' || cast({x} as varchar), '-')" for x in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


MERKLE_CLIMB = f"""
with recursive leaves as (
  select doc_id, source, {_leaf("text")} as leaf,
    case when {_crc32("cast(doc_id as varchar)")} % 5 = 0 then {_leaf(_LOWERED)} else {_leaf("text")} end as shown
  from documents, {_REMAINDERS}
), placed as (
  select *, dense_rank() over (order by source nulls first) - 1 as tree,
    row_number() over (partition by source order by doc_id) - 1 as idx, count(*) over (partition by source) as n
  from leaves
), nodes as (
  select tree, 0 as level, idx, n, leaf as hash from placed
  union all
  select tree, level + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(hash, '' order by idx))
  from nodes where n > 1 group by tree, level, idx // 16
), tops as (
  select tree || '/' || level || '/' || idx as id, 0 as level, tree as idx, count(*) over () as n, hash from nodes where n = 1
  union all
  select 'top/' || (level + 1) || '/' || (idx // 16), level + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(hash, '' order by idx))
  from tops where n > 1 group by level, idx // 16
), kids as (
  select cast(tree as varchar) as tree, tree || '/' || level || '/' || idx as id, level, idx, hash from nodes where n > 1
  union all
  select 'top', id, level, idx, hash from tops where n > 1
), links as (
  select id, tree || '/' || (level + 1) || '/' || (idx // 16) as parent,
    coalesce(string_agg(hash, '') over (run rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(hash, '') over (run rows between 1 following and unbounded following), '') as r
  from kids window run as (partition by tree, level, idx // 16 order by idx)
), climb as (
  select doc_id, tree || '/0/' || idx as id, shown as folded, '' as proof from placed
  union all
  select doc_id, parent, sha256(l || folded || r), proof || l || r from climb join links using (id)
)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified
from climb join (select id, hash as root from tops where n = 1) using (id)
join placed using (doc_id) join (select tree, hash as subroot from nodes where n = 1) using (tree)"""

ORACLES = {
    "op1_winnowing": WINNOWING,
    "op2_run_length_bwt": RUN_LENGTH,
    "op6_super_kmers": SUPER_KMERS,
    "op8_divergence_rules": DIVERGENCE,
    "op11_bond_scan": BOND_SCAN,
    "op12_byte_shards": BYTE_SHARDS,
    "op13_merkle_climb": MERKLE_CLIMB,
}
