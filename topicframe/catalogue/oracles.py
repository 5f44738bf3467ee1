"""SQL side: what DuckDB gives for each query, written on its own from the rules."""

from __future__ import annotations

from .. import constants as C
from .queries import BROKER, CONSUMER
from .views import NAMESPACE, OWN_SCHEMAS

_M = f"""
m as (
  select event_id as off, '{NAMESPACE}' || event_type as topic, cast(user_id % 4 as bigint) as part,
    ts, event_type as etype, case when user_id % 4 = 0 then 'AVRO' else 'JSON' end as stype,
    'v' || cast(event_id // 5000 + 1 as varchar) as sdef,
    case when user_id % 10 = 0 then null else cast(user_id as varchar) end as k,
    case when user_id % 3 = 0 then null else 't' || cast(user_id % 3 as varchar) end as tier,
    case when event_id % 97 = 0 then '' when event_id % 53 = 0 then 'Malformed message'
      else cast(user_id as varchar) || ',' || cast(cast(round(value * 100) as bigint) as varchar) end as body
  from events
)"""


def _batches(size: int, source: str = "m") -> str:
    return f"""
b as (
  select *, (row_number() over (partition by topic, part order by off) - 1) // {size} as batch_no from {source}
)"""


def _segments(segment: int = 65536, size: int = 100, source: str = "m") -> str:
    return f"""
b as (
  select *, seg * {-(-segment // size)} + (row_number() over (partition by topic, part, seg order by off) - 1) // {size} as batch_no
  from (select *, off // {segment} as seg from {source})
)"""


_B = _batches(100)

# runs by tier inside a batch, for records by topic and schema too
def _runs(schema: str) -> str:
    return f"""
c as (
  select *, {schema} as schema from b
), f as (
  select *, case when row_number() over w = 1 or tier is distinct from lag(tier) over w
      or schema is distinct from lag(schema) over w then 1 else 0 end as chg
  from c window w as (partition by topic, part, batch_no order by off)
), r as (
  select *, cast(sum(chg) over (partition by topic, part, batch_no order by off
      rows between unbounded preceding and current row) as bigint) as run from f
)"""


_R = _runs("0")
_RR = _runs("case when stype = 'AVRO' then sdef end")

_CONTENT = """
s as (
  select *, sum(case when body <> '' then 1 else 0 end) over (partition by topic, part, batch_no, run order by off
      rows between unbounded preceding and current row) as seen from r
), g as (
  select topic, part, batch_no, run, min(tier) as tier, min(off) as first_off, max(off) as last_off,
    count(*) as n, count(case when body <> '' then 1 end) as message_count,
    coalesce(string_agg(case when seen > 0 then body end, '***' order by off), '') as content
  from s group by topic, part, batch_no, run
)"""

_BUNDLES = f"with {_M}, {_B}, {_R}, {_CONTENT}"

# messages of up to twenty lines, and their records
_LINES = f"""
with {_M}, {_batches(20)}, h as (
  select *, min(case when body <> '' then off end) over (partition by topic, part, batch_no) as filled,
    min(off) over (partition by topic, part, batch_no) as mid,
    body <> 'Malformed message' as good,
    try_cast(split_part(body, ',', 1) as bigint) as uid
  from b
), l as (
  select topic, part, batch_no, mid, ts, body, good, uid,
    row_number() over (partition by topic, part, batch_no order by off) - 1 as pos
  from h where body <> ''
), bad as (
  select topic, part, batch_no, min(case when not good then pos end) as bad from l group by topic, part, batch_no
), text as (
  select topic, part, batch_no, min(mid) as off, string_agg(case when off >= filled then body end, chr(10) order by off) as data
  from h where filled is not null group by topic, part, batch_no
), kept as (
  select topic, part, batch_no, mid as off, count(case when bad is null or pos < bad then 1 end) as kept,
    coalesce(cast(sum(case when bad is null or pos < bad then uid end) as bigint), 0) as uid_sum,
    max(bad) is not null as failed, count(*) as n
  from l join bad using (topic, part, batch_no) group by topic, part, batch_no, mid
)"""

_TOKENS = """
with cut as (
  select doc_id, lang, source, string_split(text, chr(10)) as t from documents
), tok as (
  select doc_id, lang, source, case when t[len(t)] = '' then t[1:len(t) - 1] else t end as t from cut
), piece as (
  select doc_id, lang, source, unnest(t) as data, unnest(range(len(t))) as pos from tok
)"""

_O = """
o as (
  select o_orderkey as orderkey, o_custkey as custkey, o_orderstatus as status, o_orderpriority as priority,
    case when o_orderstatus <> 'P' then o_orderstatus end as shown,
    case when o_custkey % 7 <> 0 then cast(o_custkey as varchar) end as cust,
    case when o_custkey % 5 = 0 then 'fallback' end as fallback,
    'orders-' || o_orderstatus as topic, cast(o_custkey % 4 as bigint) as part, o_orderkey as off
  from orders
), w as (
  select *, '{"orderkey":' || orderkey || ',"custkey":' || custkey || ',"status":"' || status
      || '","priority":"' || priority || '"}' as json,
    '"' || orderkey || '","' || custkey || '","' || status || '","' || priority || '"' || chr(10) as csv
  from o
)"""

_SUM = "cast(sum(('0x' || substr(md5({0}), 1, 8))::bigint) as bigint) as checksum"


def _bucket(key: str, n: int) -> str:
    return f"('0x' || substr(md5({key}), 1, 8))::bigint % {n}"


# chunks of 500 bytes, the first of German documents lost
_CHUNKS = """
with e as (
  select doc_id, lang, encode(text) as data, greatest(1, (octet_length(encode(text)) + 499) // 500) as chunk_count from documents
), c as (
  select doc_id, lang, chunk_count, data, unnest(range(chunk_count)) as chunk_no from e
), lost as (
  select * from c where not (lang = 'de' and chunk_no = 0)
), state as (
  select doc_id, count(*) as received, max(chunk_count) as chunk_count from lost group by doc_id
)"""


# the runs of a record consumer that mapped scope makes of the same batches
_RECORD_RUNS = """
rc as (
  select *, case when stype = 'AVRO' then sdef end as rschema from b
), rf as (
  select *, case when row_number() over w = 1 or tier is distinct from lag(tier) over w
      or rschema is distinct from lag(rschema) over w then 1 else 0 end as rchg
  from rc window w as (partition by topic, part, batch_no order by off)
), rr as (
  select *, sum(rchg) over (partition by topic, part, batch_no order by off rows between unbounded preceding and current row) as rrun from rf
), q as (
  select topic, part, batch_no, rrun, min(off) as lo, count(case when body not in ('', 'Malformed message') then 1 end) as good
  from rr group by topic, part, batch_no, rrun
)"""


# messages with schemas of their own: what each carries, what of it is written, whether it fails
_OWN = f"""
m as (
  select event_id as off, '{NAMESPACE}' || event_type as topic, cast(user_id % 4 as bigint) as part, event_type as etype,
    case when user_id % 4 = 0 then 'AVRO' else 'JSON' end as stype,
    case when user_id % 3 = 0 then null else 't' || cast(user_id % 3 as varchar) end as tier, event_id % 41 = 0 as odd,
    case when event_id % 29 = 0 then null when event_id % 10 = 9 then event_id % 20 // 10 + 2 else event_id % 3 // 2 end as kind,
    cast(user_id as varchar) as uid, case when user_id % 5 <> 0 then cast(cast(round(value * 100) as bigint) as varchar) end as cents
  from events
), t as (
  select unnest(range(4)) as kind, unnest([{", ".join(f"'{x}'" for x in OWN_SCHEMAS)}]) as sdef
), own as (
  select m.*, t.sdef from m left join t using (kind)
)"""
_OWN_JSON = """
b as (
  select *, (row_number() over (partition by topic, part order by off) - 1) // 100 as batch_no,
    '[{"kind": "' || etype || '", "uid": ' || uid || ', "cents": ' || coalesce(cents, 'null') || ', "tags": ["a", "' || off || '"]}, {"uid":'
      || case when odd then '"none"' else uid end || ',"tags":[],"cents":' || coalesce(cents, 'null') || '}]' as body,
    case when kind is null or kind > 1 then '' else
      case kind when 0 then '{"uid":' || uid || ',"kind":"' || etype || '"}'
        else '{"uid":' || uid || coalesce(',"cents":' || cents, '') || ',"tags":["a","' || off || '"]}' end
      || case when odd then '' when kind = 0 then '{"uid":' || uid || '}'
        else '{"uid":' || uid || coalesce(',"cents":' || cents, '') || ',"tags":[]}' end end as written,
    case when kind is null or kind > 1 then 0 when odd then 1 else 2 end as kept,
    kind is null or kind > 1 or odd as failed
  from own
)"""
_OWN_CSV = """
b as (
  select *, (row_number() over (partition by topic, part order by off) - 1) // 100 as batch_no,
    case when odd then 'none' else uid end || ',' || case when off % 3 = 0 then etype else coalesce(cents, '') end as body,
    case when kind = 0 and not odd then '"' || uid || '","' || case when off % 3 = 0 then etype else coalesce(cents, '') end || '"' || chr(10) else '' end as written,
    case when kind = 0 and not odd then 1 else 0 end as kept,
    kind is null or kind > 0 or odd as failed
  from own
)"""


def _own_bundles(messages: str) -> str:
    return f"""with {_OWN}, {messages}, {_RR}, q as (
  select topic, part, batch_no, run, min(schema) as schema, count(*) as n, sum(kept) as kept, count(case when failed then 1 end) as bad,
    string_agg(written, '' order by off) as lines, string_agg(case when failed then body end, '***' order by off) as whole
  from r group by topic, part, batch_no, run
)
select topic, part, batch_no, run as bundle_no, '{C.SUCCESS}' as relationship, cast(kept as bigint) as record_count,
  n as message_count, schema, md5(lines) as digest from q where kept > 0
union all
select topic, part, batch_no, run, '{C.PARSE_FAILURE}', 0, bad, null, md5(whole) from q where bad > 0"""


def _entries(where: str, name: str, value: str) -> str:
    return f"with {_M} select off, '{name}' as name, {value} as value from m where {where}"


ORACLES: dict[str, str] = {
    "consume_bundles": f"""{_BUNDLES}
select topic, part, batch_no, run, tier, message_count, last_off as cum_ack, md5(content) as digest
from g where message_count > 0""",
    "consume_short_segments": f"""with {_M}, {_segments(4096)}, {_R}, {_CONTENT}
select topic, part, batch_no, run, message_count, first_off, md5(content) as digest from g where message_count > 0""",
    "consume_full_batches": f"""{_BUNDLES}
select topic, part, batch_no, run, message_count, first_off, md5(content) as digest from g where message_count > 0""",
    "consume_sparse_offsets": f"""{_BUNDLES}
select topic, part, batch_no, run, message_count, first_off, md5(content) as digest from g where message_count > 0""",
    "consume_attributes": f"""with {_M}, {_B}, {_R}, {_CONTENT}, {_RECORD_RUNS}, heads as (
  select 'mapped' as scope, 'bytes' as consumer, topic, part, first_off, message_count as n from g where message_count > 0
  union all select 'all', 'bytes', topic, part, off, 1 from m where body <> ''
  union all select 'mapped', 'records', topic, part, lo, good from q where good > 0
  union all select 'all', 'records', topic, part, off, 1 from m where body not in ('', 'Malformed message')
), h as (
  select scope, consumer, topic, part, first_off, heads.n as n, m.off, m.tier, m.etype, m.stype, m.sdef
  from heads join m using (topic, part) where m.off = first_off
), named as (
  select topic, part, first_off, scope, consumer, unnest(['tier', '{C.MESSAGE_ID_ATTRIBUTE}', '{C.PROPERTY_PREFIX}tier', '{C.PROPERTY_PREFIX}etype',
    '{C.TOPIC_ATTRIBUTE}', '{C.SCHEMA_ATTRIBUTE}', case when consumer = 'bytes' then '{C.MESSAGE_COUNT_ATTRIBUTE}' else '{C.RECORD_COUNT_ATTRIBUTE}' end]) as name,
  unnest([tier, off || ':' || part, tier, etype, case when consumer = 'records' then topic end,
    case when consumer = 'records' and stype = 'AVRO' then sdef end, cast(n as varchar)]) as value
from h
)
select * from named where value is not null""",
    "json_lines": f"""with {_M}, {_batches(10)}, t as (
  select topic, part, batch_no, min(off) as first_off, count(*) as n, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as k_sum
  from b join events on event_id = off group by topic, part, batch_no
)
select topic, first_off, n, k_sum, first_off % 3 <> 2 as failed from t""",
    "csv_roundtrip": """select doc_id, case when doc_id % 10 <> 0 then md5(text) end as digest,
  'say "' || lang || '", ' || source as quoted, false as corrupt from documents""",
    "consume_record_bundles": f"""with {_M}, {_B}, {_RR}, q as (
  select topic, part, batch_no, run, min(schema) as schema, min(off) as lo, count(*) as n,
    count(case when body not in ('', 'Malformed message') then 1 end) as good,
    count(case when body = 'Malformed message' then 1 end) as bad,
    string_agg(case when body not in ('', 'Malformed message')
      then '"' || split_part(body, ',', 1) || '","' || split_part(body, ',', 2) || '"' || chr(10) end, '' order by off) as lines,
    string_agg(case when body = 'Malformed message' then body end, '***' order by off) as whole
  from r group by topic, part, batch_no, run
)
select topic, part, batch_no, run as bundle_no, '{C.SUCCESS}' as relationship, good as record_count,
  n as message_count, schema, md5(lines) as digest from q where good > 0
union all
select topic, part, batch_no, run, '{C.PARSE_FAILURE}', 0, bad, null, md5(whole) from q where bad > 0""",
    "consume_own_schemas": _own_bundles(_OWN_JSON),
    "consume_own_csv": _own_bundles(_OWN_CSV),
    "unreadable_schemas": f"""with {_OWN}
select topic, off, case when kind < 2 then '{C.SUCCESS}' else '{C.PARSE_FAILURE}' end as relationship from own""",
    "topic_list": f"""with {_M} select topic, part, off, md5(body) as digest from m
where topic in ('{NAMESPACE}click', '{NAMESPACE}view')""",
    "topic_pattern": f"""with {_M} select topic, part, off, md5(body) as digest from m
where regexp_full_match(topic, '{NAMESPACE}(p|s).*')""",
    "start_position": f"""with {_M}, ends as (
  select topic, part, max(off) as position from m where ts < timestamp '2024-01-15' group by topic, part
)
select 'earliest' as mode, topic, count(*) as n, min(off) as lo from m group by topic
union all
select 'latest', topic, count(*), min(off) from m left join ends using (topic, part)
where off > coalesce(position, -1) group by topic""",
    "resume_cursor": f"""with {_M}, ends as (
  select topic, part, max(off) as position from m where ts < timestamp '2024-01-25' group by topic, part
)
select topic, part, count(*) as n, min(off) as lo from m left join ends using (topic, part)
where off > coalesce(position, -1) group by topic, part""",
    "receive_batches": f"""with {_M}, {_B}
select topic, part, batch_no, count(*) as n, min(off) as lo, max(off) as hi from b group by topic, part, batch_no""",
    "parse_records": f"""with {_M}
select off, cast(0 as bigint) as pos, try_cast(split_part(body, ',', 1) as bigint) as uid,
  try_cast(split_part(body, ',', 2) as bigint) as cents, body = 'Malformed message' as corrupt
from m where body <> ''""",
    "parse_json_records": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "mapped_attributes": f"""with {_M}
select off, 'kind=' || etype || coalesce(';tier=' || tier, '') as entries from m""",
    "key_attribute": f"with {_M} select off, k as value from m",
    "id_attribute": _entries("true", C.MESSAGE_ID_ATTRIBUTE, "cast(off as varchar) || ':' || cast(part as varchar)"),
    "prefixed_properties": f"""with {_M}
select off, '{C.PROPERTY_PREFIX}tier' as name, tier as value from m where tier is not null
union all select off, '{C.PROPERTY_PREFIX}etype', etype from m""",
    "topic_attribute": _entries("true", C.TOPIC_ATTRIBUTE, "topic"),
    "schema_attribute": _entries("stype = 'AVRO'", C.SCHEMA_ATTRIBUTE, "sdef"),
    "merged_attributes": f"""with {_M}
select off, coalesce('a=' || tier || ';', '')
  || case when stype = 'AVRO' then '{C.SCHEMA_ATTRIBUTE}=' || sdef || ';' else '' end
  || '{C.MESSAGE_ID_ATTRIBUTE}=' || off || ':' || part
  || ';{C.PROPERTY_PREFIX}etype=' || etype
  || coalesce(';{C.PROPERTY_PREFIX}tier=' || tier, '')
  || ';{C.TOPIC_ATTRIBUTE}=' || topic as entries from m""",
    "render_template": f"""with {_O}
select orderkey, 'orders-' || coalesce(shown, '') || '/' || coalesce(cust, '') as rendered from o""",
    "dynamic_topic": f"with {_O} select orderkey, 'orders-' || coalesce(shown, '') as topic from o",
    "message_key": f"with {_O} select orderkey, coalesce(cust, fallback) as key from o",
    "message_properties": f"""with {_O}
select orderkey, 'state' as name, shown as value from o where shown is not null
union all select orderkey, 'cust', cust from o where cust is not null""",
    "key_from_field": f"""with {_O}
select orderkey, 'number' as field, cast(custkey as varchar) as key from o
union all select orderkey, 'text', priority from o
union all select orderkey, 'bytes', priority from o
union all select orderkey, 'nested', '{{"status":"' || status || '","custkey":' || custkey || '}}' from o
union all select orderkey, 'absent', case when status = 'F' then status end from o""",
    "topic_groups": f"""with {_M}, x as (
  select *, (row_number() over (partition by part order by off) - 1) // 100 as batch_no from m
)
select part, batch_no, topic, count(*) as n, min(off) as first_off, count(*) as last_pos from x group by part, batch_no, topic""",
    "bundle_runs": f"""with {_M}, {_B}, {_R}
select 'mapped' as scope, topic, part, batch_no, run, count(*) as n from r group by topic, part, batch_no, run
union all
select 'all', topic, part, batch_no, row_number() over (partition by topic, part, batch_no order by off), 1 from b""",
    "bundle_content": f"{_BUNDLES} select topic, part, batch_no, run, md5(content) as digest from g where message_count > 0",
    "message_counts": f"{_BUNDLES} select topic, part, batch_no, run, message_count from g",
    "empty_bundles": f"""{_BUNDLES}
select topic, count(*) as n, true as drop_empty from g where message_count > 0 group by topic
union all select topic, count(*), false from g group by topic""",
    "record_counts": f"{_LINES} select topic, part, off, kept as record_count from kept",
    "schema_runs": f"""with {_M}, {_batches(1000)}, c as (
  select *, case when stype = 'AVRO' then sdef end as schema from b
), f as (
  select *, case when row_number() over w = 1 or schema is distinct from lag(schema) over w then 1 else 0 end as chg
  from c window w as (partition by topic, part, batch_no order by off)
), r as (
  select *, cast(sum(chg) over (partition by topic, part, batch_no order by off
      rows between unbounded preceding and current row) as bigint) as run from f
)
select topic, part, batch_no, run, count(*) as n, min(schema) as schema from r group by topic, part, batch_no, run""",
    "failure_bundles": f"""with {_M}, {_batches(1000)}
select topic, part, batch_no, md5(string_agg(body, '***' order by off)) as digest, count(*) as n
from b where body = 'Malformed message' group by topic, part, batch_no""",
    "audit_receipts": f"""{_BUNDLES}
select '{CONSUMER}' as consumer_id, topic, part, batch_no, count(*) as bundles, cast(sum(message_count) as bigint) as messages,
  min(first_off) as first_off, max(last_off) as last_off, '{BROKER}/' || topic as transit_uri
from g where message_count > 0 group by topic, part, batch_no""",
    "publish_counts": f"""{_TOKENS}
select doc_id as bundle_id, cast(len(t) as varchar) as sent, 'docs-' || lang as topic from tok""",
    "audit_sends": f"""{_TOKENS}
select doc_id as bundle_id, '{BROKER}' as transit_uri, 'Sent ' || len(t) || ' records' as details from tok where lang <> 'de'""",
    "whole_messages": "select doc_id as bundle_id, md5(text) as digest from documents",
    "split_messages": f"{_TOKENS} select doc_id as bundle_id, pos, md5(data) as digest from piece",
    "explode_records": f"{_LINES} select topic, part, mid as off, pos, uid, not good as corrupt from l",
    "records_to_messages": f"""with {_O}
select orderkey, 'json' as fmt, md5(json) as digest from w union all select orderkey, 'csv', md5(csv) from w""",
    "written_bundles": f"""with {_O}, {_batches(100, "w")}
select topic, part, batch_no, md5(string_agg(json, '' order by off)) as digest, count(*) as n from b group by topic, part, batch_no""",
    "prefix_keep": f"{_LINES} select topic, part, off, kept, uid_sum, failed from kept",
    "schema_failures": f"""with {_M}
select topic, off, case when tier is null then '{C.PARSE_FAILURE}' else '{C.SUCCESS}' end as relationship from m""",
    "publish_routes": f"""select case when lang = 'de' then '' else lang end as topic,
  case when lang = 'de' then '{C.FAILURE}' else '{C.SUCCESS}' end as relationship, count(*) as n, {_SUM.format("text")}
from documents group by 1, 2""",
    "publish_record_routes": f"""{_LINES}, mode as (select unnest(['none', 'prefix']) as partial), z as (
  select topic, partial, failed, case when not failed then n when partial = 'prefix' then kept else 0 end as sent
  from kept cross join mode
)
select topic, 'messages' as what, cast(sum(sent) as bigint) as n, partial from z group by topic, partial having sum(sent) > 0
union all
select topic, case when failed then '{C.FAILURE}' else '{C.SUCCESS}' end, count(*), partial from z group by topic, failed, partial""",
    "error_policy": f"""with {_M}, x as (
  select off, body = 'Malformed message' as bad, cast(body not in ('', 'Malformed message') as bigint) as usable from m
)
select off, '{C.SUCCESS}' as relationship, usable, 'consume' as policy from x
union all select off, '{C.SUCCESS}', usable, 'discard' from x where not bad
union all select off, case when bad then '{C.FAILURE}' else '{C.SUCCESS}' end, case when bad then 1 else usable end, 'fail' from x""",
    "dead_letters": f"""{_LINES}
select '{C.PARSE_FAILURE}' as relationship, topic, count(*) as n, {_SUM.format("data")}
from text join kept using (topic, part, off) where failed group by topic""",
    "publish_bytes": f"""{_TOKENS}, base as (
  select doc_id, coalesce(sum(len(t)) over (partition by lang order by doc_id rows between unbounded preceding and 1 preceding), 0) as base
  from tok
), msg as (
  select case when lang <> 'de' then 'docs-' || lang else 'docs-' end as topic, cast(base + pos as bigint) as off, data
  from piece join base using (doc_id)
)
select topic, off % 4 as part, count(*) as n, min(off) as lo, max(off) as hi, {_SUM.format("data")} from msg group by 1, 2""",
    "publish_files": f"""with f as (
  select lang, doc_id // 1000 as block, string_split(string_agg(text, chr(10) order by doc_id), chr(10)) as t from documents group by 1, 2
), b as (
  select *, block * 10 + list_position(['de', 'en', 'es', 'fr'], lang) as bundle_id,
    coalesce(sum(len(t)) over (partition by lang order by block rows between unbounded preceding and 1 preceding), 0) as base
  from f
), p as (
  select lang, base, unnest(t) as data, unnest(range(len(t))) as pos from b where lang <> 'de'
)
select lang as topic, cast((base + pos) % 4 as bigint) as part, cast(base + pos as bigint) as off, md5(data) as digest from p
union all
select case when lang = 'de' then '{C.FAILURE}' else '{C.SUCCESS}' end, bundle_id, case when lang <> 'de' then len(t) end, lang from b
union all
select '{C.FAILURE}', 0, null, 'en'""",
    "publish_file_records": f"""with {_O}, l as (
  select *, orderkey // 10000 as number, orderkey % 1000 = 777 and orderkey // 10000 % 3 = 1 as bad,
    row_number() over (partition by orderkey // 10000 order by orderkey) - 1 as pos from w
), f as (
  select number, count(*) as n, min(case when bad then pos end) as first_bad from l group by number
), mode as (
  select unnest(['none', 'prefix']) as partial
), s as (
  select *, case when first_bad is null then n when partial = 'prefix' then first_bad else 0 end as sent from f cross join mode
), b as (
  select *, coalesce(sum(sent) over (partition by partial order by number rows between unbounded preceding and 1 preceding), 0) as base from s
)
select 'sent' as what, cast(base + pos as bigint) as off, cast(custkey as varchar) as key, md5(json) as digest, partial
from l join b using (number) where pos < sent
union all
select case when first_bad is null then '{C.SUCCESS}' else '{C.FAILURE}' end, number, case when first_bad is null then cast(n as varchar) end, '', partial from b""",
    "publish_records": f"""with {_O}, {_batches(100, "w")}, u as (
  select *, min(off) over (partition by topic, part, batch_no) as bundle_id from b
), x as (
  select *, row_number() over (partition by topic order by bundle_id, off) - 1 as place,
    {_bucket("cast(custkey as varchar)", 4)} as target from u
)
select topic, target as part, count(*) as n, min(place) as lo, max(place) as hi, {_SUM.format("json")} from x group by topic, target""",
    "partition_routes": f"""with {_M}, x as (
  select off, 'RoundRobinPartition' as mode, coalesce({_bucket("k", 4)}, off % 4) as part from m
  union all select off, 'SinglePartition', coalesce({_bucket("k", 4)}, 2) from m
  union all select off, 'CustomPartition', length(topic) % 4 from m
)
select off, part, mode from x""",
    "publish_batches": f"""with recursive {_M}, {_batches(1000)}, x as (
  select *, (row_number() over (partition by topic, part, batch_no order by off) - 1) // 100 as flush_no,
    length(body) as size, epoch_us(ts) as sent_at from b
), y as (
  select *, row_number() over (partition by topic, part, batch_no, flush_no order by off) as rn from x
), z as (
  select topic, part, batch_no, flush_no, rn, off, size, cast(1 as bigint) as publish_batch,
    cast(1 as bigint) as held, cast(size as bigint) as bytes, sent_at as since
  from y where rn = 1
  union all
  select y.topic, y.part, y.batch_no, y.flush_no, y.rn, y.off, y.size,
    case when z.held + 1 > 50 or z.bytes + y.size > 400 or y.sent_at - z.since >= 43200000000 then z.publish_batch + 1 else z.publish_batch end,
    case when z.held + 1 > 50 or z.bytes + y.size > 400 or y.sent_at - z.since >= 43200000000 then 1 else z.held + 1 end,
    case when z.held + 1 > 50 or z.bytes + y.size > 400 or y.sent_at - z.since >= 43200000000 then y.size else z.bytes + y.size end,
    case when z.held + 1 > 50 or z.bytes + y.size > 400 or y.sent_at - z.since >= 43200000000 then y.sent_at else z.since end
  from z join y on z.topic = y.topic and z.part = y.part and z.batch_no = y.batch_no and z.flush_no = y.flush_no
    and y.rn = z.rn + 1
)
select topic, part, batch_no, flush_no, publish_batch, count(*) as n, cast(sum(size) as bigint) as bytes, min(off) as lo
from z group by topic, part, batch_no, flush_no, publish_batch""",
    "cumulative_acks": f"""with {_M}
select '{CONSUMER}' as consumer_id, topic, part, max(off) as position from m group by topic, part""",
    "individual_acks": f"""with {_M}
select '{CONSUMER}' as consumer_id, topic, part, off from m""",
    "backlog": f"""with {_M}, ends as (
  select topic, part, max(off) as position from m where ts < timestamp '2024-01-25' group by topic, part
), x as (
  select topic, off, off > coalesce(position, -1) as beyond, k is null as open from m left join ends using (topic, part)
)
select topic, off, 'cursor' as form from x where beyond
union all select topic, off, 'singly' from x where open
union all select topic, off, 'both' from x where beyond and open""",
    "compact_acks": f"""with {_M}, p as (
  select topic, part, coalesce(min(case when k is null then off end) - 1, max(off)) as position from m group by topic, part
)
select topic, part, position, count(case when k is not null and off > position then 1 end) as n
from p join m using (topic, part) group by topic, part, position""",
    "ack_intervals": f"""with {_M}, g as (
  select *, count(case when k is null then 1 end) over (partition by topic, part order by off) as gaps from m
)
select '{CONSUMER}' as consumer_id, topic, part, min(off) as first_off, max(off) as last_off
from g where k is not null group by topic, part, gaps""",
    "backlog_intervals": f"""with {_M} select topic, part, off, md5(body) as digest from m where k is null""",
    "due_for_redelivery": f"""with {_M}
select topic, part, off from m where k is null and ts <= (select max(ts) from events) - interval 1 day""",
    "dedupe": f"""with {_M}
select topic, part, off, md5(body) as digest from m""",
    "dispatch": f"""with {_M}, x as (
  select 'Exclusive' as mode, 0 as consumer, off from m
  union all select 'Failover', 0, off from m
  union all select 'Shared', off % 4, off from m
  union all select 'Key_Shared', coalesce({_bucket("k", 4)}, off % 4), off from m
)
select off, cast(consumer as bigint) as consumer, mode from x""",
    "chunk_split": f"""{_CHUNKS}
select doc_id, chunk_no, chunk_count, md5(data[chunk_no * 500 + 1 : chunk_no * 500 + 500]) as digest from c""",
    "chunk_roundtrip": f"{_CHUNKS} select doc_id, chunk_count, md5(data) as digest from e",
    "expired_chunks": f"""{_CHUNKS}
select doc_id, received, case when received = chunk_count then 'complete'
  when ((select max(doc_id) from documents) - doc_id) * 60 >= 3600 then 'expired' else 'pending' end as status from state""",
    "pending_chunk_cap": f"""{_CHUNKS}, x as (
  select doc_id, row_number() over (order by doc_id desc) as rn from state where received < chunk_count
)
select doc_id, 'ack' as action from x where rn > 10 union all select doc_id, 'redeliver' from x where rn > 10""",
    "stream_topics": f"with {_M} select topic, off from m where topic in ('{NAMESPACE}click', '{NAMESPACE}view')",
    "commit_replay": f"""with {_M}
select topic, part, count(case when body <> '' then 1 end) as n, max(off) as position from m group by topic, part""",
    "stream_latest": f"with {_M} select topic, off from m where ts >= timestamp '2024-01-15'",
    "stream_dedupe": f"with {_M} select topic, part, off, md5(body) as digest from m",
    "stream_receipts": f"""with {_M}
select count(case when body <> '' then 1 end) as messages, min(off) as first_off, max(off) as last_off from m""",
    "stream_redelivery": f"""with {_M}
select topic, part, off from m where k is null and ts <= (select max(ts) from events) - interval 1 day""",
    "stream_chunks": f"""{_CHUNKS}
select doc_id, chunk_count, md5(data) as digest from state join (select doc_id, data from e) using (doc_id) where received = chunk_count""",
    "stream_dead_letters": f"""with {_M}, {_B}, {_RR}
select '{C.PARSE_FAILURE}' as relationship, topic, part, batch_no, run as bundle_no, md5(string_agg(body, '***' order by off)) as digest
from r where body = 'Malformed message' group by topic, part, batch_no, run""",
    "stream_publish_failures": f"""select doc_id as bundle_id, '{C.FAILURE}' as relationship, md5(text) as digest from documents where lang = 'de'""",
    "stream_two_publishers": f"""{_TOKENS}
select lang as topic, count(*) as n, count(*) as offsets, cast(0 as bigint) as lo, count(*) - 1 as hi, {_SUM.format("data")}
from piece where lang <> 'de' group by lang""",
    "stream_publish": f"""{_TOKENS}
select lang as topic, count(*) as n, cast(0 as bigint) as lo, count(*) - 1 as hi,
  cast(count(*) * (count(*) - 1) / 2 as bigint) as off_sum, {_SUM.format("data")}
from piece where lang <> 'de' group by lang""",
}
