"""The same results in plain SQL over the same tables."""

from __future__ import annotations

from eventmarts import contracts as C
from eventmarts.plans.event_views import OTHER_COLLECTION

_ARCHIVED = """
archived as (
  select cast(user_id as varchar) as did, cast(event_id % 97 as varchar) as rkey,
         cast(event_id as varchar) as cid, ts as created_at, event_type as text,
         case event_id % 4 when 0 then cast([] as varchar[]) when 1 then ['en']
              when 2 then ['en', 'ja'] else ['en', 'en'] end as langs,
         cast(user_id % 6 as integer) as kafka_partition, event_id as kafka_offset,
         ts as ingest_ts, regexp_extract(props, '([0-9]+)', 1) as subject, event_type
  from events
)"""

_RANK = """row_number() over (partition by did, rkey
    order by ingest_ts desc, kafka_partition desc, kafka_offset desc, cid desc)"""


def _latest(source: str, name: str, where: str = "true") -> str:
    return f"""
{name} as (
  select * exclude (r) from (select *, {_RANK} as r from {source} where {where}) q where r = 1
)"""


_LATE = """
late as (
  select * replace (created_at - case when kafka_offset % 7 = 0 then interval 5 day
                                      when kafka_offset % 11 = 0 then interval (-2) day
                                      else interval 0 day end as created_at)
  from archived
)"""

_D = f"with {_ARCHIVED}, {_latest('archived', 'd')}"
_TAGS = "array_to_string(langs, '|')"


def _by_lang(source: str) -> str:
    return f"""
  select day, lang, count(*) as posts, count(distinct did) as authors from (
    select cast(created_at as date) as day, did,
           unnest(case when len(langs) = 0 then ['und'] else langs end) as lang
    from {source}) x
  group by day, lang"""


def _by_subject(source: str, subject: str, n: str, who: str) -> str:
    return f"""
  select cast(created_at as date) as day, subject as {subject}, count(*) as {n},
         count(distinct did) as {who}
  from {source} group by 1, 2"""


# What happens to a raw line, from its number and type alone.
_ROUTED = f"""
routed as (
  select *, case when route = 'valid' or route = 'skip' or reason <> 'bad_json'
                 then collection else 'unknown' end as topic
  from (
    select *, case
      when s = 10 then 'dlq' when s in (4, 5, 6, 16, 17) then 'skip'
      when s in (7, 8, 9, 12, 13, 14, 23) then 'dlq'
      when s in (0, 1) then 'dlq'
      when s in (2, 19, 20) and kind = 'post' then 'dlq'
      when s in (21, 22) and kind = 'like' then 'dlq'
      else 'valid' end as route,
    case
      when s = 10 then 'bad_json' when s = 5 then 'not a commit' when s = 17 then 'no commit object'
      when s = 4 then 'not a create' when s = 16 then 'no record object'
      when s = 7 then 'KeyError(''did'')' when s = 6 then 'unknown collection'
      when s in (8, 9) then 'missing or non-int time_us'
      when s = 12 then 'type:createdAt' when s = 13 then 'KeyError(''rkey'')'
      when s = 14 then 'type:cid' when s = 23 then 'KeyError(''createdAt'')'
      when s = 0 then case kind when 'post' then 'KeyError(''text'')' else 'KeyError(''subject'')' end
      when s = 1 then case kind when 'post' then 'type:text' when 'like' then 'type:subject.uri'
                                else 'type:subject' end
      when s in (2, 19, 20) and kind = 'post' then 'type:langs'
      when s = 21 and kind = 'like' then 'type:subject'
      when s = 22 and kind = 'like' then 'KeyError(''uri'')'
      end as reason
    from (
      select *, event_id % 31 as s,
        case event_type when 'click' then 'like' when 'signup' then 'follow' else 'post' end as kind,
        case when event_id % 31 in (6, 7) then '{OTHER_COLLECTION}'
             when event_id % 31 in (10, 17) then 'unknown'
             when event_type = 'click' then '{C.COLLECTION_LIKE}'
             when event_type = 'signup' then '{C.COLLECTION_FOLLOW}'
             else '{C.COLLECTION_POST}' end as collection,
        regexp_extract(props, '([0-9]+)', 1) as subject,
        case when event_id % 31 = 11 then date_trunc('millisecond', ts) else ts end as created_at
      from events) a) b
)"""

_FLAT = """
flat as (
  select *, case s
      when 0 then 'extra:zzz' when 1 then 'empty or undecodable Avro payload'
      when 2 then 'missing:' || f || ',extra:x_' || f
      when 4 then 'type:did' when 5 then 'empty or undecodable Avro payload'
      when 6 then 'empty or undecodable Avro payload' when 7 then 'type:created_at'
      when 8 then 'type:record' end as error
  from (select archived.*, kafka_offset % 13 as s, {f} as f from archived {where}) a
)"""


def _flat(f: str, where: str = "") -> str:
    return f"with {_ARCHIVED}, {_FLAT.replace('{f}', repr(f)).replace('{where}', where)}"


def _check(
    name: str, target: str, passed: str, blocking: str, severity: str, seen: str, limit: str, tail: str
) -> str:
    return f"""
  select '{name}' as check_name, '{target}' as target, {passed} as passed, {blocking} as blocking,
         {severity} as severity, cast({seen} as double) as observed,
         cast({limit} as double) as threshold {tail}"""


_NOW = "timestamp '2024-01-31 12:00:00'"
_HALF = "timestamp '2024-01-15 12:00:00'"


def _chained(kind: str) -> str:
    """The newest version of every record that the router lets through."""
    return f"""with {_ROUTED}, d as (
      select * exclude (r) from (
        select cast(user_id as varchar) as did, created_at, subject,
          case when s in (3, 24) then cast([] as varchar[]) else case event_id % 4
            when 0 then cast([] as varchar[]) when 1 then ['en'] when 2 then ['en', 'ja']
            else ['en', 'en'] end end as langs,
          row_number() over (partition by user_id, event_id % 97
            order by epoch_us(ts) desc, cast(event_id as varchar) desc) as r
        from routed where route = 'valid' and kind = '{kind}') q
      where r = 1)"""


# The line of a dead letter as compact JSON with sorted keys.
_PAYLOAD = """
  case when s = 10 then '{"did":"broken' else
    '{"commit":{' || concat_ws(',',
       case s when 14 then '"cid":null' when 18 then null else '"cid":"' || event_id || '"' end,
       '"collection":"' || collection || '"', '"operation":"create"',
       '"record":{' || case when kind = 'post' then concat_ws(',', created_text, langs_text,
            '"reply":{"parent":{"uri":"p' || event_id || '"},"root":{"uri":7}}', post_text)
          else concat_ws(',', created_text, subject_text) end || '}',
       case s when 13 then null else '"rkey":"' || event_id % 97 || '"' end) || '}'
    || case s when 7 then '' else ',"did":"' || user_id || '"' end
    || ',"kind":"commit"'
    || case s when 8 then '' when 9 then ',"time_us":"' || epoch_us(ts) || '"'
              else ',"time_us":' || epoch_us(ts) end || '}' end"""

_DEAD = f"""
dead as (
  select *, {_PAYLOAD} as raw_payload from (
    select *,
      case s when 23 then null when 12 then '"createdAt":true'
        else '"createdAt":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"' end as created_text,
      case s when 2 then '"langs":["x",1]' when 19 then '"langs":"en"' when 20 then '"langs":["x",null]'
        else case event_id % 4 when 0 then '"langs":[]' when 1 then '"langs":["en"]'
             when 2 then '"langs":["en","ja"]' else '"langs":["en","en"]' end end as langs_text,
      case s when 0 then null when 1 then '"text":5' else '"text":"' || event_type || '"' end as post_text,
      case when s = 0 then null
           when kind = 'follow' then case s when 1 then '"subject":5' else '"subject":"' || subject || '"' end
           when s = 21 then '"subject":"' || subject || '"'
           else '"subject":{{"cid":"c' || subject || '"' ||
                case s when 22 then '' when 1 then ',"uri":5' else ',"uri":"' || subject || '"' end
                || '}}' end as subject_text
    from routed where route = 'dlq') c
)"""


def all_oracles() -> dict[str, str]:
    dedup_columns = "did, rkey, cid, created_at, kafka_partition, kafka_offset, ingest_ts"
    likes = f"with {_ARCHIVED}, {_latest('archived', 'd', 'event_type = ' + repr('click'))}"
    follows = f"with {_ARCHIVED}, {_latest('archived', 'd', 'event_type = ' + repr('signup'))}"
    late = f"with {_ARCHIVED}, {_LATE}, {_latest('late', 'full_d')}"
    twins = {
        "dedup_latest": f"{_D} select {dedup_columns}, {_TAGS} as langs from d",
        "dedup_unversioned": f"""with {_ARCHIVED},
            runs as (select cast(created_at as date) as day, text as tag, kafka_offset % 3 as run_seq,
                            count(*) as posts from archived group by 1, 2, 3)
            select day, tag, posts from (
              select *, row_number() over (partition by day, tag order by run_seq desc) as r from runs) q
            where r = 1""",
        "duplicate_keys": f"""with {_ARCHIVED} select did, rkey, count(*) as copies
            from archived group by did, rkey having count(*) > 1""",
        "raw_vs_deduped": f"""{_D} select (select count(*) from archived) as raw,
            (select count(*) from d) as deduped""",
        "staging_reconciliation": f"""{_D} select (select count(*) from d) as staged,
            (select count(*) from (select distinct did, rkey from archived) k) as landed_keys,
            (select count(*) from d) =
              (select count(*) from (select distinct did, rkey from archived) k) as passed""",
        "compact_table": f"{_D} select {dedup_columns} from d",
        "mart_by_tag_daily": f"{_D} {_by_lang('d')}",
        "mart_by_subject_daily_likes": f"{likes} {_by_subject('d', 'subject_uri', 'likes', 'likers')}",
        "mart_by_subject_daily_follows": (
            f"{follows} {_by_subject('d', 'subject_did', 'follows', 'followers')}"
        ),
        "mart_rollup": f"{_D} select cast(sum(posts) as bigint) as posts from ({_by_lang('d')}) m",
        "mart_rewindow": f"""{late} select * from ({_by_lang('full_d')}) m
            where day >= date '2024-01-26'""",
        "mart_rewindow_clamped": f"""{late}, kept as (select * from full_d where created_at <= {_NOW})
            select * from ({_by_lang('kept')}) m where day >= date '2024-01-26'""",
        "mart_incremental_upsert": f"""{late},
            {_latest('late', 'half_d', 'ingest_ts <= ' + _HALF)},
            half as ({_by_lang('half_d')}), full_m as ({_by_lang('full_d')}),
            cut as (select max(day) - 2 as start from half)
            select * from half where day < (select start from cut)
            union all select * from full_m where day >= (select start from cut)""",
        "landing_incremental": f"""with {_ARCHIVED}
            select {dedup_columns}, text, {_TAGS} as langs from archived""",
        "staging_incremental": f"""{_D} select did, rkey, cid, created_at, text, {_TAGS} as langs,
            ingest_ts from d""",
        "newer_than_mark": f"""with {_ARCHIVED} select did, rkey, cid, ingest_ts from archived
            where ingest_ts > (select max(ingest_ts) from archived where ingest_ts <= {_HALF})""",
        "total_deduped": f"{_D} select count(*) as total from d",
        "events_per_minute": f"""{_D} select date_trunc('minute', created_at) as time,
            count(*) as posts from d group by 1 order by 1""",
        "top_tags": f"""{_D} select lang, count(*) as posts from (select unnest(langs) as lang from d) x
            group by lang order by posts desc, lang limit 15""",
        "top_document_langs": """select lang, count(*) as posts from documents
            where lang is not null group by lang order by posts desc, lang limit 15""",
        "latest_n": f"""with {_ARCHIVED} select did, rkey, created_at, {_TAGS} as langs
            from archived order by ingest_ts desc, cid desc limit 5""",
        "route_events": f"""with {_ROUTED} select event_id, route, reason,
            case when s in (6, 7, 10, 17) then null else kind end as event_type,
            topic as intended_topic,
            case when s in (8, 9, 10) then null else epoch_us(ts) end as cursor from routed""",
        "read_from_cursor": f"""with {_ROUTED} select event_id from routed
            where s not in (6, 7) and (s in (8, 9, 10) or epoch_us(ts) > 1705000000000000)""",
        "project_posts": f"""with {_ROUTED} select cast(user_id as varchar) as did,
            cast(event_id % 97 as varchar) as rkey, cast(event_id as varchar) as cid, created_at,
            event_type as text,
            case when s in (3, 24) then '' else case event_id % 4 when 0 then '' when 1 then 'en'
              when 2 then 'en|ja' else 'en|en' end end as langs,
            case s when 15 then null else 'p' || event_id end as reply_parent,
            cast(null as varchar) as reply_root, epoch_us(ts) as cursor
            from routed where route = 'valid' and kind = 'post'""",
        "project_likes": f"""with {_ROUTED} select cast(user_id as varchar) as did,
            cast(event_id % 97 as varchar) as rkey, cast(event_id as varchar) as cid, created_at,
            subject as subject_uri, 'c' || subject as subject_cid
            from routed where route = 'valid' and kind = 'like'""",
        "project_follows": f"""with {_ROUTED} select cast(user_id as varchar) as did,
            cast(event_id % 97 as varchar) as rkey, cast(event_id as varchar) as cid, created_at,
            subject as subject_did from routed where route = 'valid' and kind = 'follow'""",
        "project_documents": """select doc_id, source as did, md5(text) as text_md5,
            cast(length(text) as bigint) as n_chars, true as intact, lang as langs from documents""",
        "dlq_rows": f"""with {_ROUTED}, {_DEAD} select reason as error, topic as intended_topic,
            raw_payload, {_NOW} as received_at from dead""",
        "dlq_rate": f"""with {_ROUTED} select topic as intended_topic, reason as error,
            count(*) as records from routed where route = 'dlq' group by 1, 2""",
        "validate_flat_posts": f"""{_flat('text')} select kafka_offset, error,
            case when error is null then did end as did,
            case when error is null then case s when 3 then '' else {_TAGS} end end as langs,
            case when error is null then created_at end as created_at from flat""",
        "validate_flat_likes": f"""{_flat('subject_cid', "where event_type = 'click'")}
            select did, rkey, cid, created_at, subject as subject_uri, 'c' || subject as subject_cid,
            kafka_partition, kafka_offset, {_NOW} as ingest_ts from flat where error is null""",
        "validate_flat_follows": f"""{_flat('subject_did', "where event_type = 'signup'")}
            select '{C.TOPIC_FOLLOW}' as intended_topic, error, count(*) as records
            from flat where error is not null group by error""",
        "canonical_json": """select event_id,
            '{"a":{"b":["x",null],"k":' || event_id || '},"z":1}' as payload from events""",
        "micros_to_ts": "select event_id, make_timestamp(epoch_us(ts)) as created_at from events",
        "text_to_ts": """select event_id, case event_id % 8 when 0 then ts
            when 1 then date_trunc('second', ts) when 2 then date_trunc('day', ts)
            when 3 then date_trunc('second', ts) when 4 then date_trunc('millisecond', ts)
            when 5 then date_trunc('millisecond', ts) when 6 then date_trunc('minute', ts)
            end as created_at from events""",
        "partition_keys": """select event_id, cast(strftime(ts, '%Y%m') as integer) as month_key,
            cast(strftime(ts, '%Y%m%d') as integer) as day_key, cast(ts as date) as day,
            date_trunc('minute', ts) as minute from events""",
        "offset_high_water": f"""with {_ARCHIVED} select kafka_partition,
            max(kafka_offset) as high_water, max(kafka_offset) + 1 as next_offset
            from archived group by 1""",
        "safe_cursor": """with log as (
              select event_type as stream, event_id as cursor,
                     case event_type when 'view' then true when 'error' then false
                          else event_id % 509 <> 508 end as acked
              from events where event_id % 101 <> 0),
            gaps as (select stream, min(case when not acked then cursor end) as gap from log group by 1)
            select log.stream, max(case when gap is null or cursor < gap then cursor end) as safe_cursor
            from log join gaps on log.stream = gaps.stream group by 1""",
        "cursor_upsert": """select stream_name, "cursor", updated_at from (
              select event_type as stream_name, event_id as "cursor", ts as updated_at,
                row_number() over (partition by event_type order by ts desc, event_id desc) as r
              from events) q where r = 1""",
        "ingest_counters": f"""with {_ROUTED} select route,
            case when reason = 'missing or non-int time_us' then 'missing_time_us' else topic end as label,
            count(*) as events from routed where route <> 'skip' group by 1, 2""",
        "staleness": f"""select max(ts) as newest,
            round((epoch_us({_NOW}) - epoch_us(max(ts))) / 1e6, 3) as age_seconds from events""",
        "key_affine": """select count(distinct user_id) as authors, cast(0 as bigint) as violations
            from events""",
        "check_freshness": _check(
            "freshness", "bronze", "lag <= 86400", "false", "'WARN'", "lag", "86400",
            f"from (select (epoch_us({_NOW}) - epoch_us(max(ts))) / 1e6 as lag from events) x",
        ),
        "check_volume": f"""{_D}, m as ({_by_lang('d')}),
            days as (select day, count(*) as n from m group by day),
            facts as (select (select n from days where day = (select max(day) from days)) as newest_n,
              (select avg(n) from days where day < (select max(day) from days)) as mean_n)"""
        + _check(
            "volume", "mart", "newest_n >= 0.25 * mean_n", "false", "'WARN'", "newest_n",
            "round(0.25 * mean_n, 6)", "from facts",
        ),
        "check_null_rate": f"{_D}"
        + _check(
            "null_rate", "staging", "count(*) = 0", "true", "'ERROR'", "count(*)", "0",
            "from d where kafka_offset % 3 = 0",
        ),
        "check_not_null": """select column_name, null_rows, null_rows = 0 as passed from (
            select 'did' as column_name, count(*) filter (where user_id is null) as null_rows from events
            union all select 'rkey', count(*) filter (where event_id is null) from events
            union all select 'cid', count(*) filter (where event_id % 5 = 0) from events
            union all select 'created_at', count(*) filter (where ts is null) from events) x""",
        "check_unique": f"""{_D}, """
        + "a as (select did, rkey from d group by 1, 2 having count(*) > 1),"
        + "b as (select did, rkey from archived group by 1, 2 having count(*) > 1)"
        + _check("unique", "staging", "count(*) = 0", "true", "'ERROR'", "count(*)", "0", "from a")
        + " union all "
        + _check("unique", "landing", "count(*) = 0", "true", "'ERROR'", "count(*)", "0", "from b"),
        "check_mart_unique": f"{_D}, m as ({_by_lang('d')}), "
        + "a as (select day, lang from m group by 1, 2 having count(*) > 1)"
        + _check("unique", "mart", "count(*) = 0", "true", "'ERROR'", "count(*)", "0", "from a"),
        "schema_contract": """
            with n(position, column_name, required, null_rows) as (
              select 1, 'did', true, count(*) filter (where user_id is null) from events union all
              select 2, 'rkey', true, count(*) filter (where event_id is null) from events union all
              select 3, 'cid', true, count(*) filter (where event_id is null) from events union all
              select 4, 'created_at', true, count(*) filter (where ts is null) from events union all
              select 5, 'text', true, count(*) filter (where event_type is null) from events union all
              select 6, 'langs', true, count(*) filter (where event_id is null) from events union all
              select 7, 'reply_parent', false, count(*) from events union all
              select 8, 'reply_root', false, count(*) filter (where event_id % 2 = 1) from events union all
              select 9, 'kafka_partition', true, count(*) filter (where user_id is null) from events union all
              select 10, 'kafka_offset', true, count(*) filter (where event_id is null) from events union all
              select 11, 'ingest_ts', true, count(*) filter (where ts is null) from events)
            select position, column_name, true as shape_ok, required, null_rows,
                   (not required or null_rows = 0) as ok from n""",
        "stream_archive": f"""with {_ARCHIVED} select did, rkey, cid, created_at, text,
            {_TAGS} as langs, kafka_partition, kafka_offset, cast(created_at as date) as created_day
            from archived""",
        "stream_dlq_split": f"""{_flat('text')} select
            case when error is null then 'bronze' else 'dlq' end as side, error,
            count(*) as records from flat group by 1, 2""",
        "rerun_noop": """select 1 as run, count(*) as archived_this_run,
              cast(0 as bigint) as dlq_this_run, count(*) as bronze_total_rows
              from events where event_type = 'click'
            union all select 2, 0, 0, count(*) from events where event_type = 'click'""",
        "stream_ingest": f"""with {_ROUTED} select route,
            case when reason = 'missing or non-int time_us' then 'missing_time_us' else topic end as label,
            count(*) as events from routed where route <> 'skip' group by 1, 2""",
        "realtime_mart": f"{_D} select did, rkey, cid, created_at, text, {_TAGS} as langs from d",
        "stream_flush": """with sizes as (select count(*) as n, greatest(1, count(*) // 7) as b,
                                       greatest(1, count(*) // 2) as c from events),
            runs as (select n, b, c, unnest(range(0, 3)) as run from sizes),
            ends as (select n, b, run, run * c as low, least(n, (run + 1) * c) as high from runs where run * c < n),
            cuts as (select n, run, low, high, b, unnest(range(low, high, b)) as first from ends)
            select cast(row_number() over (order by first) - 1 as integer) as batch,
              least(high - first, b) as records, least(high - first, b) as offsets, n as all_offsets from cuts""",
        "stream_minutes": """select date_trunc('minute', ts) as time, count(*) as posts
            from events group by 1""",
        "stream_dedup": """select cast(user_id as varchar) as did, cast(event_id as varchar) as rkey,
            ts + case when event_id % 97 = 0 then interval 9 year when event_id % 89 = 0
              then interval (-9) year else interval 0 year end as created_at,
            event_type as text from events""",
        "chain_posts": f"{_chained('post')} {_by_lang('d')}",
        "chain_likes": f"{_chained('like')} {_by_subject('d', 'subject_uri', 'likes', 'likers')}",
        "chain_follows": f"{_chained('follow')} {_by_subject('d', 'subject_did', 'follows', 'followers')}",
        "vertical_posts": f"{_D} {_by_lang('d')}",
        "vertical_likes": f"{likes} {_by_subject('d', 'subject_uri', 'likes', 'likers')}",
        "vertical_follows": f"{follows} {_by_subject('d', 'subject_did', 'follows', 'followers')}",
        "vertical_checks": f"""{_D}, m as ({_by_lang('d')}),
            days as (select day, count(*) as n from m group by day)
            select 'null_rate' as check_name, 'staging-post' as target,
              count(*) filter (where did = '' or rkey = '' or cid = '') = 0 as passed,
              true as blocking from d
            union all select 'not_null', 'staging-post', count(*) filter (where did is null
              or rkey is null or cid is null or created_at is null) = 0, true from d
            union all select 'freshness', 'bronze-post',
              epoch_us({_NOW}) - epoch_us(max(created_at)) <= 86400000000, false from archived
            union all select 'not_null', 'mart-post', count(*) filter (where day is null
              or lang is null or posts is null or authors is null) = 0, true from m
            union all select 'unique', 'mart-post', count(*) = count(distinct (day, lang)), true from m
            union all select 'volume', 'mart-post',
              (select n from days where day = (select max(day) from days)) >= 0.25 *
              (select avg(n) from days where day < (select max(day) from days)), false""",
    }
    twins["chain_bronze"] = twins["project_posts"]
    twins["mart_by_tag_mergeable"] = twins["mart_by_tag_daily"]
    twins["mart_by_subject_mergeable"] = twins["mart_by_subject_daily_likes"]
    twins["mart_audited"] = twins["mart_incremental_upsert"]
    twins["dedup_bucketed"] = twins["compact_by_day"] = twins["dedup_latest"]
    twins["landing_units"] = twins["stream_archive"]
    twins["stream_latest"] = twins["dedup_latest"]
    twins["stream_minutes_latest"] = twins["events_per_minute"]
    twins["stream_safe_cursor"] = twins["safe_cursor"]
    twins["vertical_incremental"] = twins["mart_incremental_upsert"]
    return twins
