"""The same results in plain SQL over the same tables, for checking."""

from __future__ import annotations

V = 1_700_000_000_000

_LOG = """
log as (
  select 'events' as topic,
         cast(case when event_id % 3 = 0 then 0 when event_id % 6 = 1 then 1 when event_id % 6 = 2 then 2
                   when event_id % 6 = 4 then 3 else 4 end as integer) as part,
         cast(case when event_id % 3 = 0 then event_id // 3 else event_id // 6 end as bigint) as off,
         ts, cast(event_id as varchar) as k, event_id,
         case when event_type = 'error' and event_id % 5 = 0
                then concat('{"errorMessage":"e', cast(event_id as varchar), '"}')
              when event_id % 101 = 0 then cast(null as varchar)
              else concat('{"type":"', event_type, '","props":', props, '}') end as val
  from events)"""

_HOLES = "where off % 97 <> 41 and off % 89 not in (10, 11, 12)"


def _delivered(holes: str) -> str:
    """Records that came, some twice; ``holes`` leaves some out."""
    return _LOG + f""",
observed as (select * from log {holes}),
arrivals as (
  select topic, part, off, ts, k, event_id, val from observed
  union all
  select topic, part, off, ts + interval 1 second, k, event_id, val from observed where off % 50 = 0),
seed as (select distinct topic, part, cast(case part when 0 then 0 when 1 then 100 else 10 end as bigint) as next_off
         from log where part < 4),
expected as (select a.*, coalesce(s.next_off, 0) as expected from arrivals a left join seed s using (topic, part))"""


_ARRIVALS, _WHOLE = _delivered(_HOLES), _delivered("")

_LATEST = """,
fresh as (select topic, part, off, ts, val from expected where off >= expected
          qualify row_number() over (partition by topic, part, off order by ts desc, val desc nulls last) = 1)"""
_FRESH, _FRESH_WHOLE = _ARRIVALS + _LATEST, _WHOLE + _LATEST

_GAPS = _ARRIVALS + """,
marked as (select topic, part, off, lag(off, 1, expected - 1) over (partition by topic, part order by off) as prev
           from (select distinct topic, part, off, expected from expected where off >= expected)),
gaps as (select topic, part, prev + 1 as s, off - 1 as e from marked where off > prev + 1)"""

_REASON = """case when contains(coalesce(val, ''), 'errorMessage') then 'dropped'
                   when off % 53 = 7 then 'rejected' else 'written' end"""

_POINTS = f""",
points as (select topic, part, off as s, off as e, {_REASON} as reason, ts from arrivals)"""

_HANDLED = _GAPS + _POINTS + """,
handled as (select topic, part, s, e, reason from points union all select topic, part, s, e, 'gap' from gaps)"""


def _frontier(source: str) -> str:
    return f"""
each_off as (select distinct topic, part, unnest(range(s, e + 1)) as off from {source}),
wanted as (select topic, part, off, coalesce(next_off, 0) as f from each_off left join seed using (topic, part)
           where off >= coalesce(next_off, 0)),
numbered as (select *, row_number() over (partition by topic, part order by off) - 1 as rn from wanted),
frontier as (select topic, part, cast(f + count(*) filter (where off - rn = f) as bigint) as next_off
             from numbered group by topic, part, f)"""


_KEYS = 'topic, part as "partition"'
_RANGE = f"{_KEYS}, cast(s as bigint) as start_offset, cast(e as bigint) as end_offset"
_RECORD = f'{_KEYS}, off as "offset", ts as "timestamp"'

_COMMITS = _LOG + f""",
commits as (select topic, part, max(off) + 1 as next_off, max(off) as acked, cast({V} + max(off) as bigint) as at,
                   concat('job-', cast(max(off) % 7 as varchar)) as who, date_trunc('hour', ts) as hour
            from log group by topic, part, date_trunc('hour', ts)),
top as (select topic, part, max(next_off) as next_off from commits group by topic, part)"""

#: Steps 40 seconds apart, a wait of 60 seconds for each commit; the store holds 10^9 for partition 3 from the start.
_MOVES = _WHOLE + """,
total as (select count(*) as n from log),
once as (select topic, part, off, cast(least(event_id * 2 // n, 1) as integer) + case when off % 10 = 7 then 1 else 0 end as step
         from log, total),
came as (select topic, part, off, step from once
         union all
         select case when off % 500 <> 250 then topic end, part, off, step + 1 from once where off % 50 = 0),
keys as (select distinct topic, part from log),
floors as (select topic, part, coalesce(next_off, 0) as f, next_off is not null as seeded from keys left join seed using (topic, part)),
numbers as (select unnest(range(4)) as b),
firsts as (select topic, part, off, min(step) as step from came where topic is not null group by topic, part, off),
covered as (select topic, part, off, step, f, seeded, max(step) over (partition by topic, part order by off) as done
            from firsts join floors using (topic, part) where off >= f),
fronts as (select topic, part, b, f, seeded, f + count(*) filter (where done <= b) as now,
                  count(*) filter (where step <= b) - count(*) filter (where done <= b) as held,
                  count(*) filter (where step <= b) as ever
           from covered, numbers group by topic, part, b, f, seeded),
moves as (select *, lag(now, 1, f) over (partition by topic, part order by b) as was from fronts)"""

_STEPS = _MOVES + f""",
timed as (select topic, part, -1 as b, f as committed, cast(null as bigint) as since, cast(null as bigint) as armed,
                 case when part = 3 then 1000000001 else 0 end as stored, false as fired, false as tried from floors
          union all
          select x.topic, x.part, x.b,
                 case when fires then greatest(now, stored) else committed end,
                 case when not fires then waits end, case when since is null and waits is not null then 1 else 0 end,
                 case when fires and now > stored then now else stored end, fires, fires and now > stored
          from (select m.topic, m.part, m.b, m.now, t.committed, t.since, t.stored,
                       case when m.now > t.committed then coalesce(t.since, {V} + m.b * 40000) end as waits,
                       coalesce({V} + m.b * 40000 - case when m.now > t.committed then coalesce(t.since, {V} + m.b * 40000) end >= 60000, false) as fires
                from moves m join timed t on m.topic = t.topic and m.part = t.part and m.b = t.b + 1) x),
counted as (select topic, part, step as b, count(*) as seen from came where topic is not null group by all),
placed as (select c.topic, c.part, c.step as b, count(*) filter (where off < was) as stale, count(*) filter (where off >= now) as beyond
           from came c join moves m on c.topic = m.topic and c.part = m.part and c.step = m.b group by all)"""

_ROUTES = """
src as (select source, cast(substr(source, 4) as integer) as n, min(lang) as owner from documents group by source),
routes as (select source as topic, concat('set', cast(n % 4 as varchar)) as dataset,
                  case n % 3 when 0 then concat('t_', source) when 1 then ' ' end as tbl,
                  cast(case n % 4 when 0 then null when 1 then 0 else 10 + n end as bigint) as secs, owner from src)"""

_DESTINATION = "concat(dataset, '.', case when trim(coalesce(tbl, '')) = '' then 'KAFKA_RAW_MESSAGE' else tbl end)"

_ROWS = _LOG + """,
variants as (
  select event_id % 4 < 2 as nested,
         case when event_id % 13 <> 12 then topic end as nt,
         case when event_id % 12 = 0 then concat(' ', part) when event_id % 12 = 1 then concat('+', part)
              when event_id % 8 <> 4 then cast(part as varchar) end as np,
         cast(off as varchar) as no,
         case when event_id % 17 = 16 then ' ' else topic end as ft,
         case when event_id % 5 = 2 then concat('x', part) else cast(part as varchar) end as fp,
         case when event_id % 11 = 6 then '99999999999999999999'
              when event_id % 7 <> 3 then cast(off as varchar) end as fo
  from log),
picked as (select case when nested then nt else ft end as t, case when nested then np else fp end as p,
                  case when nested then no else fo end as o from variants),
typed as (select t, case when regexp_matches(p, '^[+-]?[0-9]+$') then try_cast(p as integer) end as p,
                 case when regexp_matches(o, '^[+-]?[0-9]+$') then try_cast(o as bigint) end as o from picked),
extracted as (select case when ok then t end as topic, case when ok then p end as part, case when ok then o end as off
              from (select *, t is not null and p is not null and o is not null as ok from typed))"""

_PARSED = _LOG + """,
keyed as (select off, case event_id % 9
             when 0 then concat('events:', part) when 1 then 'events' when 2 then concat(':', part)
             when 3 then concat('a:b:', part) when 4 then concat('events:x', part)
             when 5 then concat('events: ', part) when 6 then concat('events:+', part)
             when 7 then concat('events:9999999999', part) else concat('  :', part) end as key from log),
parts as (select off, string_split(key, ':') as ps from keyed),
parsed as (select off, ps[1] as t, case when regexp_matches(ps[2], '^[+-]?[0-9]+$') then try_cast(ps[2] as integer) end as p,
                  len(ps) = 2 and trim(ps[1]) <> '' as shape from parts),
refs as (select case when shape and p is not null then t end as topic, case when shape and p is not null then p end as part,
                off from parsed)"""

_LOOSE = """
loose as (
  select event_id as row_id,
         case when event_id % 29 = 3 then concat(event_id, 'x') when event_id % 31 = 4 then null
              else cast(event_id as varchar) end as id,
         case when event_id % 37 = 5 then null else event_type end as kind,
         user_id + 0.5 as amount,
         case when event_id % 41 = 6 then 'no day' when event_id % 43 = 7 then null else '2024-01-15' end as day,
         case event_id % 3 when 0 then 'true' when 1 then 'false'
              else case when event_id % 47 = 8 then 'maybe' else 'true' end end as seen,
         case when event_id % 53 = 9 then 'k' else cast(user_id as varchar) end as k
  from events),
judged as (
  select *, concat_ws('; ',
      case when id is null then 'missing required field id' end,
      case when id is not null and not regexp_matches(id, '^[0-9]+$') then 'cannot read field id as bigint' end,
      case when kind is null then 'missing required field kind' end,
      case when day = 'no day' then 'cannot read field day as date' end,
      case when seen = 'maybe' then 'cannot read field seen as boolean' end,
      case when k = 'k' then 'cannot read field meta.k as bigint' end) as error
  from loose)"""

_FLAT = f"""val as raw_message, topic as kafka_topic, topic as meta_kafka_topic,
  cast(part as bigint) as meta_kafka_partition, off as meta_kafka_offset, cast({V} as bigint) as version"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes}\n{body}"


SQL: dict[str, str] = {
    # sources and sinks
    "log_scan": _with(_LOG, f"select {_RECORD}, k as key, val as value from log"),
    "log_sink_roundtrip": _with(_LOG, f"select {_RECORD}, k as key, val as value from log"),
    "raw_table_write": _with(_FRESH_WHOLE, f"""select {_FLAT}, cast('2023-11-14' as date) as ingest_date
        from fresh where not contains(coalesce(val, ''), 'errorMessage') and off % 53 <> 7"""),
    "sink_success_offsets": _with(_FRESH_WHOLE, f"""select {_KEYS}, off as "offset"
        from fresh where not contains(coalesce(val, ''), 'errorMessage') and off % 53 <> 7"""),
    "sink_failed_rows": _with(_FRESH_WHOLE, f"""select {_FLAT}, 'refused by table' as error
        from fresh where not contains(coalesce(val, ''), 'errorMessage') and off % 53 = 7"""),
    "checkpoint_lookup": _with(_COMMITS, """,
        keys as (select distinct topic, cast(part + 10 * (off % 2) as integer) as part from log)
        select k.topic, k.part as "partition", coalesce(t.next_off, 0) as next_offset
        from keys k left join top t using (topic, part)"""),
    "checkpoint_topic_offsets": _with(_COMMITS, """
        select part as "partition", next_off as next_offset from top where topic = 'events'"""),
    "checkpoint_upsert": _with(_COMMITS, f"""
        select {_KEYS}, max(next_off) as next_offset, max(acked) as last_acked, cast({V} as bigint) as updated_at_ms,
               'job-b' as updated_by from commits group by topic, part"""),
    "resume_scan": _with(_WHOLE, f"""
        select {_RECORD}, k as key, val as value from expected where off >= expected"""),
    "generate_records": """
        with r as (select event_id * 3 + i as n, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as instant
                   from events, (select unnest(range(3)) as i))
        select cast(n as bigint) as record_no, md5(cast(n as varchar)) as key,
               concat('{"id":"', md5(cast(n as varchar)), '","timestamp":"', instant, '","value":',
                      printf('%.6f', (n * 7919 % 1000003) / 1000003.0::double), '}') as value from r""",
    "routing_scan": _with(_ROUTES, """
        select topic, dataset, tbl as "table", secs as commit_interval_seconds, owner from routes
        where topic in ('src1', 'src3', 'src10', 'absent')"""),
    "routing_lookup": _with(_ROUTES, "select topic, dataset from routes where contains('src17-eu', topic) order by topic limit 1"),
    "route_destination": _with(_ROUTES, f"select topic, {_DESTINATION} as destination from routes"),
    "route_commit_interval": _with(_ROUTES, """
        select topic, cast(case when secs > 0 then secs else 60 end as bigint) as interval_seconds from routes"""),
    "route_records": _with(_ROUTES, f"""
        select d.source as topic, cast(d.doc_id % 3 as integer) as "partition", d.doc_id as "offset",
               {_DESTINATION} as destination
        from documents d join routes r on d.source = r.topic where dataset <> 'set3'"""),
    # row-wise steps
    "envelope": _with(_LOG, """
        select 'configured' as topic, part as "partition", off as "offset", val as payload from log"""),
    "partition_key": _with(_LOG, """select concat(topic, ':', part) as partition_key, off as "offset" from log"""),
    "valid_payloads": _with(_LOG, f"""select {_KEYS}, off as "offset", val as payload from log
        where not contains(coalesce(val, ''), 'errorMessage')"""),
    "dropped_offsets": _with(_LOG, f"""select {_KEYS}, off as "offset" from log
        where contains(coalesce(val, ''), 'errorMessage')"""),
    "raw_message_rows": _with(_LOG, f"select {_FLAT} from log"),
    "raw_rows_versioned_by_record": _with(_LOG, f"select {_FLAT.replace(str(V), 'epoch_us(ts) // 1000')} from log"),
    "handled_from_rows": _with(_ROWS, f"""select {_KEYS}, off as "offset" from extracted"""),
    "handled_valid": _with(_ROWS, f"""select {_KEYS}, off as "offset" from extracted
        where trim(coalesce(topic, '')) <> '' and off is not null"""),
    "partition_key_parse": _with(_PARSED, f"""select {_KEYS}, off as "offset" from refs"""),
    "conform_ok": _with(_LOOSE, """
        select cast(id as bigint) as id, kind, cast(amount as double) as amount, cast(day as date) as day,
               cast(seen as boolean) as seen, cast(null as varchar) as absent, cast(k as bigint) as meta_k
        from judged where error = ''"""),
    "conform_failed": _with(_LOOSE, "select row_id, error from judged where error <> ''"),
    "older_table_rows": _with(_LOG, f"""
        select val as raw_message, topic as meta_kafka_topic, cast(part as bigint) as meta_kafka_partition, off as meta_kafka_offset,
               cast(null as date) as loaded_on, cast({V} as bigint) as version from log where val is not null and off % 53 <> 7"""),
    "older_table_handled": _with(_LOG, f"""
        select {_KEYS}, off as "offset", case when val is null or off % 53 = 7 then 'rejected' else 'written' end as reason from log"""),
    # ordering and gaps
    "contiguous_prefix": _with(_FRESH, f""",
        numbered as (select *, row_number() over (partition by topic, part order by off) - 1 as rn from fresh),
        floored as (select n.*, coalesce(next_off, 0) as f from numbered n left join seed using (topic, part))
        select {_RECORD}, val as payload from floored where off - rn = f"""),
    "contiguous_records": _with(_FRESH, f"select {_RECORD}, val as payload from fresh"),
    "gap_ranges": _with(_GAPS, f"select {_RANGE} from gaps"),
    "gap_missing_offsets": _with(_GAPS, f"""select {_KEYS}, unnest(range(s, e + 1)) as "offset" from gaps"""),
    "gap_first_missing": _with(_GAPS, f"""select {_KEYS}, s as "offset" from gaps"""),
    "gap_audit": _with(_GAPS, f"""
        select {_KEYS}, s as missing_offset, e as last_missing_offset, e + 1 as next_available_offset,
               e - s + 1 as missing_count, cast(300000 as bigint) as timeout_ms from gaps"""),
    "late_records": _with(_WHOLE, f"select {_RECORD}, expected from expected where off < expected"),
    "contiguous_run_lengths": _with(_ARRIVALS, f""",
        islands as (select topic, part, off, off - row_number() over (partition by topic, part order by off) as g
                    from (select distinct topic, part, off from arrivals))
        select {_KEYS}, min(off) as start_offset, max(off) as end_offset, max(off) - min(off) + 1 as run_length
        from islands group by topic, part, g"""),
    "many_key_runs": """
        with islands as (select conv_id, turn, turn - row_number() over (partition by conv_id order by turn) as g
                         from conversations)
        select 'conv' as topic, cast(conv_id as integer) as "partition", min(turn) as start_offset,
               max(turn) as end_offset, max(turn) - min(turn) + 1 as run_length from islands group by conv_id, g""",
    # handled offsets and the frontier
    "handled_from_sink": _with(_WHOLE + _POINTS, f"""select {_KEYS}, s as "offset", reason from points
        where reason <> 'dropped'"""),
    "handled_all": _with(_HANDLED, f"select {_RANGE}, reason from handled"),
    "commit_frontier": _with(_HANDLED + "," + _frontier("handled"), f"""
        select {_KEYS}, next_off as next_offset, next_off - 1 as last_acked from frontier"""),
    "commit_frontier_stalled": _with(_HANDLED + "," + _frontier("points"), f"""
        select {_KEYS}, next_off as next_offset, next_off - 1 as last_acked from frontier"""),
    "many_key_frontier": """
        with n as (select conv_id, turn, row_number() over (partition by conv_id order by turn) - 1 as rn
                   from conversations)
        select 'conv' as topic, cast(conv_id as integer) as "partition",
               count(*) filter (where turn = rn) as next_offset,
               count(*) filter (where turn = rn) - 1 as last_acked from n group by conv_id""",
    "stale_handled": _with(_WHOLE + _POINTS, f"""
        select {_RANGE}, reason from points join seed using (topic, part) where s < next_off"""),
    "wide_range_frontier": _with(_ARRIVALS + ", points as (select topic, part, off as s, off as e from observed)," + _frontier("points"), f"""
        select {_KEYS}, next_off * 16384 as next_offset, next_off * 16384 - 1 as last_acked from frontier"""),
    "wide_range_runs": _with(_ARRIVALS, f""",
        islands as (select topic, part, off, off - row_number() over (partition by topic, part order by off) as g from observed)
        select {_KEYS}, min(off) * 16384 as start_offset, max(off) * 16384 + 16383 as end_offset from islands group by topic, part, g"""),
    "buffered_handled": _with(_HANDLED + "," + _frontier("points"), f"""
        select distinct {_KEYS}, w.off as "offset" from wanted w join frontier using (topic, part)
        where w.off >= next_off"""),
    "commit_pending": _with(_HANDLED + "," + _frontier("handled"), f"""
        select {_KEYS}, f.next_off as next_offset, f.next_off - 1 as last_acked, s.next_off as committed_next
        from frontier f join seed s using (topic, part) where part in (0, 3) and f.next_off > s.next_off"""),
    # windows and metrics
    "tumbling_counts": _with(_LOG, """
        select time_bucket(interval 10 seconds, ts) as window_start, part as "partition", count(*) as n
        from log group by 1, 2"""),
    "tumbling_handled_counts": _with(_WHOLE + _POINTS, """
        select time_bucket(interval 10 seconds, ts) as window_start, reason, count(*) as n from points group by 1, 2"""),
    "gap_metrics": _with(_GAPS, """
        select e.topic, e.part as "partition", count(distinct off) filter (where off >= expected) as records_released,
               cast(coalesce(any_value(n), 0) as bigint) as gap_timeout_skip,
               cast(coalesce(any_value(m), 0) as bigint) as offsets_missing,
               count(*) filter (where off < expected) as late_after_skip
        from expected e left join (select topic, part, count(*) as n, sum(e - s + 1) as m from gaps
                                   group by topic, part) g using (topic, part)
        group by e.topic, e.part"""),
    "commit_metrics": _with(_HANDLED + "," + _frontier("handled"), """,
        sums as (select h.topic, h.part, sum(e - s + 1) as seen,
                        sum(greatest(least(e, coalesce(next_off, 0) - 1) - s + 1, 0)) as stale,
                        max(e) as last, max(coalesce(next_off, 0)) as f
                 from handled h left join seed using (topic, part) group by h.topic, h.part)
        select topic, part as "partition", cast(seen as bigint) as handled_offsets_seen,
               cast(stale as bigint) as stale_offsets_ignored, next_off - f as offsets_contiguously_acked,
               greatest(last + 1 - next_off, 0) as offsets_past_frontier
        from sums join frontier using (topic, part)"""),
    "key_metrics": _with(_PARSED, """
        select count(*) as handled_offsets_seen, count(*) filter (where topic is null) as invalid_partition_keys_dropped
        from refs"""),
    "checkpoint_metrics": _with(_COMMITS, f""",
        moved as (select topic, part, acked - coalesce(max(acked) over (partition by topic, part order by hour
                         rows between unbounded preceding and 1 preceding), -1) as advance from commits),
        listed as (select topic, part, list_sort(list(advance)) as a from moved where advance > 0 group by topic, part)
        select {_KEYS}, len(a) as advance_count, a[1] as advance_min, a[len(a)] as advance_max,
               cast(list_sum(a) as bigint) as advance_sum, a[cast(ceil(0.5 * len(a)) as bigint)] as advance_p50,
               a[cast(ceil(0.99 * len(a)) as bigint)] as advance_p99 from listed"""),
    "commit_step_metrics": "with recursive " + _STEPS + """
        select cast(m.b as bigint) as batch_id, m.topic, m.part as "partition", coalesce(seen, 0) as handled_offsets_seen,
               cast(0 as bigint) as invalid_partition_keys_dropped,
               coalesce(stale, 0) as stale_offsets_ignored, coalesce(beyond, 0) as no_progress_buffered,
               now - was as offsets_contiguously_acked, cast(now > was as bigint) as pending_ack_updated,
               cast(armed as bigint) as commit_timer_armed, cast(fired as bigint) as commit_timer_fired,
               cast(fired and not tried as bigint) as commit_timer_fired_without_pending_ack,
               cast(tried as bigint) as checkpoint_commit_attempted, held as buffered_state_size,
               cast(tried as bigint) as checkpoint_update_requested, cast(tried as bigint) as checkpoint_update_success,
               cast(0 as bigint) as checkpoint_update_failure
        from moves m join timed t on m.topic = t.topic and m.part = t.part and m.b = t.b
             left join counted c on m.topic = c.topic and m.part = c.part and m.b = c.b
             left join placed p on m.topic = p.topic and m.part = p.part and m.b = p.b
        where seeded or ever > 0
        union all
        select step, null, null, count(*), count(*), 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0 from came where topic is null group by step""",
    "gap_outcome_steps": _with(_MOVES, """
        select topic, part as "partition", cast(b as bigint) as step, cast(had = 0 and held > 0 as bigint) as gap_detected,
               cast(had > 0 and held = 0 as bigint) as gap_resolved_before_timeout, cast(0 as bigint) as gap_timeout_skip,
               now - was as contiguous_advance_size
        from (select *, lag(held, 1, 0) over (partition by topic, part order by b) as had from moves) where seeded or ever > 0"""),
    "stream_window_counts": _with(_WHOLE, """
        select time_bucket(interval 10 seconds, ts) as window_start, part as "partition", count(*) as n
        from arrivals group by 1, 2"""),
    # schemas
    "typed_cast": "select event_id, ts, value, event_type from events",
    "raw_string_projection": f"""
        select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, event_type, props,
               cast(null as varchar) as absent, cast({V} as bigint) as version from events""",
    "normalise_names": """
        select doc_id, lower(replace(replace(regexp_replace(text, '[^A-Za-z0-9€$]', '_', 'g'),
                                             '€', 'EURO'), '$', 'DOLLAR')) as name from documents""",
    "default_string_schema": _with(_LOG, """
        select distinct lower(regexp_replace(key, '[^A-Za-z0-9€$]', '_', 'g')) as name, 'STRING' as type,
               'NULLABLE' as mode
        from (select unnest(json_keys(val)) as key from log where val is not null)"""),
    "schema_field_stats": """
        select event_type as owner, count(*) as field_count,
               count(*) filter (where user_id % 3 <> 0) as actual_field_count from events group by event_type""",
}
