"""Independent DuckDB SQL for each registered query (same column names).

``R`` maps the driver tables to readings ``r`` and pumps ``p`` exactly as
``sigfleet.sources.driver_tables`` does; each statement is self-contained.
"""

from __future__ import annotations

R = (
    "with r as (select user_id as pump_id, case event_type when 'view' then 'status' "
    "when 'click' then 'rawpower' when 'purchase' then 'speed' when 'error' then 'fault' "
    "else 'inservice' end as signal, event_id % 4 = 3 as detailed, ts as time, value, event_id as pos "
    "from events), "
    "p as (select c_custkey as pump_id, case when c_custkey % 10 <> 0 then c_name end as name from customer) "
)

_WITH_R = {
    "range_scan": "select pump_id, signal, time, value, pos from r where pump_id = 7 and signal = 'rawpower' "
    "and time >= timestamp '2024-01-10 00:00:00' and time <= timestamp '2024-01-20 00:00:00'",
    "range_scan_open": "select pump_id, signal, time, value, pos from r where pump_id = 7 and signal = 'fault'",
    "range_carry_in": "select pump_id, signal, detailed, time, value from (select r.*, row_number() over (partition by "
    "pump_id, signal, detailed, time <= timestamp '2024-01-10 00:00:00' order by time desc, pos desc) as rn from r "
    "where time <= timestamp '2024-01-11 00:00:00') t where time > timestamp '2024-01-10 00:00:00' or rn = 1",
    "signal_select": "select pump_id, signal, detailed, time, value from r where (signal in "
    "('status', 'rawpower', 'speed', 'fault') and not detailed) or (signal = 'status' and detailed)",
    "detailed_select": "select pump_id, signal, detailed, time, value from r where pump_id = 7 and signal in "
    "('status', 'rawpower', 'speed') and detailed",
    "signal_counts": "select case when grouping(g.signal) = 1 then 'TOTAL' else g.signal end as signal, "
    "count(r.time) as points, case when count(r.time) > 0 then concat(count(r.time), ' puntos') else "
    "'sin datos' end as label from (values ('status'), ('rawpower'), ('speed'), ('aaecontrol')) g(signal) "
    "left join r on r.signal = g.signal and not r.detailed group by rollup (g.signal)",
    "individual_query": "select case when grouping(g.signal) = 1 then 'TOTAL' else g.signal end as signal, "
    "count(r.time) as points, case when count(r.time) > 0 then concat(count(r.time), ' puntos') else "
    "'sin datos' end as label from (values ('status'), ('rawpower'), ('speed')) g(signal) left join r on "
    "r.signal = g.signal and not r.detailed and r.pump_id = 7 and r.time >= timestamp '2024-01-29 00:00:00' and r.time <= "
    "timestamp '2024-01-30 00:00:00' group by rollup (g.signal)",
    "latest_per_signal": "select pump_id, signal, detailed, time, value from (select r.*, row_number() over "
    "(partition by pump_id, signal, detailed order by time desc, pos desc) as rn from r) t where rn = 1",
    "latest_wide": "select p.pump_id, p.name, l.status_value, l.status_time, l.power_value, l.power_time "
    "from p left join (select pump_id, max(case when signal = 'status' then value end) as status_value, "
    "max(case when signal = 'status' then time end) as status_time, max(case when signal = 'rawpower' "
    "then value end) as power_value, max(case when signal = 'rawpower' then time end) as power_time from "
    "(select r.*, row_number() over (partition by pump_id, signal order by time desc, pos desc) as rn "
    "from r where not detailed) t where rn = 1 group by pump_id) l on l.pump_id = p.pump_id",
    "report_rows": "select p.pump_id, p.name, coalesce(f.has_faults, false) as has_faults, "
    "coalesce(f.status_available, false) as status_available, coalesce(f.power_available, false) as "
    "power_available from p left join (select pump_id, bool_or(signal = 'fault' and value > 200) as "
    "has_faults, bool_or(signal = 'status') as status_available, bool_or(signal = 'rawpower') as "
    "power_available from r group by pump_id) f on f.pump_id = p.pump_id",
    "fleet_report": "select count(*) as total_pumps, count(f.pump_id) as processed, count(case when "
    "f.has_faults then 1 end) as with_faults from p left join (select pump_id, bool_or(signal = 'fault' "
    "and value > 200) as has_faults from r group by pump_id) f on f.pump_id = p.pump_id",
    "exclude_offline": "select p.pump_id, p.name from p left join (select pump_id, value, row_number() over "
    "(partition by pump_id order by time desc, pos desc) as rn from r where signal = 'inservice' and not detailed) s on "
    "s.pump_id = p.pump_id and s.rn = 1 and s.value < 20 where s.pump_id is null",
    "fault_alerts": "select p.pump_id, p.name, r.time, r.value from p join r on r.pump_id = p.pump_id "
    "where r.signal = 'fault' and (p.name like '%0001%' or p.name like '%77%')",
    "name_filter": "select pump_id, name from p where name like '%012%' or name like '%77%'",
    "id_names": "select pump_id as id, coalesce(name, '') as name from p",
    "valid_ids": "select c_custkey as pump_id, c_name as name from customer where c_nationkey % 5 > 1",
    "head_n": "select pump_id, name from p order by pump_id limit 10",
    "links_workset": "select p.pump_id, concat(g.s, d.d) as signal, concat('https://example.invalid/physicalPumps/', "
    "p.pump_id, '/', g.s, d.d, '/') as href from p cross join (values ('status'), ('rawpower'), ('speed'), "
    "('fault'), ('aaecontrol'), ('inservice'), ('onoffschedule'), ('flowschedule')) g(s) cross join "
    "(values (''), ('/detailed')) d(d)",
    "links_count": "select p.pump_id, count(*) as links from p cross join (values (1), (2), (3), (4), (5), "
    "(6), (7), (8)) g(s) cross join (values (1), (2)) d(d) group by p.pump_id",
    "links_rewrite": "select pump_id, case when pump_id % 2 = 0 then replace(concat('https://example.invalid/', "
    "pump_id, '/speed/'), 'https://example.invalid', 'https://example.invalid/publication/physicalPumps') "
    "else concat('https://example.invalid/', pump_id, '/speed/') end as href from p",
    "pump_info": "select p.pump_id, p.name, concat('https://example.invalid/physicalPumps/', p.pump_id, "
    "'/status/') as status_href from p where p.pump_id = 7",
    "file_key": "select pump_id, concat('consulta_status_', replace(coalesce(name, 'Sin nombre'), '#', '_'), "
    "'_20240130_000000') as file_key from p",
    "series_sample": "select pump_id, signal, detailed, time, value from (select r.*, row_number() over (partition by "
    "pump_id, signal, detailed order by time, pos) as rn from r) t where rn <= 3",
    "history_export": "select pump_id, signal, detailed, time, value from r where detailed and signal in ('status', 'rawpower', "
    "'speed', 'fault') and time >= timestamp '2024-01-30 00:00:00' - interval '24' hour and time <= "
    "timestamp '2024-01-30 00:00:00'",
    "history_document": "select pump_id, signal, time, value from r where detailed and signal in ('status', "
    "'rawpower', 'speed', 'fault') and time >= timestamp '2024-01-18 00:00:00' and time <= "
    "timestamp '2024-01-20 00:00:00'",
    "format_time": "select pos, strftime(time, '%Y-%m-%dT%H:%M:%SZ') as api_time from r",
    "format_time_text": "select pos, k, case pos % 10 when 0 then k when 1 then strftime(time, "
    "'%Y-%m-%dT%H:%M:%SZ') when 2 then strftime(time, '%Y-%m-%dT%H:%M:%SZ') when 3 then strftime(time, "
    "'%Y-%m-%dT00:00:00Z') when 4 then strftime(time, '%Y-%m-%dT00:00:00Z') when 5 then k when 6 then k "
    "when 7 then 'foo' when 8 then strftime(time, '%Y-%m-%dT%H:%M:00Z') else k end as api_time from "
    "(select pos, time, case pos % 10 when 0 then strftime(time, '%Y-%m-%dT%H:%M:%SZ') when 1 then "
    "strftime(time, '%Y-%m-%dT%H:%M:%S.123456') when 2 then strftime(time, '%Y-%m-%dT%H:%M:%S+02:00') "
    "when 3 then strftime(time, '%Y-%m-%d') when 4 then strftime(time, '%Y%m%d') when 5 then "
    "strftime(time, '%Y-%m') when 6 then strftime(time, ' %Y-%m-%dT%H:%M:%S') when 7 then 'fooZ' when 8 "
    "then strftime(time, '%Y-%m-%d %H:%M') else strftime(time, '%Y-13-01T00:00:00') end as k from r) v",
    "lookback_range": "select pos, k, h as hours, timestamp '2024-01-30 00:00:00' - to_hours(h) as start_time "
    "from (select pos, k, cast(case when pos % 6 in (1, 2, 5) then pos % 100 else 24 end as integer) as h from "
    "(select pos, case pos % 6 when 0 then '' when 1 then cast(pos % 100 as varchar) when 2 then "
    "concat(' ', pos % 100, chr(9)) when 3 then concat(pos % 100, '.5') when 4 then concat(pos % 100, 'h') "
    "else concat('+', pos % 100) end as k from r) a) b",
    "relative_range": "select pos, k, case when t in ('', 'hoy', 'today') then n - interval 1 day "
    "when t in ('ayer', 'yesterday') then n - interval 2 day when t in "
    "('semana', 'week') then n - interval 7 day when length(t) = 10 then try_strptime(t, "
    "'%Y-%m-%d') else try_strptime(t, '%Y-%m-%d %H:%M') end as start_time, case when t = '' "
    "then n when length(t) = 10 then try_strptime(t, '%Y-%m-%d') + interval "
    "86399 second else try_strptime(t, '%Y-%m-%d %H:%M') end as end_time from (select pos, k, "
    "lower(trim(k, concat(' ', chr(9), chr(10)))) as t, timestamp '2024-01-30 00:00:00' as n from (select pos, "
    "case pos % 12 when 0 then '' when 1 then 'hoy' when 2 then concat(chr(9), 'Ayer ', chr(10)) when 3 then 'week' "
    "when 4 then 'SEMANA' when 5 then strftime(time, '%Y-%m-%d') when 6 then strftime(time, '%Y-%m-%d %H:%M') "
    "when 7 then 'nonsense' when 8 then 'yesterday' when 9 then strftime(time, '%Y-%-m-%-d %-H:%-M') when 10 then "
    "concat(strftime(time, '%Y-%m-%d'), chr(10)) else concat(strftime(time, '%Y-%m-%d'), 'x') end as k from r) v) w",
    "wide_record": "select p.pump_id, p.name, r.signal, r.time, r.value, r.pos from p left join r on "
    "r.pump_id = p.pump_id and not r.detailed",
    "wide_chunks": "select p.pump_id, c.chunk, coalesce(c.n_status, 0) as n_status, coalesce(c.n_power, 0) as n_power, "
    "coalesce(c.n_speed, 0) as n_speed, coalesce(c.n_faults, 0) as n_faults, coalesce(c.n_inservice, 0) as "
    "n_inservice from p left join (select pump_id, date_trunc('hour', time) as chunk, count(*) filter (signal = "
    "'status') as n_status, count(*) filter (signal = 'rawpower') as n_power, count(*) filter (signal = 'speed') as "
    "n_speed, count(*) filter (signal = 'fault') as n_faults, count(*) filter (signal = 'inservice') as n_inservice "
    "from r where detailed group by 1, 2) c on c.pump_id = p.pump_id",
    "result_document": "select p.pump_id, coalesce(p.name, 'Sin nombre') as name, r.signal, r.detailed, r.time, r.value from p join r on "
    "r.pump_id = p.pump_id where r.detailed and r.signal in ('status', 'rawpower', 'speed') and r.time >= "
    "timestamp '2024-01-10 00:00:00' and r.time <= timestamp '2024-01-20 00:00:00'",
    "latest_csv": "select p.pump_id as ID, coalesce(p.name, 'Sin nombre') as Nombre, timestamp '2024-01-30 00:00:00' as Timestamp, "
    "l.st is not null as Estado_Disponible, l.pt is not null as Potencia_Disponible, l.sv as Estado_Valor, "
    "l.st as Estado_Tiempo, l.pv as Potencia_Valor, l.pt as Potencia_Tiempo from p left join (select pump_id, "
    "arg_max(value, (time, pos)) filter (signal = 'status') as sv, max(time) filter (signal = 'status') as st, "
    "arg_max(value, (time, pos)) filter (signal = 'rawpower') as pv, max(time) filter (signal = 'rawpower') as pt "
    "from r where not detailed group by pump_id) l on l.pump_id = p.pump_id",
    "id_names_csv": "select pump_id as id, concat(' \"', coalesce(name, ''), '\", ') as name from p",
    "report_json": "select p.pump_id as id, p.name, coalesce(f.has_faults, false) as has_faults, "
    "coalesce(f.status_available, false) as status_available, coalesce(f.power_available, false) as "
    "power_available, count(*) over () as total_bombas, count(f.pump_id) over () as bombas_procesadas, "
    "count(*) filter (f.has_faults) over () as bombas_con_fallos from p left join (select pump_id, "
    "bool_or(signal = 'fault' and value > 200) as has_faults, bool_or(signal = 'status') as status_available, "
    "bool_or(signal = 'rawpower') as power_available from r group by pump_id) f on f.pump_id = p.pump_id",
    "link_lookup": "select pump_id, case when pump_id % 5 <> 0 then concat('https://example.invalid/physicalPumps/', "
    "pump_id, '/speed/detailed/') end as href from p",
    "payload_outcomes": "select outcome, count(*) as n from (select case pos % 7 when 3 then 'error' when 4 then "
    "'no_pump' when 5 then 'no_signal' when 6 then 'error' else case pos % 11 when 0 then 'empty' when 1 then 'empty' "
    "when 3 then 'object' when 8 then 'ok' when 10 then 'ok' else 'malformed' end end as outcome from r) t "
    "group by outcome",
    "payload_sizes": "select cast(pump_id as varchar) as pump_id, signal, detailed, cast(sum(case when k in (8, 10) "
    "then case k when 8 then 2 else 1 end else 0 end) as bigint) as points, cast(sum(case when k = 3 then "
    "len(json_keys(props)) else 0 end) as bigint) as keys from (select r.*, e.props, pos % 11 as k from r join events e "
    "on e.event_id = r.pos) v where pos % 7 < 3 and k in (3, 8, 10) group by 1, 2, 3",
    "payload_partial": "select cast(pump_id as varchar) as pump_id, signal, detailed, cast(sum(case pos % 11 when 8 "
    "then 4 else 1 end) as bigint) as elements, cast(sum(case pos % 11 when 8 then 2 else 0 end) as bigint) as rejected "
    "from r where pos % 11 in (8, 10) and pos % 7 < 3 group by 1, 2, 3",
    "ingest_lossless": "select pump_id, signal, detailed, time, value, cast(0 as bigint) as pos from r union all "
    "select pump_id, signal, detailed, time, value + 1, 1 from r union all select pump_id, signal, detailed, null, "
    "value, 2 from r where pos % 5 = 0",
    "ingest_twice": "select pump_id, signal, detailed, time, value from r",
    "payload_readings": "select cast(pump_id as varchar) as pump_id, signal, detailed, time, value from r",
    "result_docs": "select cast(pump_id as varchar) as pump_id, signal, detailed, time, value from r",
    "catalog_scan": "select cast(pump_id as varchar) as pump_id, name, cast(16 as bigint) as links from p",
    "stream_fault_alerts": "select p.pump_id, p.name, r.time, r.value from p join r on r.pump_id = p.pump_id "
    "where r.signal = 'fault' and (p.name like '%0001%' or p.name like '%77%')",
    "stream_latest": "select pump_id, signal, detailed, arg_max(value, (time, pos)) as value, max(time) as time "
    "from r group by pump_id, signal, detailed",
    "state_at_fault": "select f.pump_id, f.time, f.pos as fault_pos, s.value as status, s.time as since from (select * "
    "from r where signal = 'fault') f asof left join (select pump_id, time, arg_max(value, pos) as value from r where "
    "signal = 'status' and not detailed group by pump_id, time) s on f.pump_id = s.pump_id and f.time >= s.time",
    "in_force_per_pump": "select q.pump_id, q.signal, q.time, s.value, s.time as since from (select p.pump_id, g.signal, "
    "timestamp '2024-01-10 00:00:00' + to_hours(cast(p.pump_id % 480 as integer)) as time from p cross join (values "
    "('status'), ('rawpower'), ('speed'), ('aaecontrol')) g(signal)) q asof left join (select pump_id, signal, time, "
    "arg_max(value, pos) as value from r where detailed group by pump_id, signal, time) s on q.pump_id = s.pump_id "
    "and q.signal = s.signal and q.time >= s.time",
    "stream_labels": "select pump_id, signal, detailed, arg_max(value, (time, pos)) as value, max(time) as time, "
    "max(time) < timestamp '2024-01-21 00:00:00' as silent from r group by pump_id, signal, detailed",
    "stream_latest_files": "select pump_id, signal, detailed, arg_max(value, (time, pos)) as value, max(time) as time "
    "from r where signal = 'status' and not detailed group by pump_id, signal, detailed",
    "catalog_fallback_files": "select concat('list/', k, '.json') as file, cast(pump_id as varchar) as pump_id, name, "
    "case when k % 3 = 0 then 'primary' else 'snapshot' end as origin from (select p.*, pump_id // 20 as k from p) x",
    "stream_heartbeat_polls": "select g.poll, p.pump_id, case when count(v.signal) filter (v.signal = 'status') > 0 then "
    "'OK' else 'Error' end as status, case when count(v.signal) filter (v.signal = 'rawpower') > 0 then 'OK' else "
    "'Error' end as power from p cross join (select cast(unnest(range(6)) as bigint) as poll) g left join (select "
    "pump_id, signal, case s when 3 then 4 else s end as poll from (select pump_id, signal, least((day(time) - 1) // 5, "
    "5) as s from r where not detailed) w) v on v.pump_id = p.pump_id and v.poll = g.poll group by g.poll, p.pump_id",
    "stream_heartbeat": "select p.pump_id, case when count(r.time) filter (r.signal = 'status') > 0 then 'OK' else "
    "'Error' end as status, case when count(r.time) filter (r.signal = 'rawpower') > 0 then 'OK' else 'Error' end "
    "as power from p left join r on r.pump_id = p.pump_id and not r.detailed group by p.pump_id",
    "bom_repair": "select case b when 1 then 'with_bom' else 'plain' end as folder, case b when 1 then 'repaired' "
    "else 'clean' end as status, cast(case b when 1 then 3 else 0 end as bigint) as bytes_dropped, "
    "count(distinct pump_id // 1000) as files from p cross join (values (0), (1)) v(b) group by b",
    "result_files": "select concat(p.pump_id, '/consulta_status_', replace(n.name, ' ', '_'), '_20240130_000000', "
    "coalesce(strftime(c.chunk, '_%Y%m%d%H'), ''), '.json') as file, n.name, 'status' as endpoint, "
    "coalesce(c.points, 0) as points, c.largest, '2024-01-30T00:00:00' as stamp from p "
    "join (select pump_id, coalesce(name, 'Sin nombre') as name from p) n on n.pump_id = p.pump_id left join (select "
    "pump_id, date_trunc('hour', time) as chunk, count(*) as points, max(value) as largest from r where not detailed "
    "and signal = 'status' and time >= timestamp '2024-01-10 00:00:00' and time <= timestamp '2024-01-20 00:00:00' "
    "group by 1, 2) c on c.pump_id = p.pump_id",
    "wide_files": "select concat(p.pump_id, '/datos_detallados_', replace(coalesce(p.name, 'Sin nombre'), ' ', '_'), "
    "'_20240130_000000', coalesce(strftime(c.chunk, '_%Y%m%d%H'), ''), '.json') as file, p.pump_id, "
    "coalesce(p.name, 'Sin nombre') as name, timestamp '2024-01-30 00:00:00' as timestamp, "
    "coalesce(c.n_status, 0) as n_status, coalesce(c.n_power, 0) as n_power, coalesce(c.n_speed, 0) as n_speed, "
    "coalesce(c.n_faults, 0) as n_faults, coalesce(c.n_inservice, 0) as n_inservice from p left join (select pump_id, "
    "date_trunc('hour', time) as chunk, count(*) filter (signal = 'status') as n_status, count(*) filter (signal = "
    "'rawpower') as n_power, count(*) filter (signal = 'speed') as n_speed, count(*) filter (signal = 'fault') as "
    "n_faults, count(*) filter (signal = 'inservice') as n_inservice from r where detailed group by 1, 2) c on "
    "c.pump_id = p.pump_id",
    "history_files": "select concat(pump_id, '/historicos_bomba_', pump_id, '_20240118_20240120', "
    "strftime(date_trunc('hour', time), '_%Y%m%d%H'), '.json') as file, pump_id, signal, time, value from r where "
    "detailed and signal in ('status', 'rawpower', 'speed', 'fault') and time >= timestamp '2024-01-18 00:00:00' and "
    "time <= timestamp '2024-01-20 00:00:00'",
    "output_files": "select pump_id, time, value, timestamp '2024-01-30 00:00:00' as fetched_at, "
    "'fleet_data_20240130_000000' as folder from r where signal = 'speed' and time >= timestamp '2024-01-10 00:00:00' "
    "and time <= timestamp '2024-01-20 00:00:00'",
    "payload_flags": "select pos % 7 < 3 and pos % 11 in (8, 10) as is_nonempty, pos % 11 <> 9 as is_not_null, "
    "true as is_not_empty_object, count(*) as n from r group by 1, 2",
    "bom_repair_bytes": "select file, cast(octet_length(b) as bigint) as bytes, sha256(b) as sha256 from (select "
    "concat(case w when 1 then 'in/with_bom/' else 'in/plain/in/' end, pump_id // 1000, '.json') as file, "
    "encode(concat(case w when 0 then '{\"results\": ' end, '[', string_agg(j, ',' order by pump_id), ']', "
    "case w when 0 then '}' end)) as b from (select p.pump_id, concat('{\"id\":\"', p.pump_id, '\"', "
    "',\"name\":\"' || p.name || '\"', l.links, '}') as j from p join (select pump_id, string_agg(concat(',\"', s, d, "
    "'\":{\"href\":\"https://example.invalid/physicalPumps/', pump_id, '/', s, d, '/\"}'), '' order by d, i) as links "
    "from p cross join (values (1, 'status'), (2, 'rawpower'), (3, 'speed'), (4, 'fault'), (5, 'aaecontrol'), "
    "(6, 'inservice'), (7, 'onoffschedule'), (8, 'flowschedule')) g(i, s) cross join (values (''), ('/detailed')) v(d) "
    "group by pump_id) l on l.pump_id = p.pump_id) t cross join (values (0), (1)) v(w) group by w, pump_id // 1000) x",
}

_PLAIN = {
    "schedule_scan": "select o_custkey as pump_id, case o_orderstatus when 'F' then 'aaecontrol' else 'flowschedule' "
    "end as signal, cast(o_orderdate as timestamp) as time, o_totalprice as value, o_orderkey as pos from orders where "
    "o_orderstatus in ('F', 'O') and o_orderdate >= timestamp '1995-01-01' and o_orderdate <= timestamp '1996-12-31'",
    "dedupe_last": "select pump_id, last_order, status from (select o_custkey as pump_id, o_orderkey as "
    "last_order, o_orderstatus as status, row_number() over (partition by o_custkey order by o_orderkey "
    "desc) as rn from orders) t where rn = 1",
    "catalog_fallback": "select 'primary' as origin, c_name as name from customer where c_nationkey % 2 = 0 "
    "union all select 'snapshot' as origin, s_name as name from supplier where s_nationkey % 2 = 1",
}


def oracle_sql() -> dict[str, str]:
    out = {k: R + v for k, v in _WITH_R.items()}
    out["range_carry_in_indexed"] = out["range_carry_in"]
    out["latest_indexed"] = out["latest_per_signal"]
    out.update(_PLAIN)
    return out
