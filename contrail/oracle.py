"""The registered queries in plain SQL, written independently of the Spark code.

Common table expressions build the same bronze-shaped inputs and products from
the sample tables; each entry lists the ones it needs."""

from __future__ import annotations

RUN_TS = "timestamp '2024-02-01 00:00:00'"

def _initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(trim(lower({x})), ' '), "
        "lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


_CTE = {
    "pings": """
        select ' a' || user_id || ' ' as icao24,
          case when event_type = 'view' then null when event_id % 2 = 0 then s else s * 1000 + 123 end
            as time_position,
          s as last_contact,
          case when event_type <> 'signup' then value end as velocity,
          case when event_type <> 'error' then k * 250.0e0 - 600.0e0 end as geo_altitude,
          k * 2.0e0 - 95.0e0 as latitude, value - 200.0e0 as longitude, value as true_track,
          event_id as _ingest_ts, cast(ts as date) as download_date
        from (select *, cast(floor(epoch(ts)) as bigint) as s,
                cast(json_extract_string(props, '$.k') as int) as k from events)""",
    "legs": """
        select l_orderkey, l_linenumber, 'p' || l_partkey as icao24,
          case when l_linenumber = 7 then '  ' when l_linenumber = 6 then cast(l_orderkey as varchar)
            else ' ' || lower(substr(c_mktsegment, 1, 3)) || l_orderkey end as callsign,
          case when c_nationkey % 5 <> 4 then 'n' || lpad(cast(c_nationkey as varchar), 3, '0') end
            as estDepartureAirport,
          case when s_nationkey % 7 <> 6 then ' N' || lpad(cast(s_nationkey as varchar), 3, '0') || ' '
            end as estArrivalAirport,
          cast(floor(epoch(o_orderdate)) as bigint) + l_orderkey * 7919 % 86400 as firstSeen,
          cast(floor(epoch(l_shipdate)) as bigint) + l_partkey * 104729 % 86400 as lastSeen,
          l_partkey * 100000 + l_suppkey as _ingest_ts
        from lineitem join orders on l_orderkey = o_orderkey
          join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey""",
    "dep_legs": """
        select *, 'departures' as _source_file from legs where estDepartureAirport is not null""",
    "arr_legs": """
        select *, 'arrivals' as _source_file from legs where estArrivalAirport is not null""",
    "raw_airports": """
        select case when n_nationkey >= 23 then ' ?' else ' n' end
            || lpad(cast(n_nationkey as varchar), 3, '0') as icao,
          case when n_nationkey % 9 = 0 then '' else 'x' || lpad(cast(n_nationkey as varchar), 2, '0')
            end as iata,
          lower(n_name) as city, r_name as region, '  ' || n_name || ' airport' as name, type,
          cast(case when type = 'CIVIL' then 1 when n_nationkey % 5 <> 0 then n_nationkey % 3 end
            as bigint) as _ingest_ts
        from (select *, unnest(['CIVIL', ' Military']) as type
              from nation join region on n_regionkey = r_regionkey)""",
    "raw_airlines": """
        select distinct case when c_mktsegment = 'FURNITURE' then ' 1' else ' ' end
            || lower(substr(c_mktsegment, 1, 3)) || ' ' as prefix,
          lower(c_mktsegment) || ' AIR ' as airline, cast(1 as bigint) as _ingest_ts from customer
        union all values ('HOU', ' household express', 2), ('1bad', 'nobody', 1), ('ZZZ', '   ', 1)""",
    "clean_states": """
        select upper(trim(icao24)) as icao24, velocity as velocity_mps, geo_altitude as geo_alt_m,
          make_timestamp(e * 1000000) as time_ts,
          cast(make_timestamp(e * 1000000) as date) as event_date_utc,
          cast(hour(make_timestamp(e * 1000000)) as tinyint) as hour_of_day,
          velocity < 0 or velocity > 350 as flag_velocity_outlier,
          geo_altitude < -500 or geo_altitude > 20000 as flag_alt_outlier,
          _ingest_ts, download_date
        from (select *, case when t > 10000000000 then t // 1000 else t end as e
              from (select *, coalesce(time_position, last_contact) as t from pings))
        where icao24 is not null and e is not null""",
    "states": f"""
        select *, 'v1.0.0' as _silver_version, {RUN_TS} as _silver_ts from clean_states
        qualify row_number() over (partition by icao24, time_ts order by _ingest_ts desc) = 1""",
    "daily": f"""
        select icao24, event_date_utc, count(*) as pings_count,
          quantile_disc(velocity_mps, 0.95) as p95_velocity,
          quantile_disc(geo_alt_m, 0.95) as p95_altitude,
          avg(cast(flag_velocity_outlier as double)) as pct_velocity_outlier,
          avg(cast(flag_alt_outlier as double)) as pct_alt_outlier,
          max(_ingest_ts) as _ingest_ts, max(_silver_ts) as _silver_ts,
          max(download_date) as download_date, count(*) / 960.0e0 * 100.0e0 as coverage_pct,
          'v1.0.0' as _gold_version, {RUN_TS} as _gold_ts, 'manual' as _gold_run_id,
          'build_fact_states' as _gold_job, 'silver.states' as _source
        from states group by icao24, event_date_utc""",
    "airports": f"""
        select city, region, icao, iata, name, type, _ingest_ts, 'v1.0.0' as _silver_version,
          {RUN_TS} as _silver_ts
        from (
          select {_initcap("city")} as city, upper(trim(region)) as region,
            case when regexp_matches(upper(trim(icao)), '^[A-Z0-9]{{4}}$') then upper(trim(icao)) end as icao,
            case when regexp_matches(upper(trim(iata)), '^[A-Z0-9]{{3}}$') then upper(trim(iata)) end as iata,
            {_initcap("name")} as name, lower(trim(type)) as type, _ingest_ts
          from raw_airports)
        where icao is not null
        qualify row_number() over (partition by icao
          order by _ingest_ts desc nulls last, type desc, name desc) = 1""",
    "airlines": f"""
        select prefix, airline_name, _ingest_ts, 'v1.0.0' as _silver_version, {RUN_TS} as _silver_ts
        from (
          select nullif(regexp_extract(upper(trim(prefix)), '^[A-Z]{{2,4}}', 0), '') as prefix,
            case when length(trim(airline)) > 0 then {_initcap("airline")} end as airline_name, _ingest_ts
          from raw_airlines)
        where prefix is not null
        qualify row_number() over (partition by prefix
          order by _ingest_ts desc nulls last, airline_name desc nulls last) = 1""",
    "days": "select distinct cast(ts as date) as d from events",
    "manifest": """
        select 'events' as dataset, 'day=' || cast(d as varchar) as source_file,
          'run' || (day(d) % 5) as ingest_id, cast(d as timestamp) as processed_ts,
          case day(d) % 3 when 0 then 'failed' when 1 then 'processing' else 'done' end as status,
          case when day(d) % 4 <> 0 then md5('day=' || cast(d as varchar)) end as file_hash,
          case when day(d) % 2 = 0 then 'v1' else 'v2' end as version
        from days""",
    "incoming": f"""
        select 'events' as dataset, 'day=' || cast(e as varchar) as source_file, 'run9' as ingest_id,
          {RUN_TS} as processed_ts, case when day(e) % 3 = 0 then 'failed' else 'done' end as status,
          case when day(e) % 8 <> 0 then md5('day=' || cast(e as varchar)) end as file_hash,
          case when day(e) % 2 = 0 then 'v1' else 'v2' end as version
        from (select d + 10 as e from days)""",
    "run_log": """
        select 'events' as dataset, 'day=' || cast(d as varchar) as source_file, event_type as ingest_id,
          t as processed_ts,
          case when event_type in ('error', 'signup') then 'failed' else 'done' end as status,
          case when event_type <> 'view' then md5('day=' || cast(d as varchar)
            || case when event_type = 'click' then '!' else '' end) end as file_hash,
          case when day(d) % 2 = 0 then 'v1' else 'v2' end as version
        from (select cast(ts as date) as d, event_type, max(ts) as t from events group by all)""",
    "current_files": """
        select 'events' as dataset, 'day=' || cast(e as varchar) as source_file,
          md5('day=' || cast(e as varchar)) as file_hash, 'v2' as version
        from (select d + 10 as e from days)""",
    "last_done": """
        select dataset, source_file, arg_max(coalesce(file_hash, ''), processed_ts) as last_hash,
          arg_max(version, processed_ts) as last_version
        from run_log where status = 'done' group by all""",
    "paths": """
        select event_id, '/raw/flights_departure/tag='
            || case when user_id % 2 = 0 then 'lemd' else 'LEBL' end
            || case when event_id % 7 = 0 then '' else '/date=' || cast(cast(ts as date) as varchar) end
            || '/flights_departure_x'
            || case when event_id % 3 = 0 then '' else '_' || strftime(ts, '%Y%m%dT%H%M%S') || 'Z' end
            || '.json.gz' as path,
          cast(ts as date) as ingest_date
        from events""",
    "path_facts": """
        select event_id, ingest_date,
          try_strptime(nullif(regexp_extract(path, '_([0-9]{8}T[0-9]{6})Z', 1), ''), '%Y%m%dT%H%M%S')
            as download_ts,
          try_cast(nullif(regexp_extract(path, '/date=([0-9]{4}-[0-9]{2}-[0-9]{2})/', 1), '') as date)
            as directory_date
        from paths""",
    "calendar": """
        select date, cast(isodow(date) - 1 as tinyint) as dow, cast(week(date) as int) as week,
          strftime(date, '%Y-%m') as month, cast(quarter(date) as int) as quarter,
          cast(year(date) as int) as year, isodow(date) >= 6 as is_weekend
        from (select cast(unnest(generate_series(
            (select min(o_orderdate) from orders), (select max(l_shipdate) from lineitem),
            interval 1 day)) as date) as date)""",
    "hourly": """
        select icao24, cast(epoch(date_trunc('hour', time_ts)) as bigint) as hour, _ingest_ts,
          velocity_mps, geo_alt_m from clean_states""",
    "old_legs": """
        select l_orderkey, l_linenumber, icao24, lastSeen, _ingest_ts, _source_file from dep_legs
        qualify row_number() over (partition by l_orderkey, l_linenumber
          order by lastSeen, _ingest_ts) = 1""",
    "new_legs": """
        select l_orderkey, l_linenumber, icao24, lastSeen, _ingest_ts, _source_file from arr_legs
        qualify row_number() over (partition by l_orderkey, l_linenumber
          order by lastSeen desc, _ingest_ts desc) = 1""",
    "airport_counts": """
        select icao, count(*) filter (role = 'dep') as departures,
          count(*) filter (role = 'arr') as arrivals
        from (select dep_icao as icao, 'dep' as role from flights
              union all select arr_icao, 'arr' from flights)
        where icao is not null group by icao""",
}


def _calendar_parts(ts: str, prefix: str) -> str:
    return (
        f"cast({ts} as date) as {prefix}_date_utc, cast(hour({ts}) as tinyint) as {prefix}_hour, "
        f"cast(isodow({ts}) - 1 as tinyint) as {prefix}_dow, cast(week({ts}) as int) as {prefix}_week, "
        f"strftime({ts}, '%Y-%m') as {prefix}_month"
    )


def _clean(source: str) -> str:
    return f"""
        select *, cast(epoch(last_seen_ts) - epoch(first_seen_ts) as int) as block_time_s,
          concat_ws('→', dep_icao, arr_icao) as route_key,
          sha256(concat_ws('|', icao24, coalesce(dep_icao, ''), coalesce(arr_icao, ''),
            cast(firstSeen as varchar), cast(lastSeen as varchar))) as flight_id,
          nullif(regexp_extract(callsign_norm, '^[A-Z]+', 0), '') as airline_prefix,
          {_calendar_parts("first_seen_ts", "dep")}, {_calendar_parts("last_seen_ts", "arr")}
        from (
          select *, nullif(upper(trim(callsign)), '') as callsign_norm,
            upper(trim(estDepartureAirport)) as dep_icao, upper(trim(estArrivalAirport)) as arr_icao,
            make_timestamp(firstSeen * 1000000) as first_seen_ts,
            make_timestamp(lastSeen * 1000000) as last_seen_ts
          from (select * replace (upper(trim(icao24)) as icao24) from {source}))"""


def _feed(source: str) -> str:
    return f"""
        select flight_id, icao24, callsign_norm, airline_prefix, airline_name, dep_icao,
          d.iata as dep_iata, arr_icao, a.iata as arr_iata,
          dep_icao is null or d.iata is null as unknown_dep,
          arr_icao is null or a.iata is null as unknown_arr,
          first_seen_ts, last_seen_ts, block_time_s, dep_date_utc, arr_date_utc, dep_hour, arr_hour,
          dep_dow, arr_dow, dep_week, arr_week, dep_month, arr_month, route_key,
          f._ingest_ts, _source_file, 'v1.0.0' as _silver_version, {RUN_TS} as _silver_ts
        from (select * from ({_clean(source)})
              qualify row_number() over (partition by flight_id
                order by _ingest_ts desc, callsign_norm desc nulls last) = 1) f
          left join airlines l on f.airline_prefix = l.prefix
          left join airports d on f.dep_icao = d.icao
          left join airports a on f.arr_icao = a.icao"""


_CTE["clean_legs"] = _clean("legs")
_CTE["dep_feed"] = _feed("dep_legs")
_CTE["arr_feed"] = _feed("arr_legs")
_CTE["flights"] = f"""
        select *, 'v1.0.0' as _gold_version, {RUN_TS} as _gold_ts, 'manual' as _gold_run_id,
          'build_fact_flights' as _gold_job, 'silver.flights_departure+arrival' as _source
        from (select * from dep_feed union all by name select * from arr_feed)
        qualify row_number() over (partition by flight_id
          order by _ingest_ts desc, _source_file desc, callsign_norm desc nulls last) = 1"""

_REFS = ["raw_airports", "airports", "raw_airlines", "airlines"]
_LEGS = ["legs", "dep_legs", "arr_legs"]
_FLIGHTS = [*_REFS, *_LEGS, "dep_feed", "arr_feed", "flights"]
_STATES = ["pings", "clean_states", "states"]
_DAILY = [*_STATES, "daily"]
_LEDGER = ["days", "manifest", "incoming"]
_LOG = ["days", "run_log", "current_files", "last_done"]
_VERSIONS = [*_LEGS, "old_legs", "new_legs"]


def _sql(ctes: list[str], body: str) -> str:
    if not ctes:
        return body
    return "with " + ",\n".join(f"{name} as ({_CTE[name]})" for name in ctes) + "\n" + body


ORACLE: dict[str, str] = {
    # Scans, sinks, file state.
    "json_quarantine": _sql(
        [],
        """
        select event_id,
          case when event_type not in ('error', 'signup') then cast(json_extract_string(props, '$.k') as int)
            end as k,
          case event_type when 'error' then substr(props, 1, length(props) - 1)
            when 'signup' then replace(props, ': ', ': "x') end as corrupt_record
        from events""",
    ),
    "scan_partition_prune": _sql(
        [],
        """
        select cast(ts as date) as download_date, event_type, count(*) as rows from events
        where cast(ts as date) between date '2024-01-08' and date '2024-01-21' group by all""",
    ),
    "discover_new_files": _sql(
        _LEDGER,
        """
        select source_file from (select 'day=' || cast(d + 10 as varchar) as source_file from days)
        where source_file not in (select source_file from manifest where status = 'done')""",
    ),
    "anti_join_done": _sql(
        _LEGS,
        """
        select l_orderkey, l_linenumber, icao24, lastSeen from arr_legs a
        where not exists (select 1 from dep_legs d
          where d.l_orderkey = a.l_orderkey and d.l_linenumber = a.l_linenumber)""",
    ),
    "snapshot_changed": _sql(
        _LOG,
        """
        select dataset, source_file,
          last_hash is null or coalesce(file_hash, '') <> last_hash as needs_processing
        from current_files left join last_done using (dataset, source_file)""",
    ),
    "needs_processing": _sql(
        _LOG,
        """
        select dataset, source_file, last_hash is null or coalesce(file_hash, '') <> last_hash
          or version <> last_version as needs_processing
        from current_files left join last_done using (dataset, source_file)""",
    ),
    "version_gate": _sql(
        _LOG,
        """
        select dataset, source_file, version, not exists (select 1 from run_log r
          where r.status = 'done' and r.dataset = c.dataset and r.source_file = c.source_file
            and r.version = c.version) as needs_processing
        from current_files c""",
    ),
    "latest_manifest_row": _sql(
        _LOG,
        """
        select source_file, ingest_id, file_hash, version from run_log where status = 'done'
        order by processed_ts desc limit 1""",
    ),
    "manifest_merge": _sql(
        _LEDGER,
        """
        select coalesce(t.dataset, s.dataset) as dataset,
          coalesce(t.source_file, s.source_file) as source_file,
          case when use_new then s.ingest_id else t.ingest_id end as ingest_id,
          cast(epoch(case when use_new then s.processed_ts else t.processed_ts end) as bigint)
            as processed_ts,
          case when use_new then s.status else t.status end as status,
          case when use_new then s.file_hash else t.file_hash end as file_hash,
          case when use_new then s.version else t.version end as version
        from (select t, s, t.source_file is null or (s.source_file is not null and (
                t.status is distinct from s.status or t.file_hash is distinct from s.file_hash
                or t.version is distinct from s.version)) as use_new
              from manifest t full join incoming s using (dataset, source_file))""",
    ),
    "merge_upsert": _sql(
        _VERSIONS,
        """
        select * from new_legs union all by name
        select * from old_legs o where not exists (select 1 from new_legs n
          where n.l_orderkey = o.l_orderkey and n.l_linenumber = o.l_linenumber)""",
    ),
    "merge_set_columns": _sql(
        _VERSIONS,
        """
        select o.* replace (greatest(o.lastSeen, coalesce(n.lastSeen, o.lastSeen)) as lastSeen)
        from old_legs o left join new_legs n using (l_orderkey, l_linenumber)
        union all by name
        select * from new_legs n where not exists (select 1 from old_legs o
          where n.l_orderkey = o.l_orderkey and n.l_linenumber = o.l_linenumber)""",
    ),
    "upsert_newest": _sql(
        _VERSIONS,
        """
        select * from (select * from old_legs union all by name select * from new_legs)
        qualify row_number() over (partition by l_orderkey, l_linenumber
          order by lastSeen desc, _ingest_ts desc, icao24 desc, _source_file desc) = 1""",
    ),
    "merge_upsert_compound_key": _sql(
        [*_STATES],
        """
        , old as (select icao24, event_date_utc, count(*) as pings_count,
            quantile_disc(velocity_mps, 0.95) as p95_velocity,
            quantile_disc(geo_alt_m, 0.95) as p95_altitude
          from states where velocity_mps is not null group by all),
        new as (select icao24, event_date_utc, count(*) as pings_count,
            quantile_disc(velocity_mps, 0.95) as p95_velocity,
            quantile_disc(geo_alt_m, 0.95) as p95_altitude
          from states where geo_alt_m is not null group by all)
        select * from new union all
        select * from old o where not exists (select 1 from new n
          where n.icao24 = o.icao24 and n.event_date_utc = o.event_date_utc)""",
    ),
    "export_roundtrip": _sql(
        _DAILY, "select icao24, event_date_utc, pings_count, p95_velocity, p95_altitude from daily"
    ),
    # Files, lakes and streams.
    "json_file_scan": """
        select case when event_type <> 'error' then event_id end as event_id,
          case when event_type <> 'error' then user_id end as user_id,
          case when event_type <> 'error' then event_type end as event_type,
          case when event_type = 'error' then '{"event_id":' || event_id || ',"user_id":' || user_id
            || ',"event_type":"error"' end as corrupt_record
        from events""",
    "corrupt_counts": """
        select count(*) as rows_in, count(*) filter (event_type = 'error') as corrupt_rows from events""",
    "csv_file_scan": "select p_partkey, p_name, p_type, p_size, p_retailprice from part",
    "file_digests": """
        select strftime(o_orderdate, '%Y-%m') as month,
          md5(string_agg(o_orderkey::varchar || chr(10), '' order by o_orderkey)) as file_hash
        from orders group by 1""",
    "bronze_ingest": _sql(
        ["pings"],
        """
        select case when _ingest_ts % 50 <> 0 then icao24 end as icao24,
          case when _ingest_ts % 50 <> 0 then last_contact end as last_contact,
          case when _ingest_ts % 50 <> 0 then velocity end as velocity,
          case when day(download_date) <= 15 then 'run-1' else 'run-2' end as _ingest_id, download_date,
          case when _ingest_ts % 50 = 0 then '{"icao24":"' || icao24 || '"'
            || coalesce(',"time_position":' || time_position, '') || ',"last_contact":' || last_contact
            || coalesce(',"velocity":' || velocity, '') || coalesce(',"geo_altitude":' || geo_altitude, '')
            || ',"true_track":' || true_track end as corrupt_record
        from pings""",
    ),
    "lake_fact_states": _sql(
        _DAILY,
        """
        select icao24, event_date_utc, pings_count, round(coverage_pct, 6) as coverage_pct from daily""",
    ),
    "stream_ingest": _sql(
        ["pings"],
        "select icao24, last_contact, velocity, download_date from pings where _ingest_ts % 50 <> 0",
    ),
    "stream_upsert_late": """
        select o_orderkey, o_orderstatus,
          case when o_orderpriority = '1-URGENT' then 'newer' else o_orderpriority end as o_orderpriority,
          cast(case when o_orderpriority = '1-URGENT' then 3 else 2 end as int) as version
        from orders""",
    "observed_metrics": _sql(
        _STATES,
        """
        select 'silver.states' as dataset, 'run-1' as ingest_id, (select count(*) from clean_states) as rows_in,
          count(*) as rows_out,
          round(((select count(*) from clean_states) - count(*)) / (select count(*) from clean_states)::double, 6)
            as dup_ratio,
          'ok' as status, count(*) filter (velocity_mps is null) as null_velocities
        from states""",
    ),
    # Projections, filters, predicates.
    "select_allowlist": "select o_orderkey, o_orderstatus, o_custkey from orders",
    "path_timestamps": _sql(
        ["paths", "path_facts"],
        """
        select event_id, download_ts, directory_date,
          coalesce(cast(download_ts as date), directory_date, ingest_date) as download_date
        from path_facts""",
    ),
    "path_tag": _sql(
        ["paths"], "select event_id, upper(regexp_extract(path, '/tag=([^/]+)/', 1)) as tag from paths"
    ),
    "layer_metadata": f"""
        select event_id, 'v2.1.0' as _silver_version, {RUN_TS} as _silver_ts, 'run-7' as _silver_run_id,
          'events_job' as _silver_job, 'bronze.events' as _source from events""",
    "rename_cast": _sql(
        ["pings"],
        """
        select icao24, velocity as velocity_mps, geo_altitude as geo_alt_m,
          time_position as time_pos_raw, last_contact as last_contact_raw from pings""",
    ),
    "filter_keys_not_null": _sql(
        ["pings"],
        """
        select icao24, time_position, velocity from pings
        where icao24 is not null and time_position is not null and velocity is not null""",
    ),
    "validate_codes": _sql(
        ["raw_airports"],
        """
        select icao as raw_icao, iata as raw_iata, type,
          case when regexp_full_match(upper(trim(icao)), '[A-Z0-9]{4}') then upper(trim(icao)) end as icao,
          case when regexp_full_match(upper(trim(iata)), '[A-Z0-9]{3}') then upper(trim(iata)) end as iata
        from raw_airports""",
    ),
    "normalize_prefix": """
        select c_custkey,
          nullif(regexp_extract(upper(trim(c_mktsegment)), '^[A-Z]{2,4}', 0), '') as segment_prefix,
          nullif(regexp_extract(lower(c_mktsegment), '^[A-Z]{2,4}', 0), '') as lower_prefix,
          nullif(regexp_extract(upper(c_name), '^[A-Z]{2,4}', 0), '') as name_prefix
        from customer""",
    "outlier_flags": _sql(
        ["pings"],
        """
        select _ingest_ts as event_id, velocity < 0 or velocity > 350 as flag_velocity_outlier,
          geo_altitude < -500 or geo_altitude > 20000 as flag_alt_outlier from pings""",
    ),
    "unknown_flags": _sql(
        ["legs", "raw_airports", "airports", "clean_legs"],
        """
        select flight_id, dep_icao, arr_icao, dep_icao is null or d.iata is null as unknown_dep,
          arr_icao is null or a.iata is null as unknown_arr
        from clean_legs left join airports d on dep_icao = d.icao left join airports a on arr_icao = a.icao""",
    ),
    "geo_validity": _sql(
        ["pings"],
        """
        select _ingest_ts as event_id, case when latitude between -90 and 90 then latitude end as latitude,
          round(case when longitude between -180 and 180 then longitude end, 6) as longitude,
          round(case when true_track >= 360 then fmod(true_track, 360) else true_track end, 6) as true_track
        from pings""",
    ),
    "nonnegative_block_time": _sql(
        ["legs", "clean_legs"], "select flight_id, block_time_s from clean_legs where block_time_s >= 0"
    ),
    "bbox_filter": _sql(
        ["pings"],
        """
        select _ingest_ts as event_id, latitude, round(longitude, 6) as longitude from pings
        where latitude between 35 and 45 and longitude between -10 and 4""",
    ),
    # Joins.
    "enrich_airline": _sql(
        ["legs", "raw_airlines", "airlines", "clean_legs"],
        """
        select flight_id, callsign_norm, airline_prefix, airline_name
        from clean_legs left join airlines on airline_prefix = prefix""",
    ),
    "enrich_airports_role_playing": _sql(
        ["legs", "raw_airports", "airports", "clean_legs"],
        """
        select flight_id, dep_icao, d.iata as dep_iata, arr_icao, a.iata as arr_iata
        from clean_legs left join airports d on dep_icao = d.icao left join airports a on arr_icao = a.icao""",
    ),
    "enrich_salted": """
        select o_orderkey, o_custkey, c_mktsegment as segment
        from orders left join customer on o_custkey = c_custkey""",
    "enrich_no_fanout": _sql(
        ["legs", "raw_airlines", "airlines", "raw_airports", "airports", "clean_legs"],
        """
        select side, (select count(*) from lineitem) as rows, count(*) as matched
        from clean_legs join airlines on airline_prefix = prefix join airports on dep_icao = icao,
          (select unnest(['clean references', 'untidy references']) as side)
        group by side
        union all select 'before', (select count(*) from lineitem), 0""",
    ),
    "star_join": _sql(
        [*_FLIGHTS, "calendar"],
        """
        select c.year, c.quarter, c.is_weekend, p.region as airport_region, f.airline_name,
          count(*) as flights, cast(sum(f.block_time_s) as bigint) as block_time_s
        from flights f join calendar c on f.dep_date_utc = c.date
          join airports p on f.dep_icao = p.icao join airlines l on f.airline_prefix = l.prefix
        where f.airline_name is not null group by all""",
    ),
    "star_join_states": _sql(
        _DAILY,
        """
        select cast(year(event_date_utc) as int) as year, cast(quarter(event_date_utc) as int) as quarter,
          isodow(event_date_utc) >= 6 as is_weekend, count(*) as aircraft_days,
          cast(sum(pings_count) as bigint) as pings
        from daily group by all""",
    ),
    "stored_upsert_new_column": """
        select o_orderkey, o_orderstatus,
          case when o_orderpriority = '1-URGENT' then 'third' when o_orderstatus = 'O' then 'second' else 'first' end
            as batch,
          case when o_orderstatus = 'O' then o_orderpriority end as priority
        from orders""",
    "stored_upsert_moving_key": """
        select o_orderkey,
          case when o_orderpriority = '1-URGENT' then 'O' when o_orderstatus = 'P' then 'was: P/moved'
            else o_orderstatus end as o_orderstatus,
          case when o_orderpriority = '1-URGENT' then 'third' when o_orderstatus = 'P' then 'second'
            else 'first' end as batch
        from orders""",
    "flights_by_airport_role": _sql(
        _FLIGHTS,
        """
        select p.icao, p.name as airport_name, count(*) as flights, 'dep' as role
        from flights join airports p on dep_icao = p.icao group by all
        union all
        select p.icao, p.name, count(*), 'arr' from flights join airports p on arr_icao = p.icao group by all""",
    ),
    # Aggregations.
    "fact_states": _sql(
        _DAILY,
        """
        select * replace (round(pct_velocity_outlier, 6) as pct_velocity_outlier,
          round(pct_alt_outlier, 6) as pct_alt_outlier, round(coverage_pct, 6) as coverage_pct)
        from daily""",
    ),
    "p95_by_entity": _sql(
        _STATES,
        """
        select icao24, quantile_disc(velocity_mps, 0.95) as p95_velocity,
          quantile_disc(geo_alt_m, 0.95) as p95_altitude from states group by icao24""",
    ),
    "outlier_ratio": _sql(
        _STATES,
        """
        select icao24, round(avg(cast(flag_velocity_outlier as double)), 6) as pct_velocity_outlier,
          round(avg(cast(flag_alt_outlier as double)), 6) as pct_alt_outlier from states group by icao24""",
    ),
    "coverage_pct": _sql(
        ["pings"],
        """
        select icao24, download_date, count(*) as pings_count,
          round(count(*) / 960.0e0 * 100.0e0, 6) as coverage_pct from pings group by all""",
    ),
    "null_profile": _sql(
        ["pings"],
        """
        select cast(to_json({'icao24': count(*) - count(icao24),
          'time_position': count(*) - count(time_position),
          'last_contact': count(*) - count(last_contact), 'velocity': count(*) - count(velocity),
          'geo_altitude': count(*) - count(geo_altitude)}) as varchar) as nulls_json from pings""",
    ),
    "dup_ratio": _sql(
        ["pings", "clean_states", "hourly"],
        """
        select rows_in, rows_out, round((rows_in - rows_out) / cast(rows_in as double), 6) as dup_ratio
        from (select count(*) as rows_in, count(distinct (icao24, hour)) as rows_out from hourly)""",
    ),
    "unknown_pct": _sql(
        _FLIGHTS,
        """
        select round(count(*) filter (unknown_dep or unknown_arr) / cast(count(*) as double), 6)
          as unknown_pct from flights""",
    ),
    "freshness_lag": _sql(
        _STATES,
        f"""
        select round((epoch({RUN_TS}) - epoch(max(time_ts))) / 60.0e0, 6) as freshness_lag_minutes
        from states""",
    ),
    "outlier_counts": _sql(
        _STATES,
        """
        select cast(to_json({'velocity_outliers': count(*) filter (flag_velocity_outlier),
          'alt_outliers': count(*) filter (flag_alt_outlier)}) as varchar) as extras_json from states""",
    ),
    "run_metrics": _sql(
        _STATES,
        f"""
        select 'silver.states' as dataset, 'batch://silver.states/run-7' as source_key,
          'run-7' as ingest_id, {RUN_TS} as processed_ts, rows_in, rows_out,
          cast(0 as bigint) as corrupt_rows, nulls_json,
          '[{{"name": "icao24", "type": "string"}}, {{"name": "time_ts", "type": "timestamp"}}, '
          || '{{"name": "event_date_utc", "type": "date"}}, {{"name": "hour_of_day", "type": "tinyint"}}, '
          || '{{"name": "velocity_mps", "type": "double"}}, {{"name": "geo_alt_m", "type": "double"}}, '
          || '{{"name": "flag_velocity_outlier", "type": "boolean"}}, '
          || '{{"name": "flag_alt_outlier", "type": "boolean"}}, {{"name": "_ingest_ts", "type": "bigint"}}, '
          || '{{"name": "download_date", "type": "date"}}, {{"name": "_silver_version", "type": "string"}}, '
          || '{{"name": "_silver_ts", "type": "timestamp"}}]' as columns_json,
          round((rows_in - rows_out) / cast(rows_in as double), 6) as dup_ratio,
          cast(null as double) as unknown_pct, lag as freshness_lag_minutes, extras_json,
          'ok' as status, 'silver.states upsert ok' as notes
        from (select count(*) as rows_out, (select count(*) from clean_states) as rows_in,
            cast(to_json({{'icao24': count(*) - count(icao24), 'time_ts': count(*) - count(time_ts),
              'event_date_utc': count(*) - count(event_date_utc),
              'hour_of_day': count(*) - count(hour_of_day),
              'velocity_mps': count(*) - count(velocity_mps), 'geo_alt_m': count(*) - count(geo_alt_m),
              'flag_velocity_outlier': count(*) - count(flag_velocity_outlier),
              'flag_alt_outlier': count(*) - count(flag_alt_outlier)}}) as varchar) as nulls_json,
            round((epoch({RUN_TS}) - epoch(max(time_ts))) / 60.0e0, 6) as lag,
            cast(to_json({{'velocity_outliers': count(*) filter (flag_velocity_outlier),
              'alt_outliers': count(*) filter (flag_alt_outlier)}}) as varchar) as extras_json
          from states)""",
    ),
    "dataset_content_hash": _sql(
        ["raw_airports", "airports"],
        """
        select sha256(string_agg(h, '' order by h)) as content_hash
        from (select sha256(concat_ws('␟', icao, coalesce(iata, ''), name, city, region, type)) as h
              from airports)""",
    ),
    "dataset_tree_hash": """
        with hashed as (
          select sha256(concat_ws('␟', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
              cast(l_partkey as varchar), l_returnflag)) as h from lineitem),
        lanes as (
          select cast('0x' || substr(h, 1, 15) as bigint) as a, cast('0x' || substr(h, 16, 15) as bigint) as b,
            cast('0x' || substr(h, 31, 15) as bigint) as c, cast('0x' || substr(h, 46, 15) as bigint) as d
          from hashed)
        select sha256(concat_ws(':', count(*)::varchar, sum(a)::varchar, sum(b)::varchar, sum(c)::varchar,
            sum(d)::varchar)) as content_hash from lanes""",
    "stored_hash_after_upsert": """
        with hashed as (
          select sha256(concat_ws('␟', cast(o_orderkey as varchar),
              case when o_orderstatus = 'P' then 'O' else o_orderstatus end,
              case when o_orderstatus = 'O' then 'none' else o_orderpriority end)) as h from orders),
        lanes as (
          select cast('0x' || substr(h, 1, 15) as bigint) as a, cast('0x' || substr(h, 16, 15) as bigint) as b,
            cast('0x' || substr(h, 31, 15) as bigint) as c, cast('0x' || substr(h, 46, 15) as bigint) as d
          from hashed)
        select sha256(concat_ws(':', count(*)::varchar, sum(a)::varchar, sum(b)::varchar, sum(c)::varchar,
            sum(d)::varchar)) as content_hash from lanes""",
    "distinct_pairs": _sql(
        ["legs", "clean_legs"], "select distinct dep_icao, arr_icao from clean_legs"
    ),
    # Dedupe.
    "dedupe_latest": _sql(
        ["pings", "clean_states", "hourly"],
        """
        select * from hourly
        qualify row_number() over (partition by icao24, hour order by _ingest_ts desc) = 1""",
    ),
    "dedupe_earliest": _sql(
        ["pings", "clean_states", "hourly"],
        "select * from hourly qualify row_number() over (partition by icao24, hour order by _ingest_ts) = 1",
    ),
    "dedupe_nulls_last": _sql(
        ["pings", "clean_states", "hourly"],
        """
        select * from hourly qualify row_number() over (partition by icao24, hour
          order by velocity_mps desc nulls last, _ingest_ts desc) = 1""",
    ),
    "union_by_name": _sql(
        _LEGS,
        """
        select l_orderkey, l_linenumber, _source_file, callsign, cast(null as bigint) as lastSeen
        from dep_legs union all
        select l_orderkey, l_linenumber, _source_file, null, lastSeen from arr_legs""",
    ),
    # Scalar functions.
    "normalize_strings": _sql(
        ["legs"],
        """
        select l_orderkey, l_linenumber, upper(trim(estArrivalAirport)) as arr_icao,
          case when length(trim(callsign)) > 0 then upper(trim(callsign)) end as callsign_norm,
          lower(trim(estArrivalAirport)) as arr_lower from legs""",
    ),
    "initcap_names": f"""
        select p_partkey, {_initcap("'  ' || upper(p_name) || ' d''or/x ' || lower(p_type) || ' '")} as name
        from part""",
    "callsign_prefix": _sql(
        ["legs"],
        """
        select l_orderkey, l_linenumber, regexp_extract(c, '^[A-Z]+', 0) as prefix,
          nullif(regexp_extract(c, '^[A-Z]+', 0), '') as airline_prefix
        from (select *, nullif(upper(trim(callsign)), '') as c from legs)""",
    ),
    "route_key": _sql(
        ["legs"],
        """
        select l_orderkey, l_linenumber,
          concat_ws('→', upper(trim(estDepartureAirport)), upper(trim(estArrivalAirport))) as route_key
        from legs""",
    ),
    "flight_key": _sql(
        ["legs", "clean_legs"],
        """
        select icao24, dep_icao, arr_icao,
          sha256(concat_ws('|', icao24, dep_icao, arr_icao, strftime(first_seen_ts, '%Y-%m-%d %H:%M:%S'),
            strftime(last_seen_ts, '%Y-%m-%d %H:%M:%S'))) as joined_key, flight_id
        from clean_legs""",
    ),
    "epoch_to_ts": """
        select event_id, cast(floor(epoch(ts)) as bigint) as epoch_s, date_trunc('second', ts) as time_ts
        from events""",
    "calendar_columns": f"select o_orderkey, {_calendar_parts('o_orderdate', 'dep')} from orders",
    "dow_both": """
        select o_orderkey, cast(isodow(o_orderdate) - 1 as int) as dow_monday_0,
          cast(dayofweek(o_orderdate) + 1 as int) as dow_sunday_1 from orders""",
    "block_time": _sql(["legs", "clean_legs"], "select flight_id, block_time_s from clean_legs"),
    "dim_dates": """
        select date, cast(isodow(date) - 1 as tinyint) as dow, cast(week(date) as int) as week,
          strftime(date, '%Y-%m') as month, cast(quarter(date) as int) as quarter,
          cast(year(date) as int) as year, isodow(date) >= 6 as is_weekend
        from (select (select cast(max(ts) as date) from events) + cast(i as int) as date
              from range(-1825, 731) r(i))""",
    "decode_positional": _sql(
        ["pings"],
        """
        select _ingest_ts as event_id, icao24,
          case when velocity is not null then 'IBE' || _ingest_ts end as callsign,
          'Spain' as origin_country, time_position, last_contact, cast(null as double) as longitude,
          latitude, cast(null as double) as baro_altitude, _ingest_ts % 2 = 1 as on_ground, velocity,
          true_track, cast(null as double) as vertical_rate, geo_altitude, '7000' as squawk, false as spi,
          0 as position_source, case when _ingest_ts % 2 = 1 then 3 end as category
        from pings""",
    ),
    "priority_topk": _sql(
        ["raw_airports"],
        """
        select icao, cast(nullif(list_position(['N017', 'N003', 'LEMD', 'N011'], icao), 0) as int) as priority
        from (select distinct upper(trim(icao)) as icao from raw_airports where trim(icao) <> '')
        order by priority nulls last, icao limit 12""",
    ),
    # Data products.
    "silver_states": _sql(_STATES, "select * from states"),
    "silver_flights": _sql(
        [*_REFS, *_LEGS, "dep_feed", "arr_feed"],
        "select * from dep_feed union all by name select * from arr_feed",
    ),
    "silver_ref_airlines": _sql(["raw_airlines", "airlines"], "select * from airlines"),
    "silver_ref_airports": _sql(["raw_airports", "airports"], "select * from airports"),
    "fact_flights": _sql(_FLIGHTS, "select * from flights"),
    "dim_airports": _sql(
        ["raw_airports", "airports"],
        f"""
        select *, 'v1.0.0' as _gold_version, {RUN_TS} as _gold_ts, 'manual' as _gold_run_id,
          'build_dim_airports' as _gold_job, 'silver.ref_airports' as _source from airports""",
    ),
    "dim_prefixes": _sql(
        ["raw_airlines", "airlines"],
        f"""
        select *, 'v1.0.0' as _gold_version, {RUN_TS} as _gold_ts, 'manual' as _gold_run_id,
          'build_dim_prefixes' as _gold_job, 'silver.ref_airlines_prefixes' as _source from airlines""",
    ),
    "dim_airlines": _sql(
        _FLIGHTS,
        f"""
        select distinct airline_prefix, airline_name, 'v1.0.0' as _gold_version, {RUN_TS} as _gold_ts,
          'manual' as _gold_run_id, 'build_dim_airlines' as _gold_job, 'gold.fact_flights' as _source
        from flights where airline_name is not null""",
    ),
    # Measures.
    "kpi_cards": _sql(
        [*_FLIGHTS, *_DAILY],
        """
        select card, round(value, 6) as value from (
          unpivot (select cast(count(*) as double) as flights, cast(count(arr_icao) as double) as flights_arrivals,
              cast(count(dep_icao) as double) as flights_departures,
              avg(block_time_s / 60.0e0) as avg_block_time_min,
              quantile_cont(block_time_s / 60.0e0, 0.5) as median_block_time_min,
              avg(cast(unknown_dep as double)) * 100 as unknown_dep_pct,
              avg(cast(unknown_arr as double)) * 100 as unknown_arr_pct from flights)
            on columns(*) into name card value value
          union all
          unpivot (select avg(coverage_pct) as coverage_pct, avg(pct_velocity_outlier) as velocity_outlier_ratio,
              avg(pct_alt_outlier) as altitude_outlier_ratio, quantile_cont(p95_velocity, 0.95) as p95_velocity,
              quantile_cont(p95_altitude, 0.95) as p95_altitude from daily)
            on columns(*) into name card value value)""",
    ),
    "top_routes": _sql(
        _FLIGHTS,
        """
        select route_key, count(*) as flights, round(avg(block_time_s / 60.0e0), 6) as avg_block_min
        from flights group by route_key order by flights desc, route_key limit 20""",
    ),
    "top_airports": _sql(
        [*_FLIGHTS, "airport_counts"],
        """
        select icao, departures, arrivals, name as airport_name, departures + arrivals as movements
        from airport_counts join airports using (icao) order by movements desc, icao limit 10""",
    ),
    "top_airlines": _sql(
        _FLIGHTS,
        """
        select airline_name, count(*) as flights from flights where airline_name is not null
        group by airline_name order by flights desc, airline_name limit 3""",
    ),
    "median_block_time": _sql(
        _FLIGHTS,
        "select round(quantile_cont(block_time_s / 60.0e0, 0.5), 6) as median_block_time_min from flights",
    ),
    "airline_share": _sql(
        _FLIGHTS,
        """
        select airline_name, count(*) as flights,
          round(count(*) / sum(count(*)) over () * 100.0e0, 6) as share_pct
        from flights group by airline_name""",
    ),
    "hour_dow_heatmap": _sql(
        _FLIGHTS,
        "select arr_dow as dow, arr_hour as hour, count(*) as flights from flights group by all",
    ),
    "daily_trend": _sql(
        [*_FLIGHTS, "calendar"],
        """
        select date, count(*) filter (role = 'dep') as departures, count(*) filter (role = 'arr') as arrivals
        from calendar left join (
          select dep_date_utc as d, 'dep' as role from flights where dep_icao is not null
          union all select arr_date_utc, 'arr' from flights where arr_icao is not null) on d = date
        group by date""",
    ),
    "weekly_trend": _sql(
        _FLIGHTS,
        """
        select dep_week as week, count(*) as flights, round(avg(block_time_s / 60.0e0), 6) as avg_block_min
        from flights group by dep_week""",
    ),
    "monthly_trend": _sql(
        _FLIGHTS,
        """
        select arr_month as month, count(*) as flights, round(avg(block_time_s / 60.0e0), 6) as avg_block_min
        from flights group by arr_month""",
    ),
    "coverage_by_day": _sql(
        _DAILY,
        """
        select event_date_utc, round(avg(coverage_pct), 6) as coverage_pct, count(*) as aircraft,
          cast(sum(pings_count) as bigint) as pings from daily group by event_date_utc""",
    ),
    "p95_of_p95": _sql(
        _DAILY,
        """
        select 'p95_velocity' as measure, round(quantile_cont(p95_velocity, 0.95), 6) as value from daily
        union all select 'p95_altitude', round(quantile_cont(p95_altitude, 0.95), 6) from daily""",
    ),
    "outlier_pct_by_day": _sql(
        _DAILY,
        """
        select event_date_utc, round(avg(pct_velocity_outlier), 6) as velocity_outlier_ratio,
          round(avg(pct_alt_outlier), 6) as altitude_outlier_ratio from daily group by event_date_utc""",
    ),
    "unknown_airport_pct": _sql(
        _FLIGHTS,
        """
        select round(avg(cast(unknown_dep as double)) * 100, 6) as unknown_dep_pct,
          round(avg(cast(unknown_arr as double)) * 100, 6) as unknown_arr_pct from flights""",
    ),
    "turnaround": _sql(
        _FLIGHTS,
        """
        select flight_id, icao24, last_seen_ts, n as next_departure_ts,
          cast(epoch(n) - epoch(last_seen_ts) as bigint) as turnaround_s
        from (select *, lead(first_seen_ts) over (partition by icao24
                order by first_seen_ts, last_seen_ts, flight_id) as n from flights)""",
    ),
    "block_time_percentiles": _sql(
        _FLIGHTS,
        """
        select q, round(v, 6) as block_time_min
        from (select unnest([0.25e0, 0.5e0, 0.75e0, 0.95e0]) as q,
            unnest(quantile_cont(block_time_s / 60.0e0, [0.25, 0.5, 0.75, 0.95])) as v from flights)""",
    ),
    "kpi_sliced": _sql(
        _FLIGHTS,
        """
        select route_key, count(*) as flights, round(avg(block_time_s / 60.0e0), 6) as avg_block_min
        from flights
        where dep_date_utc between date '1996-01-01' and date '1997-12-31'
          and (dep_icao in ('N001', 'N002', 'N003', 'N005', 'N008')
            or arr_icao in ('N001', 'N002', 'N003', 'N005', 'N008'))
          and airline_name in ('Household Express', 'Building Air')
        group by route_key order by flights desc, route_key limit 50""",
    ),
}
