"""The same questions in ANSI SQL, for a second engine on the same tables.

Written from the rules and not from the DataFrame code: geohashes come bit by bit, digests
from the engine's own ``printf``, first deliveries from ranking.
"""

from __future__ import annotations

from tripweave.functions.cells import ALPHABET
from tripweave.plans.catalog import BOX, BOXES, HALF_TIME, NOWHERE, REGION, SOURCE

MARKED = "2024-06-01 00:00:00"


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _instant_text(ts: str) -> str:
    micros = f"(epoch_us({ts}) % 1000000)"
    fraction = f"case when {micros} = 0 then '' else '.' || lpad(cast({micros} as varchar), 6, '0') end"
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || {fraction} || 'Z')"


def _geohash(lon: str, lat: str, precision: int) -> str:
    bits = 5 * precision
    lon_bits, lat_bits = bits - bits // 2, bits // 2

    def index(value: str, low: float, span: float, n: int) -> str:
        scaled = f"floor(({value} - ({low})) / {span} * cast({2**n} as double))"
        return f"cast(least(greatest({scaled}, 0), {2**n - 1}) as bigint)"

    axes = [index(lon, -180.0, 360.0, lon_bits), index(lat, -90.0, 180.0, lat_bits)]
    left = [lon_bits, lat_bits]
    symbols = []
    for i in range(precision):
        terms = []
        for weight in (16, 8, 4, 2, 1):
            axis = (bits - left[0] - left[1]) % 2
            left[axis] -= 1
            terms.append(f"(({axes[axis]} >> {left[axis]}) & 1) * {weight}")
        symbols.append(f"substr('{ALPHABET}', cast({' + '.join(terms)} as integer) + 1, 1)")
    hashed = " || ".join(symbols)
    return f"(case when {lon} is not null and {lat} is not null then {hashed} end)"


def _digest(columns: str = "") -> str:
    c = columns
    numbers = " || '|' || ".join(
        f"printf('%.6f', {c}{name})"
        for name in ("origin_lon", "origin_lat", "destination_lon", "destination_lat")
    )
    return (
        f"sha256(lower(trim({c}region)) || '|' || {numbers} || '|' || "
        f"{_instant_text(c + 'ts')} || '|' || lower(trim({c}datasource)))"
    )


RAW = """raw as (
  select 'ing-' || cast(event_id % 4 as varchar) as ingestion_id,
         cast(event_id as bigint) + 1 as row_number,
         event_type as region,
         case when event_id % 97 = 0 then cast(200 as double)
              when event_id % 101 = 0 then null
              else cast(user_id % 4 as double) * 10 - 15 + cast(user_id % 3 as double) / 16384
         end as origin_lon,
         case when event_id % 89 = 0 then cast(-95 as double)
              else cast(user_id % 4 as double) * 8 + 5 + cast(event_id % 3 as double) / 16384
         end as origin_lat,
         cast(event_id % 2 as double) * 10 - 25 as destination_lon,
         cast(event_id % 2 as double) * 15 - 20 as destination_lat,
         ts,
         'src_' || cast(user_id % 5 as varchar) as datasource
  from events
)"""

SENT = f"""sent as (
  select *, {_digest()} as trip_id, {_instant_text('ts')} as instant_text,
         origin_lon not between -180 and 180 or origin_lat not between -90 and 90 as outside
  from raw
)"""

ROUTED = """routed as (
  select *, case when coalesce(outside, false) then 'coordinate_out_of_range'
                 when origin_lon is null then 'null_coordinate' end as reject_reason
  from sent
)"""

VALID = """valid as (
  select * from sent
  where origin_lon between -180 and 180 and origin_lat between -90 and 90
    and destination_lon between -180 and 180 and destination_lat between -90 and 90
)"""

# Both deliveries, each with its time on the log.
DELIVERED = """delivered as (
  select ingestion_id, row_number, trip_id, reject_reason, origin_lon, origin_lat,
         ts as log_time from routed
  union all
  select 'ing-re', row_number, trip_id, reject_reason, origin_lon, origin_lat,
         ts + interval 40 day from routed
)"""

FIRST = """first_delivered as (
  select * from (
    select *, row_number() over (partition by trip_id
                                 order by log_time, row_number, ingestion_id) as rank
    from delivered where reject_reason is null
  ) where rank = 1
)"""

ANNOUNCED = """announced as (
  select 'ing-' || cast(event_id % 4 as varchar) as ingestion_id,
         count(*) + case when event_id % 4 = 3 then 1 else 0 end as total_rows
  from events group by event_id % 4
  union all select 'ing-re', count(*) from events
  union all select 'ing-empty', 0
)"""

TRIPS = _with(RAW, SENT, VALID)
LOG = _with(RAW, SENT, ROUTED, DELIVERED, FIRST, ANNOUNCED)

CLUSTERS_CTE = f"""clusters as (
  select origin_cell, destination_cell, time_bucket, count(*) as trip_count,
         cast(weekofyear(time_bucket) as integer) as iso_week
  from (
    select {_geohash('origin_lon', 'origin_lat', 7)} as origin_cell,
           {_geohash('destination_lon', 'destination_lat', 7)} as destination_cell,
           time_bucket(interval '30 minutes', ts) as time_bucket
    from valid
  ) group by all
)"""
CLUSTERS = _with(RAW, SENT, VALID, CLUSTERS_CTE)
CLUSTER_COLUMNS = (
    "origin_cell, destination_cell, cast(time_bucket as varchar) as time_bucket, "
    "trip_count, iso_week"
)

HOMES = """trips as (
  select r_name as region, o_orderdate as ts
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""

WEEK_AVERAGE = """
select coalesce(avg(trips), cast(0 as double)) as weekly_average,
       count(*) as num_weeks, cast(coalesce(sum(trips), 0) as bigint) as total_trips
from (select date_trunc('week', ts) as week, count(*) as trips from valid where {area} group by all)"""


def _box(box: tuple[float, ...]) -> str:
    west, east = sorted((box[0], box[2]))
    south, north = sorted((box[1], box[3]))
    return (
        f"origin_lon > {west} and origin_lon < {east} "
        f"and origin_lat > {south} and origin_lat < {north}"
    )


def _metrics(source: str, year: str = "") -> str:
    return f"""
select region, {year} cast(weekofyear(ts) as integer) as iso_week, count(*) as trip_count,
       count(*) / cast(7 as double) as avg_trips_per_day
from {source} group by all"""


SILVER_COLUMNS = """ingestion_id, row_number, trip_id, region, origin_lon, origin_lat,
  destination_lon, destination_lat, instant_text as datetime, datasource,
  cast(ts as varchar) as kafka_timestamp"""

KEYS = "trip_id, ingestion_id, row_number, cast(log_time as varchar) as kafka_timestamp"

SPLIT_COUNTS = (
    LOG
    + """
select case when reject_reason is null then 'trip' else 'rejected' end as route, reject_reason,
       count(*) as events from delivered group by all
union all select 'marker', null, count(*) from announced
union all select 'unknown', null, count(*) from conversations
union all select 'rejected', 'malformed_payload', count(*) from documents"""
)

REJECTED = (
    LOG
    + """
select ingestion_id, row_number, trip_id, reject_reason, count(*) as events,
       min(origin_lon) as origin_lon, min(origin_lat) as origin_lat
from delivered where reject_reason is not null group by all
union all
select null, null, null, 'malformed_payload', count(*), null, null from documents"""
)

MARKER_ROWS = (
    LOG
    + f"""
select ingestion_id, ingestion_id || ':end' as control_id,
       total_rows, '{MARKED}' as kafka_timestamp
from announced"""
)

POINTS = """'POINT (' || cast({e}_lon as varchar) || ' ' || cast({e}_lat as varchar) || ')' as {e}_geom"""
GEOMS = POINTS.format(e="origin") + ", " + POINTS.format(e="destination")

SERVING = (
    TRIPS
    + f"""
select trip_id, ingestion_id, region, origin_lon, origin_lat, destination_lon, destination_lat,
       {_geohash('origin_lon', 'origin_lat', 7)} as origin_geohash,
       {_geohash('destination_lon', 'destination_lat', 7)} as destination_geohash,
       cast(ts as varchar) as datetime, datasource, {GEOMS}
from valid"""
)

# Rows of an upload with an empty coordinate are short of a field, not out of range.
UPLOAD = f"""upload as (
  select *, case when origin_lon is null or origin_lat is null then 'missing_field'
                 when outside then 'coordinate_out_of_range' end as reject_reason
  from sent
)"""
UPLOADS = _with(RAW, SENT, UPLOAD)
SENT_COUNTS = """
  select ingestion_id, count(*) filter (where reject_reason is null) as sent
  from upload group by ingestion_id"""
PROGRESS = f"""
select ingestion_id, unnest(range(100, sent + 1, 100)) as rows from ({SENT_COUNTS})"""

HELD = """report as (
  select m.ingestion_id, m.total_rows, coalesce(s.stored_rows, 0) as stored_rows,
         coalesce(d.valid_rows, 0) - coalesce(s.stored_rows, 0) as duplicate_rows,
         coalesce(d.rejected_rows, 0) as rejected_rows,
         coalesce(d.valid_rows, 0) + coalesce(d.rejected_rows, 0) >= m.total_rows as complete
  from announced m
  left join (select ingestion_id, count(*) filter (where reject_reason is null) as valid_rows,
                    count(*) filter (where reject_reason is not null) as rejected_rows
             from delivered group by ingestion_id) d using (ingestion_id)
  left join (select ingestion_id, count(*) as stored_rows
             from first_delivered group by ingestion_id) s using (ingestion_id)
)"""
COMPLETION = _with(RAW, SENT, ROUTED, DELIVERED, FIRST, ANNOUNCED, HELD)


def _ids(names: str, name: str, id_name: str) -> str:
    order = f"substr(md5({name}), 1, 3), {name}"
    return f"select cast(row_number() over (order by {order}) as bigint) as {id_name}, {name} from ({names})"


BROKEN_RULES = """
select 'trip_row_number_from_1' as rule, count(*) as broken from documents
union all select 'trip_required_fields',
  (select count(*) from delivered where trip_id is null or origin_lon is null)
  + (select count(*) from documents)
union all select 'marker_total_rows_from_0',
  (select count(*) from announced where coalesce(total_rows, -1) < 0)
union all select 'marker_required_fields',
  (select count(*) from announced where ingestion_id is null)
union all select 'known_record_type', count(*) from conversations"""

BOX_AVERAGES = " union all ".join(
    f"select cast({n} as integer) as box, * from ({WEEK_AVERAGE.format(area=_box(box))})"
    for n, box in enumerate(BOXES)
)

REGION_AVERAGES = """
select region, ((200 * sum(trips) + count(*)) // (2 * count(*))) / cast(100 as double) as weekly_average,
       count(*) as num_weeks, cast(sum(trips) as bigint) as total_trips
from (select region, date_trunc('week', ts) as week, count(*) as trips from valid group by all)
group by region"""

ORACLES: dict[str, str] = {
    "parse_points": _with(RAW)
    + """
select ingestion_id, row_number,
       case when origin_lat is not null then origin_lon end as origin_lon,
       case when origin_lon is not null then origin_lat end as origin_lat,
       destination_lon, destination_lat
from raw""",
    "trip_ids": _with(RAW, SENT)
    + "select ingestion_id, row_number, trip_id, instant_text as datetime from sent",
    "geohash_cells": _with(RAW)
    + f"""
select ingestion_id, row_number,
       {_geohash('origin_lon', 'origin_lat', 7)} as origin_geohash,
       {_geohash('destination_lon', 'destination_lat', 7)} as destination_geohash
from raw""",
    "geohash_precisions": _with(RAW)
    + "select ingestion_id, row_number, "
    + ", ".join(f"{_geohash('origin_lon', 'origin_lat', p)} as geohash_{p}" for p in (1, 4, 8, 12))
    + " from raw",
    "time_buckets": """
select event_id, cast(time_bucket(interval '30 minutes', ts) as varchar) as half_hour,
       cast(time_bucket(interval '5 minutes', ts) as varchar) as five_minutes
from events""",
    "iso_weeks": """
select o_orderkey, cast(weekofyear(o_orderdate) as integer) as iso_week,
       cast(isoyear(o_orderdate) as integer) as iso_year,
       cast(cast(date_trunc('week', o_orderdate) as timestamp) as varchar) as week_start
from orders""",
    "events_flattened": _with(RAW, SENT) + f"select {SILVER_COLUMNS} from sent",
    "split_counts": SPLIT_COUNTS,
    "silver_trips": TRIPS + f"select {SILVER_COLUMNS} from valid",
    "rejected_trips": REJECTED,
    "markers": MARKER_ROWS,
    "contract_expectations": LOG + BROKEN_RULES,
    "stream_expectations": LOG + BROKEN_RULES,
    "dedup_first_wins": LOG + f"select {KEYS} from first_delivered",
    "merge_insert": LOG
    + f"""
select {KEYS} from first_delivered where trip_id not in (
  select trip_id from delivered
  where reject_reason is null and log_time < timestamp '{HALF_TIME}')""",
    "redelivery": TRIPS
    + """
select 'stored' as step, count(*) as trips from valid
union all select 'delivered', count(*) from valid
union all select 'added', count(distinct again.trip_id) - count(distinct stored.trip_id)
from valid again left join valid stored using (trip_id)""",
    "clusters": CLUSTERS + f"select {CLUSTER_COLUMNS} from clusters",
    "top_clusters": CLUSTERS
    + f"""
select {CLUSTER_COLUMNS} from (
  select * from clusters
  order by trip_count desc, origin_cell, destination_cell, time_bucket limit 10)""",
    "clusters_by_week": CLUSTERS
    + "select iso_week, cast(sum(trip_count) as bigint) as total_trips from clusters group by iso_week",
    "cluster_total": CLUSTERS + "select count(*) as clusters from clusters",
    "weekly_metrics": _with(HOMES) + _metrics("trips"),
    "weekly_metrics_by_year": _with(HOMES)
    + _metrics("trips", "cast(isoyear(ts) as integer) as iso_year,"),
    "weekly_metrics_trips": TRIPS + _metrics("valid"),
    "weekly_average_region": TRIPS + WEEK_AVERAGE.format(area=f"region = '{REGION}'"),
    "weekly_average_bbox": TRIPS + WEEK_AVERAGE.format(area=_box(BOX)),
    "weekly_average_none": TRIPS + WEEK_AVERAGE.format(area=_box(NOWHERE)),
    "weekly_average_all": TRIPS + REGION_AVERAGES,
    "weekly_average_answer": TRIPS
    + f"""
select '{{"weekly_average":' || cast(weekly_average as varchar) || ',"num_weeks":' || num_weeks
       || ',"total_trips":' || total_trips || ',"filter":{{"region":"{REGION}"}}}}' as answer
from ({WEEK_AVERAGE.format(area=f"region = '{REGION}'")})""",
    "weekly_counts_bbox": TRIPS
    + f"""
select cast(cast(date_trunc('week', ts) as timestamp) as varchar) as week_start, count(*) as trips
from valid where {_box(BOX)} group by all""",
    "trips_per_region": TRIPS + "select region, count(*) as trips from valid group by region",
    "top_regions": TRIPS
    + """
select region, count(*) as trips from valid group by region
order by trips desc, region limit 2""",
    "latest_source_top_regions": TRIPS
    + """
select region, datasource, cast(ts as varchar) as datetime from (
  select *, row_number() over (partition by region order by ts desc, trip_id) as place
  from valid where region in (select region from valid group by region
                              order by count(*) desc, region limit 2)
) where place = 1""",
    "regions_of_source": TRIPS
    + f"select distinct region from valid where datasource = '{SOURCE}'",
    "stored_per_ingestion": TRIPS
    + "select ingestion_id, count(*) as stored_rows from valid group by ingestion_id",
    "dim_regions": TRIPS + _ids("select distinct region from valid", "region", "region_id"),
    "dim_datasources": _with(
        "names as (select c_name as datasource, bool_or(c_mktsegment = 'BUILDING') as known "
        "from customer group by c_name)"
    )
    + """
select cast(row_number() over (order by not known, substr(md5(datasource), 1, 3), datasource)
            as bigint) as datasource_id, datasource
from names""",
    "trip_points": TRIPS + f"select trip_id, {GEOMS} from valid",
    "serving_trips": SERVING,
    "upload_split": UPLOADS
    + """
select ingestion_id, row_number, case when reject_reason is null then trip_id end as trip_id,
       instant_text as datetime, reject_reason
from upload""",
    "end_markers": UPLOADS
    + f"""
select 'ingestion_end' as record_type, ingestion_id, ingestion_id || ':end' as control_id,
       sent as total_rows
from ({SENT_COUNTS})""",
    "sent_progress": UPLOADS + PROGRESS,
    "ingestion_status": UPLOADS
    + f"""
select ingestion_id, 'STARTED' as status, cast(null as bigint) as rows from ({SENT_COUNTS})
union all select ingestion_id, 'IN_PROGRESS', rows from ({PROGRESS})
union all select ingestion_id, 'COMPLETED', sent from ({SENT_COUNTS})""",
    "ingestion_completion": COMPLETION + "select * from report",
    "csv_uploads": TRIPS
    + """
select trip_id, region, origin_lon, origin_lat, destination_lon, destination_lat,
       instant_text as datetime, datasource from valid""",
    "completion_unnumbered": """
select lang as ingestion_id, count(distinct text) as total_rows, cast(0 as bigint) as stored_rows,
       cast(0 as bigint) as duplicate_rows, count(distinct text) as rejected_rows, true as complete
from documents group by lang""",
    "csv_mixed_headers": TRIPS
    + """
select trip_id, region, instant_text as datetime, datasource, true as numbered from valid""",
    "csv_quoted_breaks": """
select doc_id, lang, 'POINT (1 2), "x"' as origin_coord, sha256(coalesce(text, '')) as text_sha256,
       true as in_order
from documents""",
    "csv_row_numbers": "select count(*) as rows, true as numbered_from_1 from events",
    "stream_bronze": SPLIT_COUNTS,
    "stream_silver": TRIPS + f"select {SILVER_COLUMNS} from valid",
    "stream_rejected": REJECTED,
    "stream_markers": MARKER_ROWS,
    "stream_clusters": CLUSTERS + f"select {CLUSTER_COLUMNS} from clusters",
    "stream_weekly": TRIPS + _metrics("valid"),
    "stream_cluster_latest": CLUSTERS + f"select {CLUSTER_COLUMNS} from clusters",
    "stream_cluster_rollup": CLUSTERS + f"select {CLUSTER_COLUMNS} from clusters",
    "stream_weekly_rollup": TRIPS + _metrics("valid"),
    "stream_dedup_state": LOG + f"select {KEYS} from first_delivered",
    "stream_serving": SERVING,
    "stream_lookups": TRIPS
    + f"""
select 'regions' as lookup, region_id as id, region as name
from ({_ids('select distinct region from valid', 'region', 'region_id')})
union all
select 'datasources', datasource_id, datasource
from ({_ids('select distinct datasource from valid', 'datasource', 'datasource_id')})""",
    "stream_rate_limited": """
select count(*) as events, true as ended from events group by event_id % 5""",
    "stream_guards": TRIPS
    + """
select count(*) as served, count(ts) as stamped, count(distinct case when ts is not null then 1 end)
       as batches from valid""",
    "upload_ingestions": """
select count(*) as rows, count(*) filter (event_id is null) as wrong,
       count(distinct event_type) - count(distinct event_type) as too_many
from events""",
    "table_additive_column": TRIPS
    + f"""
select case when ts >= timestamp '{HALF_TIME}' then ingestion_id end as ingestion_id,
       count(*) as trips
from valid group by 1""",
    "stream_bounded_dedup": TRIPS
    + "select trip_id, region, instant_text as datetime, datasource from valid",
    "foreign_redelivery": TRIPS
    + """
select 'trip-' || row_number as trip_id, ingestion_id, row_number from valid
union all select 'new-trip-' || row_number, 'ing-re', row_number from valid
where row_number % 250 = 0""",
    "weekly_average_cover": TRIPS + BOX_AVERAGES,
    "stream_box_average": TRIPS + BOX_AVERAGES,
    "stream_region_averages": TRIPS + REGION_AVERAGES,
    "stream_tiered_rollup": CLUSTERS + f"select {CLUSTER_COLUMNS} from clusters",
    "stream_compacted": CLUSTERS
    + f"""
, kept as (select * from valid),
weeks as ({_metrics('valid')})
select 'silver' as answer, count(*) as rows, cast(sum(row_number) as bigint) as total,
       true as unchanged from kept
union all select 'serving', count(*), cast(sum(7) as bigint), true from kept
union all select 'weeks', count(*), cast(sum(trip_count) as bigint), true from weeks
union all select 'clusters', count(*), cast(sum(trip_count) as bigint), true from clusters
union all select 'averages', count(distinct region), count(*), true from kept""",
    "stream_uploads": TRIPS
    + "select count(*) as announced, count(*) as stored, true as all_complete from valid",
    "stream_status": COMPLETION
    + """
select ingestion_id, unnest(['BRONZE_COMPLETED', 'SILVER_COMPLETED']) as status,
       total_rows, cast(null as bigint) as stored_rows
from announced
union all
select ingestion_id, 'TRIPS_PG_COMPLETED', total_rows, stored_rows from report where complete""",
    "stream_status_feed": COMPLETION
    + """
select ingestion_id, unnest(['BRONZE_COMPLETED', 'SILVER_COMPLETED']) as status,
       total_rows, cast(null as bigint) as stored_rows
from announced
union all
select ingestion_id, 'TRIPS_PG_COMPLETED', total_rows, stored_rows from report where complete""",
}
