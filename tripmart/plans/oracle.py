"""SQL (DuckDB dialect) that states the expected result of each registered query."""

from __future__ import annotations

# White space as text tools see it, and the two questions of the scoring exchange.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BATCH_QUESTION = (
    ".\nQuestion: Is this trip anomalous for the pickup borough? Return a JSON object with keys:"
    " score (0-1), is_anomaly (true/false), explanation (one short sentence)."
)
SINGLE_QUESTION = (
    "\nQuestion: Is this trip anomalous for the pickup borough?"
    " Return JSON: {score:0-1, is_anomaly: true/false, explanation: '...'}"
)

AS_OF = "timestamp '2026-01-01 00:00:00'"
SECOND_RUN = "timestamp '2026-01-02 00:00:00'"
CUT = "timestamp '2024-06-01 00:00:00'"
FUTURE_AS_OF = "timestamp '2025-06-01 00:00:00'"


def _r(value: str, places: int = 2) -> str:
    return f"cast(round(cast({value} as decimal(28,10)), {places}) as double)"


def _sum(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(18,8))) as double)"


def _avg(value: str) -> str:
    return f"{_sum(value)} / nullif(count({value}), 0)"


def _text(value: str) -> str:
    return f"coalesce(cast({value} as varchar), 'None')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WITH = {
    "zones": """select cast(n_nationkey as bigint) as locationid, r_name as borough, n_name as zone,
        case n_nationkey % 3 when 0 then 'Yellow Zone' when 1 then 'Boro Zone' else 'EWR' end as service_zone
        from nation join region on n_regionkey = r_regionkey""",
    "dim": "select locationid as location_id, borough, zone, service_zone from zones where locationid is not null",
    "timed": """select *,
        l_shipdate + interval '24' year + ((l_orderkey*7 + l_partkey*13) % 86400) * interval '1' second as p,
        case when l_orderkey % 107 = 0 then 30000
             else (l_suppkey*37 + cast(l_quantity as int)*61) % 5400 + 20 end as dur
        from lineitem""",
    "raw": """select
        cast(1 + l_linenumber % 2 as bigint) as vendorid,
        case when l_partkey % 97 = 0 then 'corrupt' when l_partkey % 89 = 0 then '1970-01-01 00:00:00'
             else cast(p as varchar) end as tpep_pickup_datetime,
        case when l_partkey % 83 = 0 then null
             else cast(p + dur * interval '1' second as varchar) end as tpep_dropoff_datetime,
        case when l_partkey % 50 = 0 then null
             else cast(cast(l_quantity as int) % 12 as bigint) end as passenger_count,
        case when (l_orderkey + l_linenumber) % 103 = 0 then (l_partkey % 300) * 2.0e0
             else (l_partkey % 300) / 10.0e0 end as trip_distance,
        1 + l_suppkey % 6 as ratecodeid,
        case when l_returnflag = 'R' then 'Y' else 'N' end as store_and_fwd_flag,
        l_suppkey % 27 as pulocationid,
        l_partkey % 26 as dolocationid,
        cast(l_linenumber as bigint) as payment_type,
        case when l_orderkey % 101 = 0 then l_extendedprice / 100e0
             else l_extendedprice / 1000e0 - 1.0e0 end as fare_amount,
        l_tax * 10e0 as extra, 0.5e0 as mta_tax,
        l_extendedprice * l_discount / 1000e0 as tip_amount,
        case when l_partkey % 10 = 0 then 6.55e0 else 0e0 end as tolls_amount,
        0.3e0 as improvement_surcharge,
        l_extendedprice * (1 + l_discount + l_tax) / 1000e0 as total_amount,
        case when l_partkey % 5 = 0 then null else 2.5e0 end as congestion_surcharge,
        case when l_suppkey % 3 = 0 then null else 1.25e0 end as airport_fee,
        case when l_linenumber % 2 = 0 then null else 0.75e0 end as cbd_congestion_fee
        from timed""",
    "stg_w": f"""select pickup_ts, dropoff_ts, trip_distance, passenger_count, pulocationid, dolocationid, ratecodeid,
        store_and_fwd_flag, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
        congestion_surcharge, coalesce(airport_fee, 0) as airport_fee,
        coalesce(cbd_congestion_fee, 0) as cbd_congestion_fee, total_amount, payment_type, vendorid,
        {AS_OF} as _dbt_loaded_at,
        datediff('minute', pickup_ts, dropoff_ts) as trip_duration_mins
        from (
          select * exclude (pu, dr), case when year(pu) between 2009 and 2027 then pu end as pickup_ts,
            case when year(dr) between 2009 and 2027 then dr end as dropoff_ts
          from (select *, try_cast(tpep_pickup_datetime as timestamp) as pu,
                  try_cast(tpep_dropoff_datetime as timestamp) as dr
                from raw where fare_amount >= 0.5 and trip_distance > 0 and passenger_count between 1 and 10))""",
    "fact_w": f"""select pickup_ts, dropoff_ts, trip_duration_mins,
        cast(date_trunc('day', pickup_ts) as timestamp) as pickup_date,
        cast(date_trunc('hour', pickup_ts) as timestamp) as pickup_hour,
        cast(hour(pickup_ts) as bigint) as pickup_hour_of_day, cast(dayofweek(pickup_ts) as bigint) as pickup_dow,
        pulocationid, dolocationid, pu.borough as pickup_borough, pu.zone as pickup_zone,
        pu.service_zone as pickup_service_zone, dr.borough as dropoff_borough, dr.zone as dropoff_zone,
        trip_distance, passenger_count, ratecodeid, fare_amount, tip_amount, tolls_amount, congestion_surcharge,
        airport_fee, cbd_congestion_fee, total_amount, payment_type,
        case payment_type when 1 then 'Credit card' when 2 then 'Cash' when 3 then 'No charge' when 4 then 'Dispute'
          when 5 then 'Unknown' when 6 then 'Voided' else 'Other' end as payment_type_desc,
        {_r("tip_amount / nullif(fare_amount, 0) * 100")} as tip_pct, vendorid, _dbt_loaded_at
        from stg_w left join dim pu on pulocationid = pu.location_id
        left join dim dr on dolocationid = dr.location_id""",
    "silver": f"""select * from (
        select raw.* exclude (pulocationid, dolocationid, airport_fee, cbd_congestion_fee, congestion_surcharge),
          pulocationid as "PULocationID", dolocationid as "DOLocationID",
          coalesce(airport_fee, 0) as airport_fee, coalesce(cbd_congestion_fee, 0) as cbd_congestion_fee,
          coalesce(congestion_surcharge, 0) as congestion_surcharge,
          try_cast(tpep_pickup_datetime as timestamp) as pickup_ts,
          try_cast(tpep_dropoff_datetime as timestamp) as dropoff_ts,
          (epoch(try_cast(tpep_dropoff_datetime as timestamp)) - epoch(try_cast(tpep_pickup_datetime as timestamp)))
            / 60 as trip_duration_mins,
          borough as pickup_borough, zone as pickup_zone, service_zone, {AS_OF} as _loaded_at
        from raw left join zones on pulocationid = locationid
        where fare_amount > 0 and trip_distance > 0 and passenger_count between 1 and 6)
        where trip_duration_mins between 1 and 180""",
    "stg_l": f"""select pickup_ts, dropoff_ts, trip_duration_mins, trip_distance, passenger_count,
        "PULocationID" as pulocationid, "DOLocationID" as dolocationid, fare_amount, tip_amount, tolls_amount,
        congestion_surcharge, airport_fee, cbd_congestion_fee, total_amount, payment_type, pickup_borough,
        pickup_zone, {AS_OF} as _dbt_loaded_at
        from silver where fare_amount > 0.5 and trip_distance > 0""",
    "fact_l": f"""select * exclude (_dbt_loaded_at), cast(date_trunc('day', pickup_ts) as timestamp) as pickup_date,
        cast(hour(pickup_ts) as bigint) as pickup_hour_of_day,
        cast(dayofweek(pickup_ts) + 1 as bigint) as pickup_dow,
        case payment_type when 1 then 'Credit card' when 2 then 'Cash' when 3 then 'No charge' when 4 then 'Dispute'
          else 'Other' end as payment_type_desc,
        {_r("tip_amount / nullif(fare_amount, 0) * 100")} as tip_pct, _dbt_loaded_at
        from stg_l""",
}
_NEEDS = {
    "zones": (), "dim": ("zones",), "timed": (), "raw": ("timed",), "stg_w": ("raw",), "fact_w": ("stg_w", "dim"),
    "silver": ("raw", "zones"), "stg_l": ("silver",), "fact_l": ("stg_l",),
}


def _with(*tables: str, more: str = "") -> str:
    """A WITH clause of the named tables and what they build on, plus query-specific tables."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS[name]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for table in tables:
        add(table)
    parts = [f"{name} as ({_WITH[name]})" for name in wanted]
    return "with " + ",\n".join(parts + ([more] if more else [])) + "\n"


def _daily(fact: str, payments: bool) -> str:
    counts = (
        """, cast(count_if(payment_type = 1) as bigint) as card_trips,
        cast(count_if(payment_type = 2) as bigint) as cash_trips"""
        if payments
        else ""
    )
    return f"""select pickup_date as trip_date, pickup_borough, count(*) as total_trips,
        {_r(_sum("total_amount"))} as total_revenue, {_r(_avg("fare_amount"))} as avg_fare,
        {_r(_avg("tip_amount"))} as avg_tip, {_r(_avg("trip_distance"))} as avg_distance_miles,
        {_r(_avg("trip_duration_mins"))} as avg_duration_mins{counts}
        from {fact} group by pickup_date, pickup_borough"""


def _hourly(fact: str) -> str:
    return f"""select pickup_hour_of_day, pickup_dow, pickup_borough, count(*) as total_trips,
        {_r(_avg("fare_amount"))} as avg_fare from {fact} group by all"""


_STATS = """select pickup_borough,
    avg(fare_amount) as mean_fare, avg(trip_distance) as mean_distance, avg(trip_duration_mins) as mean_duration,
    stddev_samp(fare_amount) as std_fare, stddev_samp(trip_distance) as std_distance,
    stddev_samp(trip_duration_mins) as std_duration"""


def _flags(fact: str) -> str:
    """Tables stats, scored and flags over a fact."""
    return f"""stats as ({_STATS} from {fact} group by pickup_borough),
    scored as (select pickup_ts, fare_amount, trip_distance, trip_duration_mins, passenger_count, t.pickup_borough,
        payment_type_desc, abs(fare_amount - mean_fare) / nullif(std_fare, 0) as zf,
        abs(trip_distance - mean_distance) / nullif(std_distance, 0) as zd,
        abs(trip_duration_mins - mean_duration) / nullif(std_duration, 0) as zt
        from {fact} t left join stats s on t.pickup_borough = s.pickup_borough),
    flags as (select * exclude (zf, zd, zt),
        {_r("zf", 6)} as fare_zscore, {_r("zd", 6)} as distance_zscore, {_r("zt", 6)} as duration_zscore,
        {_r("(coalesce(zf, 0) + coalesce(zd, 0) + coalesce(zt, 0)) / 3")} as anomaly_score,
        coalesce(zf > 3, false) or coalesce(zd > 3, false) or coalesce(zt > 3, false) as is_anomaly,
        case when zf > 3 and zd > 3 then 'high fare + long distance'
             when zf > 3 and zt > 3 then 'high fare + long duration'
             when zf > 3 then 'high fare' when zd > 3 then 'long distance' when zt > 3 then 'long duration'
        end as anomaly_reason from scored)"""


_FIRST = f"payment_type <= 4 and (pickup_ts is null or pickup_ts <= {CUT})"


def _two_runs(fact: str) -> str:
    return f"""select *, {AS_OF} as _processed_at from {fact} where {_FIRST}
    union all
    select *, {SECOND_RUN} as _processed_at from {fact}
    where pickup_ts > (select max(pickup_ts) from {fact} where {_FIRST})"""


_KEY = "pickup_ts, pulocationid, dolocationid, fare_amount"


def _upserted(condition: str) -> str:
    return f"""batch as (select {_KEY}, max(tip_amount) + 1 as tip_amount, max(total_amount) as total_amount,
        max(pickup_date) as pickup_date
        from fact_w where payment_type between 3 and 5 and {condition} group by {_KEY})
    select {_KEY}, tip_amount, total_amount, pickup_date from fact_w t where payment_type <= 4 and not exists (
        select 1 from batch b where b.pickup_ts = t.pickup_ts and b.pulocationid = t.pulocationid
          and b.dolocationid = t.dolocationid and b.fare_amount = t.fare_amount)
    union all select {_KEY}, tip_amount, total_amount, pickup_date from batch"""


def _hash(prefix: str) -> str:
    columns = ("location_id", "borough", "zone", "service_zone")
    texts = [f"cast({prefix}.{name} as varchar)" for name in columns]
    return "md5(" + " || ".join(f"coalesce(length({text}) || ':' || {text}, '~')" for text in texts) + ")"


_SNAPSHOT = f"""earlier as (select location_id, case when location_id % 5 = 0 then 'OLD' else borough end as borough,
      zone, case when location_id % 4 <> 1 then service_zone end as service_zone from dim where location_id % 7 <> 3),
    later as (select * from dim where location_id % 11 <> 10),
    paired as (select e.location_id is not null and l.location_id is not null and (e.borough is distinct from l.borough
        or e.zone is distinct from l.zone or e.service_zone is distinct from l.service_zone) as changed,
      e.location_id as was, l.location_id as now_id from earlier e full join later l using (location_id))
    select e.*, {AS_OF} as valid_from, case when changed then {SECOND_RUN} end as valid_to,
      {_hash("e")} as row_hash from earlier e join paired on was = e.location_id
    union all
    select l.*, {SECOND_RUN} as valid_from, cast(null as timestamp) as valid_to, {_hash("l")} as row_hash
    from later l join paired on now_id = l.location_id where was is null or changed"""


def _checks(*rows: tuple[str, str, str, str, str]) -> str:
    """A check report; each row is table, check, column, severity and the SQL counting failures."""
    parts = [
        f"""select '{table}' as "table", '{check}_{column}' as "check", '{column}' as "column",
        cast(({failures}) as bigint) as failures, '{severity}' as severity"""
        for table, check, column, severity, failures in rows
    ]
    return f"""select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'error' end
    as status from ({' union all '.join(parts)})"""


def _failing(table: str, condition: str) -> str:
    return f"select count(*) from {table} where {condition}"


def _repeated(table: str, column: str) -> str:
    return f"select count(*) from (select {column} from {table} where {column} is not null group by 1 having count(*) > 1)"


_RANGE = "trip_duration_mins not between 1 and 180"
_PAY = "payment_type not in (1, 2, 3, 4, 5, 6)"

_QUALITY_W = _checks(
    ("taxi_zone_lookup", "unique", "locationid", "error", _repeated("zones", "locationid")),
    ("taxi_zone_lookup", "not_null", "locationid", "error", _failing("zones", "locationid is null")),
    ("stg_yellow_trips", "accepted_range", "trip_duration_mins", "warn", _failing("stg_w", _RANGE)),
    ("stg_yellow_trips", "not_null", "fare_amount", "error", _failing("stg_w", "fare_amount is null")),
    ("stg_yellow_trips", "not_null", "trip_distance", "error", _failing("stg_w", "trip_distance is null")),
    ("stg_yellow_trips", "accepted_values", "payment_type", "error", _failing("stg_w", _PAY)),
    ("dim_zones", "unique", "location_id", "error", _repeated("dim", "location_id")),
    ("dim_zones", "not_null", "location_id", "error", _failing("dim", "location_id is null")),
    ("fct_trips", "not_null", "fare_amount", "error", _failing("fact_w", "fare_amount is null")),
    ("fct_trips", "not_null", "pickup_borough", "error", _failing("fact_w", "pickup_borough is null")),
    ("agg_daily_revenue", "not_null", "total_revenue", "error", _failing("daily", "total_revenue is null")),
    ("anomaly_flags", "accepted_values", "is_anomaly", "error", _failing("flags", "is_anomaly not in (true, false)")),
) + f""" union all select 'fct_trips', 'assert_no_future_trips', '', n, 'error',
    case when n = 0 then 'pass' else 'error' end
    from (select count(*) as n from fact_w where pickup_ts > {FUTURE_AS_OF})"""

_QUALITY_L = _checks(
    ("stg_yellow_trips", "not_null", "pickup_ts", "error", _failing("stg_l", "pickup_ts is null")),
    ("stg_yellow_trips", "not_null", "dropoff_ts", "error", _failing("stg_l", "dropoff_ts is null")),
    ("stg_yellow_trips", "not_null", "trip_duration_mins", "error", _failing("stg_l", "trip_duration_mins is null")),
    ("stg_yellow_trips", "accepted_range", "trip_duration_mins", "warn", _failing("stg_l", _RANGE)),
    ("stg_yellow_trips", "not_null", "fare_amount", "error", _failing("stg_l", "fare_amount is null")),
    ("stg_yellow_trips", "accepted_range", "fare_amount", "error",
     _failing("stg_l", "fare_amount not between 0.5 and 500")),
    ("stg_yellow_trips", "not_null", "trip_distance", "error", _failing("stg_l", "trip_distance is null")),
    ("stg_yellow_trips", "accepted_range", "trip_distance", "error",
     _failing("stg_l", "trip_distance not between 0 and 100")),
    ("stg_yellow_trips", "accepted_values", "payment_type", "error", _failing("stg_l", _PAY)),
    ("fct_trips", "not_null", "pickup_ts", "error", _failing("fact_l", "pickup_ts is null")),
    ("fct_trips", "not_null", "fare_amount", "error", _failing("fact_l", "fare_amount is null")),
    ("fct_trips", "not_null", "pickup_borough", "error", _failing("fact_l", "pickup_borough is null")),
    ("fct_trips_incremental", "not_null", "pickup_ts", "error", _failing("growing", "pickup_ts is null")),
    ("agg_daily_revenue", "not_null", "trip_date", "error", _failing("daily", "trip_date is null")),
    ("agg_daily_revenue", "not_null", "total_revenue", "error", _failing("daily", "total_revenue is null")),
    ("anomaly_flags", "not_null", "pickup_ts", "error", _failing("flags", "pickup_ts is null")),
    ("anomaly_flags", "accepted_values", "is_anomaly", "error", _failing("flags", "is_anomaly not in (true, false)")),
)


def _freshness(source: str, table: str, column: str, as_of: str, where: str = "true") -> str:
    return f"""select '{source}' as source, m as max_loaded_at, {_r("age", 6)} as age_hours,
    case when age is null or age > 73 then 'error' when age > 49 then 'warn' else 'pass' end as status
    from (select m, (floor(epoch(timestamp '{as_of}')) - floor(epoch(m))) / 3600 as age
          from (select max({column}) as m from {table} where {where}))"""


_MONTH = "strftime(date_trunc('month', o_orderdate) - interval '2' month, '%Y-%m')"


def _prompt(question: str) -> str:
    return f"""'Trip features:' || chr(10) || 'fare_amount: ' || {_text("fare_amount")}
    || ', trip_distance: ' || {_text("trip_distance")} || ', trip_duration_mins: ' || {_text("trip_duration_mins")}
    || ', passenger_count: ' || {_text("passenger_count")} || ', pickup_borough: ' || {_text("pickup_borough")}
    || {_quoted(question)}"""


_ORDER = """pickup_ts nulls last, pulocationid, dolocationid, fare_amount, dropoff_ts nulls last,
    trip_duration_mins nulls last, trip_distance, passenger_count, pickup_borough nulls last"""
_LOADED = f"""loaded as (select * replace (case when vendorid % 2 = 1 then {SECOND_RUN} else _dbt_loaded_at end
    as _dbt_loaded_at) from fact_w)"""
_NUMBERED = f"""{_LOADED}, numbered as (select row_number() over (order by _dbt_loaded_at desc, {_ORDER}) as row_id, *
    from loaded)"""
_LOGGED = f"""{_LOADED},
    one as (select row_number() over (order by {_ORDER}) as row_id, * from loaded where _dbt_loaded_at = {AS_OF}),
    two as (select row_number() over (order by {_ORDER}) as row_id, * from loaded where _dbt_loaded_at <> {AS_OF})"""

_OVER = """cast(coalesce(fare_amount > 50, false) as int) + cast(coalesce(trip_distance > 25, false) as int)
    + cast(coalesce(trip_duration_mins > 85, false) as int)"""
_OVER_TEXT = """case when n_over = 0 then 'typical trip' else 'unusual ' || concat_ws(' and ',
    case when fare_amount > 50 then 'fare' end, case when trip_distance > 25 then 'distance' end,
    case when trip_duration_mins > 85 then 'duration' end) end"""

# What each reply shape reads as: score, flag, explanation; n is the line number.
_SHAPES = (
    ("n / 10", "true", "'fare ' || n"),
    ("n", "false", "'quoted'"),
    ("n / 10", "true", "'alias'"),
    ("n / 10", "true", "''"),
    ("0", "true", """'[{"score": 0.' || n || ', "is_anomaly": true}]'"""),
    ("0", "true", """'{"score": 0.' || n || ', "is_anomaly": yes, "explanation": "broken"'"""),
    ("n / 10", "true", "'SCORE: .' || n || ' yes, unusual' || chr(10) || 'second line'"),
    ("n", "false", "'this looks anomalous, score = ' || n"),
    ("0", "false", "''"),
    ("0", "true", """'{"score": "high", "is_anomaly": true}'"""),
    ("n / 10", "false", "'spaced'"),
    ("0", "false", """'{"score": 0.' || n || '} trailing words'"""),
    ("0", "false", "'null'"),
    ("1", "false", "''"),
)


def _shape(index: int) -> str:
    branches = " ".join(f"when {i} then {shape[index]}" for i, shape in enumerate(_SHAPES))
    return f"case l_partkey % {len(_SHAPES)} {branches} end"


_PARSED = f"""select l_orderkey as id, cast({_shape(0)} as double) as score, {_shape(1)} as is_anomaly,
      {_shape(2)} as explanation
    from (select *, l_linenumber as n from lineitem)
    union all
    select id, coalesce(try_cast(nullif(regexp_extract(piece,
        '(?i)score[{SPACE}]*[:=][{SPACE}]*([0-9]*\\.?[0-9]+)', 1), '') as double), 0) as score,
      regexp_matches(piece, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(true|yes|anomal)($|[^\\p{{L}}\\p{{N}}_])') as is_anomaly,
      piece as explanation
    from (select id, regexp_replace(reply, '^[{SPACE}]+|[{SPACE}]+$', '', 'g') as piece from (
      select doc_id as id, text as reply from documents
      union all
      select conv_id, 'turn' || chr(10) || 'score=' || turn || ' ' || text from conversations))"""

_CSV_DIRTY = "dolocationid % 13 in (1, 2, 3) or tpep_pickup_datetime = 'corrupt'"
_TYPED_DIRTY = """* replace (try_cast(tpep_pickup_datetime as timestamp) as tpep_pickup_datetime,
    try_cast(tpep_dropoff_datetime as timestamp) as tpep_dropoff_datetime,
    case when dolocationid % 13 <> 1 then passenger_count end as passenger_count,
    case when dolocationid % 13 <> 3 then cbd_congestion_fee end as cbd_congestion_fee)"""
_TYPED = """* replace (try_cast(tpep_pickup_datetime as timestamp) as tpep_pickup_datetime,
    try_cast(tpep_dropoff_datetime as timestamp) as tpep_dropoff_datetime)"""


def all_oracles() -> dict[str, str]:
    candidates = _with("fact_w", more=_NUMBERED)
    streamed = (
        _with("fact_w", more=f"early as (select * from fact_w where payment_type <= 4 and pickup_ts <= {CUT})")
        + f"""select *, {AS_OF} as _processed_at from early union all
        select *, {AS_OF} as _processed_at from fact_w where pickup_ts > (select max(pickup_ts) from early)"""
    )
    logged = (
        _with("fact_w", more=_LOGGED)
        + " union all ".join(
            f"""select row_id as __ai_row_id, pickup_ts, pickup_borough, {_r("0.3e0 * n_over", 1)} as anomaly_score,
            n_over > 0 as is_anomaly, {_OVER_TEXT} as ai_explanation, {as_of} as _dbt_loaded_at
            from (select *, {_OVER} as n_over from {run})"""
            for run, as_of in (("one", AS_OF), ("two", SECOND_RUN))
        )
    )
    evolved = _with("fact_w", more=f"grown as ({_two_runs('fact_w')})") + f"""select * exclude (ratecodeid),
        case when _processed_at = {SECOND_RUN} then fare_amount / trip_distance end as fare_per_mile from grown"""
    features = "pickup_ts, fare_amount, trip_distance, trip_duration_mins, passenger_count, pickup_borough"
    return {
        "stage_trips_w": _with("stg_w") + "select * from stg_w",
        "silver_trips_l": _with("silver") + "select * from silver",
        "stage_trips_l": _with("stg_l") + "select * from stg_l",
        "stage_zones": _with("dim") + "select * from dim",
        "dim_zones": _with("dim") + "select * from dim",
        "fact_trips_w": _with("fact_w") + "select * from fact_w",
        "fact_trips_l": _with("fact_l") + "select * from fact_l",
        "daily_revenue_w": _with("fact_w") + _daily("fact_w", True),
        "daily_revenue_l": _with("fact_l") + _daily("fact_l", False),
        "hourly_demand_w": _with("fact_w") + _hourly("fact_w"),
        "hourly_demand_l": _with("fact_l") + _hourly("fact_l"),
        "borough_stats": _with("fact_w", more=f"stats as ({_STATS} from fact_w group by pickup_borough)")
        + "select pickup_borough, "
        + ", ".join(
            f"{_r(f'{kind}_{short}', 6)} as {kind}_{short}"
            for kind in ("mean", "std")
            for short in ("fare", "distance", "duration")
        )
        + " from stats",
        "anomaly_flags_w": _with("fact_w", more=_flags("fact_w")) + "select * from flags",
        "anomaly_flags_l": _with("fact_l", more=_flags("fact_l")) + "select * from flags",
        "incremental_fact_w": _with("fact_w") + _two_runs("fact_w"),
        "incremental_fact_l": _with("fact_l") + _two_runs("fact_l"),
        "incremental_counts": _with("stg_w", more=f"mark as (select max(pickup_ts) as m from stg_w where {_FIRST})")
        + """select cast(count_if(pickup_ts > (select m from mark)) as bigint) as new,
        cast(count_if(pickup_ts <= (select m from mark)) as bigint) as late,
        cast(count_if(pickup_ts is null) as bigint) as null_ts from stg_w""",
        "upsert_overlap": _with("fact_w", more=_upserted("true")),
        "merge_periods": _with("fact_w", more=_upserted("year(pickup_ts) = 2022")),
        "schema_sync": _with("fact_w")
        + f"""select vendorid, {_KEY}, cast(null as double) as tip_pct, cast(null as varchar) as payment_type_desc
        from fact_w""",
        "evolving_fact": evolved,
        "evolving_fact_by_month": evolved,
        "zone_snapshot": _with("dim", more=_SNAPSHOT),
        "snapshot_roundtrip": _with("dim", more=_SNAPSHOT),
        "grown_fact_l": _with("fact_l") + _two_runs("fact_l").replace(SECOND_RUN, AS_OF),
        "quality_w": _with("fact_w", more=f"daily as ({_daily('fact_w', True)}), {_flags('fact_w')}") + _QUALITY_W,
        "quality_l": _with(
            "fact_l",
            more=f"daily as ({_daily('fact_l', False)}), {_flags('fact_l')}, growing as ({_two_runs('fact_l')})",
        )
        + _QUALITY_L,
        "unique_values": f"""select 'unique_' || c as "check", c as "column", failures, 'error' as severity,
        case when failures = 0 then 'pass' else 'error' end as status from (
        select 'l_orderkey' as c, ({_repeated("lineitem", "l_orderkey")}) as failures
        union all select 'l_linenumber', ({_repeated("lineitem", "l_linenumber")}))""",
        "no_future_trips": _with("fact_w")
        + f"select pickup_ts, fare_amount, pulocationid from fact_w where pickup_ts > {FUTURE_AS_OF}",
        "freshness": " union all ".join(
            (
                _freshness("events", "events", "ts", "2024-02-01 00:00:00"),
                _freshness("events_later", "events", "ts", "2024-02-02 06:00:00"),
                _freshness("orders", "orders", "o_orderdate", "2026-01-01 00:00:00"),
                _freshness("orders_never", "orders", "o_orderdate", "2026-01-01 00:00:00", "o_orderkey < 0"),
            )
        ),
        "target_months": f"select {_MONTH} as month, count(*) as runs from orders group by 1",
        "month_presence": f"""select month, cast(present as bigint) as files, present from (
        select month, month in (select strftime(l_shipdate, '%Y-%m') from lineitem) as present
        from (select distinct {_MONTH} as month from orders))""",
        "score_candidates": candidates + f"select row_id, {_prompt(BATCH_QUESTION)} as prompt from numbered",
        "score_newest": candidates
        + f"select row_id, {_prompt(BATCH_QUESTION)} as prompt from numbered where row_id <= 1000",
        "score_row_k": candidates
        + f"""select row_id, {_prompt(SINGLE_QUESTION)} as prompt, {_r("0.3e0 * n_over", 1)} as score,
        n_over > 0 as is_anomaly, {_OVER_TEXT} as explanation, false as failed
        from (select *, {_OVER} as n_over from numbered where row_id = 777)""",
        "score_features": _with("fact_l")
        + f"""select {features}, prompt, {_r("0.3e0 * n_over", 1)} as score, n_over > 0 as is_anomaly,
        {_OVER_TEXT} as explanation, false as failed
        from (select {features}, {_OVER} as n_over, {_prompt(BATCH_QUESTION)} as prompt from fact_l)""",
        "parse_reply_texts": _PARSED,
        "ai_flags": logged,
        "ai_flags_repeated": logged,
        "tolerant_csv_load": _with("raw") + f"select {_TYPED} from raw where not ({_CSV_DIRTY})",
        "rejected_csv_rows": _with("raw") + f"select {_TYPED_DIRTY} from raw where {_CSV_DIRTY}",
        "mixed_header_csv": _with("raw")
        + f"""select {_TYPED} from (select * replace (case when vendorid = 1 then extra end as extra) from raw)
        where tpep_pickup_datetime <> 'corrupt'""",
        "drifted_parquet_load": _with("raw") + f"select {_TYPED} from raw",
        "tolerant_parquet_load": _with("raw") + f"select {_TYPED} from raw where not (vendorid = 2 and pulocationid % 5 = 0)",
        "rejected_parquet_rows": _with("raw")
        + f"""select {_TYPED} from (select * replace (cast(null as bigint) as passenger_count) from raw
        where vendorid = 2 and pulocationid % 5 = 0)""",
        "damaged_parquet_load": _with("raw")
        + f"""select {_TYPED} from raw where vendorid = 1 or payment_type in (1, 3)
        union all select {_TYPED.replace("* replace", "* exclude (place) replace")} from (
          select *, row_number() over (order by total_amount, tip_amount,
            try_cast(tpep_pickup_datetime as timestamp) nulls first, pulocationid, dolocationid, trip_distance) as place
          from raw where payment_type = 7) where place > 50""",
        "damaged_parquet_files": """select '2024-03' as delivery, 'no readable footer' as reason, null::bigint as rows_lost
        union all select '2024-04', 'damaged row groups', least(50, count(*)) from lineitem where l_linenumber = 7""",
        "zones_csv": _with("dim") + "select * from dim",
        "read_table_by_name": _with("fact_w") + "select * from fact_w",
        "schema_overwrite": _with("fact_w", more=f"hourly as ({_hourly('fact_w')})")
        + "select *, (select count(*) from hourly) as rows_written from hourly",
        "day_partitions": _with("fact_w") + """select cast(pickup_date as date) as pickup_day, count(*) as trips
        from fact_w where payment_type = 1 or pickup_date is null
          or pickup_date not between date '2022-01-10' and date '2022-01-12'
          or (select count(*) from fact_w f where f.pickup_date = fact_w.pickup_date and f.payment_type = 1) = 0
        group by 1""",
        "name_matched_load": _with("raw")
        + f"select {_TYPED} from (select * replace (cast(null as double) as cbd_congestion_fee) from raw)",
        "bronze_append": _with("raw")
        + f"""select * replace (case when vendorid = 2 then airport_fee end as airport_fee), {AS_OF} as _loaded_at
        from raw""",
        "partitioned_fact_roundtrip": _with("fact_w")
        + "select *, cast(date_trunc('month', pickup_date) as date) as pickup_month from fact_w",
        "export_roundtrip": _with("fact_l") + "select * from fact_l",
        "file_stream_once": _with("raw") + f"select *, {AS_OF} as _loaded_at from raw",
        "stream_incremental": streamed,
        "stream_counts": _with("stg_w", more=f"""marked as (
          select pickup_ts, coalesce(payment_type <= 4 and pickup_ts <= {CUT}, false) as early,
            (select max(pickup_ts) from stg_w where payment_type <= 4 and pickup_ts <= {CUT}) as m from stg_w)""")
        + """select 0::bigint as batch_id, count(*) as "new", 0::bigint as late, 0::bigint as null_ts from marked where early
        union all select 1, count_if(pickup_ts > m)::bigint, count_if(pickup_ts <= m)::bigint, count_if(pickup_ts is null)::bigint
        from marked where not early""",
        "stream_restart": streamed,
        "stream_incremental_batched": _with("fact_w") + f"select *, {AS_OF} as _processed_at from fact_w",
    }
