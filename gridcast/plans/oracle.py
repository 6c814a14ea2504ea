"""DuckDB SQL computing the same result as each registered query.

Written from the operators' semantics over the raw tables (pre-registered
views ``events``, ``orders``, ...), not from the Spark plans, so a mismatch
points at a real difference. Column names equal the Spark outputs.
"""

from __future__ import annotations

AS_OF = "timestamp '2024-01-15 12:00:00'"

_WIND = "cast(json_extract_string(props, '$.k') as double)"

_WEATHER = f"""
weather as (
  select date_trunc('minute', ts) as time, value as temperature, {_WIND} as wind_speed,
         case when event_id % 2 = 0 then '55.0,12.5' else '56.0,9.5' end as site
  from events where event_type <> 'purchase'
)"""

_WEATHER_15 = _WEATHER + """,
weather_15 as (
  select temperature, wind_speed, site, time + to_minutes(m) as time_15min
  from weather, unnest([0, 15, 30, 45]) as o(m)
)"""

_RAW_PRICES = """
raw_prices as (
  select case when event_id % 50 = 0 then date_trunc('second', ts) else date_trunc('hour', ts) end as price_time,
         case when event_id % 41 <> 0 then value end as label, event_id,
         case when event_id % 2 = 0 then '55.0,12.5' else '56.0,9.5' end as site
  from events where event_type = 'purchase'
)"""

_PRICES = _RAW_PRICES + """,
prices as (
  select price_time, arg_max(label, event_id) as label from raw_prices where label is not null group by 1
)"""

_MARKET = """
market as (
  select strftime(ts, '%Y-%m-%dT%H:%M:%S') as TimeUTC, cast(user_id as varchar) as PriceArea,
         case when value >= 60 then value end as ImbalancePriceEUR, event_id as arrival
  from events
)"""

_PRED = f"""
pred as (
  select event_id as arrival, date_trunc('second', ts) as Time, value as price_rf, value * 1.5 as price_gbt,
         {_WIND} as wind_speed, value as temperature,
         epoch_us(date_trunc('second', ts)) - epoch_us({AS_OF}) as d_us
  from events
)"""

_FUTURE_LONG = _PRED + """,
future as (select * from pred where d_us > 3600000000),
long as (
  select Time, 'Random Forest (Champion)' as Model, price_rf as Price, arrival, 0 as slot from future
  union all
  select Time, 'Gradient Boost (Challenger)' as Model, price_gbt as Price, arrival, 1 as slot from future
)"""

_BUFFER = _FUTURE_LONG + """,
n as (select count(*) as n from long),
k as (select case when n <= 800 then n else 600 + ((n - 802) % 202) end as k from n),
buffer as (
  select Time, Model, Price, arrival
  from (select *, row_number() over (order by arrival desc, slot desc) as rn from long) r, k
  where r.rn <= k.k
)"""

_SIGNAL = "case when {p} < 30 then 'BUY' when {p} > 80 then 'SELL' else 'HOLD' end"

_BROKEN = """
broken as (
  select case when event_id % 2 = 0 then '[{"HourUTC": "2024-01-0' || event_id else '{"error": true, "id": ' || event_id || ', "hourly": ' end as value
  from events where event_id % 97 = 0
)"""

ORACLE: dict[str, str] = {
    "landed_versions": f"with {_WEATHER} select time, temperature, wind_speed from weather",
    "rejected_documents": f"with {_BROKEN} select value from broken",
    "rejected_readings": f"""
      select 'day ' || event_id as time_str, value as temperature, {_WIND} as wind_speed
      from events where event_type <> 'purchase' and event_id % 13 = 0""",
    "rejected_prices": f"""with {_BROKEN}, {_RAW_PRICES}
      select value, 'document' as kind from broken
      union all select strftime(price_time, '%Y-%m-%dT%H:%M:%S') as value, 'record' as kind from raw_prices where label is null""",
    "silver_merged_parts": f"""with {_WEATHER.replace("select date_trunc", "select event_id, date_trunc")},
      files as (
        select *, i as landed from weather, (values (0), (1)) f(i) where event_id % 3 <> i
      ), rows as (
        select landed, site, temperature, wind_speed, time + to_minutes(m) as time_15min from files, unnest([0, 15, 30, 45]) as o(m)
      )
      select site, temperature, wind_speed, time_15min, strftime(time_15min, '%Y-%m-%d') as date from rows
      qualify row_number() over (partition by site, time_15min order by landed desc, temperature desc, wind_speed desc) = 1""",
    "bucketed_hour_join": f"""with {_WEATHER_15}, {_RAW_PRICES}
      select w.temperature, w.wind_speed, p.label, w.time_15min
      from weather_15 w join raw_prices p on date_trunc('hour', w.time_15min) = p.price_time where p.label is not null""",
    "ordered_prices": """
      select ts, value, event_id, row_number() over (order by ts, event_id) as position from events where event_type = 'purchase'""",
    "ordered_comparison": f"""with {_BUFFER}, wide as (
      select Time,
             arg_max(Price, arrival) filter (where Model = 'Random Forest (Champion)') as "Random Forest (Champion)",
             arg_max(Price, arrival) filter (where Model = 'Gradient Boost (Challenger)') as "Gradient Boost (Challenger)",
             strftime(Time, '%a %d') as Label
      from buffer group by Time)
      select *, row_number() over (order by Time) as position from wide""",
    "unlimited": f"with {_MARKET} select TimeUTC, PriceArea, ImbalancePriceEUR, arrival from market",
    "served_quarantine": """
      select case when event_id % 11 = 0 then 'not json ' || event_id
                  when event_id % 17 = 0 then json_object('time', 'yesterday', 'price_rf', value, 'arrival', event_id)::varchar
                  else json_object('price_rf', value, 'arrival', event_id)::varchar end as value
      from events where event_id % 11 = 0 or event_id % 17 = 0 or event_id % 23 = 0""",
    "stream_site_tiles": f"""with {_PRED},
      last as (
        select 'site' || (arrival % 40) as site, * from pred where abs(d_us) < 7200000000
        qualify row_number() over (partition by arrival % 40 order by arrival desc) = 1
      )
      select site, Time, price_rf as price, wind_speed, temperature, {_SIGNAL.format(p="price_rf")} as signal from last""",
    "stream_restarted": """
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, date_trunc('second', ts) as ts,
             cast(hour(ts) as integer) as hour_of_day, cast(dayofweek(ts) + 1 as integer) as day_of_week
      from events""",
    "stream_message_counts": """
      with m as (select event_id % 7 = 0 or event_id % 19 = 0 or event_id % 11 = 0 or event_id % 13 = 0 or event_id % 17 = 0 as bad from events)
      select cast(5 as bigint) as batches, count(*) as received, count(*) filter (not bad) as scored, count(*) filter (bad) as quarantined,
             count(*) filter (not bad) as sent, count(*) filter (bad) as kept from m""",
    "landed_weather": f"with {_WEATHER} select time, temperature, wind_speed from weather",
    "landed_two_ranges": f"with {_WEATHER} select time, temperature, wind_speed from weather",
    "silver_two_sites": f"""with {_WEATHER_15}
      select site, temperature, wind_speed, time_15min, strftime(time_15min, '%Y-%m-%d') as date from weather_15""",
    "silver_replace_all": f"""with {_WEATHER_15}
      select temperature, wind_speed, time_15min, strftime(time_15min, '%Y-%m-%d') as date from weather_15
      where site = '56.0,9.5'""",
    "price_array_docs": f"with {_RAW_PRICES} select price_time, label from raw_prices",
    "raw_hour_join": f"""with {_WEATHER_15}, {_RAW_PRICES}
      select w.temperature, w.wind_speed, p.label, w.time_15min
      from weather_15 w join raw_prices p on date_trunc('hour', w.time_15min) = p.price_time where p.label is not null""",
    "training_set_by_site": f"""with {_WEATHER_15}, {_RAW_PRICES},
      prices as (select site, price_time, arg_max(label, event_id) as label from raw_prices where label is not null group by 1, 2)
      select w.site, w.temperature, w.wind_speed, p.label, w.time_15min,
             cast(hour(w.time_15min) as integer) as hour_of_day,
             cast(dayofweek(w.time_15min) + 1 as integer) as day_of_week
      from weather_15 w join prices p on date_trunc('hour', w.time_15min) = p.price_time and w.site = p.site""",
    "quarantined_messages": f"""
      with r as (
        select event_id as i, case when event_id % 17 = 0 then 'yesterday' else strftime(ts, '%Y-%m-%dT%H:%M:%S') end as time,
               value as temperature, {_WIND} as wind_speed,
               case when event_type = 'view' then '7-day-forecast' else 'open-meteo-live' end as source
        from events)
      select i as arrival,
             case when i % 7 = 0 then '{{"temperature": NaN, "wind_speed": 1.0, "time": "' || time || '"}}'
                  when i % 19 = 0 then '{{"temperature": null, "wind_speed": 1.0, "time": "' || time || '"}}'
                  when i % 11 = 0 then 'not json'
                  when i % 13 = 0 then json_object('time', time, 'temperature', temperature)::varchar
                  else json_object('time', time, 'temperature', temperature, 'wind_speed', wind_speed, 'source', source)::varchar end as value
      from r where i % 7 = 0 or i % 19 = 0 or i % 11 = 0 or i % 13 = 0 or i % 17 = 0""",
    "scorable_messages": f"""
      select event_id as arrival, value as temperature, {_WIND} as wind_speed,
             cast(hour(ts) as double) as hour_of_day, cast(dayofweek(ts) + 1 as double) as day_of_week
      from events where event_id % 7 <> 0 and event_id % 19 <> 0 and event_id % 11 <> 0 and event_id % 13 <> 0 and event_id % 17 <> 0""",
    "landed_prices": f"with {_PRICES} select price_time, label from prices",
    "stream_features": """
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, date_trunc('second', ts) as ts,
             cast(hour(ts) as integer) as hour_of_day, cast(dayofweek(ts) + 1 as integer) as day_of_week
      from events""",
    "fit_models": f"""with {_WEATHER_15}, {_PRICES},
      n as (select count(*) as train_rows from weather_15 w join prices p on date_trunc('hour', w.time_15min) = p.price_time
            where w.temperature is not null and w.wind_speed is not null)
      select model, cast(20 as bigint) as trees, train_rows from (values ('rf'), ('gbt')) m(model), n""",
    "dual_score_checks": f"""
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, value as temperature, {_WIND} as wind_speed,
             true as rf_in_range, true as rf_reloads, true as gbt_reloads
      from events""",
    "stream_distinct": "select distinct user_id, event_type from events",
    "stream_union": f"""
      select strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, value as temperature, {_WIND} as wind_speed,
             case when event_type = 'view' then '7-day-forecast' else 'open-meteo-live' end as source, event_id as arrival
      from events""",
    "stream_last_100": f"""
      select strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, value as temperature, {_WIND} as wind_speed,
             value as price_rf, value * 1.5 as price_gbt, event_id as arrival
      from events order by event_id desc limit 100""",
    "published_messages": f"""
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, value as temperature,
             {_WIND} as wind_speed,
             case when event_type = 'view' then '7-day-forecast' else 'open-meteo-live' end as source
      from events""",
    "flatten_series": f"with {_WEATHER} select time, temperature, wind_speed from weather",
    "upsample_hold": f"with {_WEATHER_15} select temperature, wind_speed, time_15min from weather_15",
    "upsample_sql": f"with {_WEATHER_15} select temperature, wind_speed, time_15min from weather_15",
    "forecast_messages": f"""
      select strftime(ts, '%Y-%m-%dT%H:%M') as time, value as temperature, {_WIND} as wind_speed,
             '7-day-forecast' as source
      from events where event_type <> 'purchase'""",
    "live_messages": f"""
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, value as temperature,
             {_WIND} as wind_speed, 'open-meteo-live' as source
      from events""",
    "market_messages": f"""with {_MARKET},
      ranked as (select *, row_number() over (partition by PriceArea order by TimeUTC desc, arrival desc) as rk from market),
      valid as (select *, row_number() over (partition by PriceArea order by rk) as pick
                from ranked where rk <= 20 and ImbalancePriceEUR is not null)
      select PriceArea, TimeUTC, ImbalancePriceEUR, arrival,
             epoch_us({AS_OF}) / cast(1000000 as double) as fetched_at
      from valid where pick = 1""",
    "silver_job": f"""with {_WEATHER_15}
      select temperature, wind_speed, time_15min, strftime(time_15min, '%Y-%m-%d') as date from weather_15""",
    "silver_date_range": f"""with {_WEATHER_15}
      select temperature, wind_speed, time_15min, strftime(time_15min, '%Y-%m-%d') as date from weather_15
      where cast(time_15min as date) between date '2024-01-10' and date '2024-01-12'""",
    "hourly_prices": f"with {_PRICES} select price_time, label from prices",
    "hour_join": f"""with {_WEATHER_15}, {_PRICES}
      select w.temperature, w.wind_speed, p.label, w.time_15min
      from weather_15 w join prices p on date_trunc('hour', w.time_15min) = p.price_time""",
    "training_set": f"""with {_WEATHER_15}, {_PRICES}
      select w.temperature, w.wind_speed, p.label, w.time_15min,
             cast(hour(w.time_15min) as integer) as hour_of_day,
             cast(dayofweek(w.time_15min) + 1 as integer) as day_of_week
      from weather_15 w join prices p on date_trunc('hour', w.time_15min) = p.price_time""",
    "time_features": """
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, date_trunc('second', ts) as ts,
             cast(hour(ts) as integer) as hour_of_day, cast(dayofweek(ts) + 1 as integer) as day_of_week
      from events""",
    "json_parse": f"""
      select event_id as arrival, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time, value as temperature,
             {_WIND} as wind_speed,
             case when event_type = 'view' then '7-day-forecast' else 'open-meteo-live' end as source
      from events""",
    "json_pack": f"""
      select event_id as arrival,
             json_object('time', strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'temperature', value,
                         'wind_speed', {_WIND}, 'price_rf', value, 'price_gbt', value * 1.5)::varchar as value
      from events""",
    "latest_valid": f"""with {_MARKET},
      top20 as (select * from market order by TimeUTC desc, arrival desc limit 20)
      select * from top20 where ImbalancePriceEUR is not null order by TimeUTC desc, arrival desc limit 1""",
    "latest_valid_by_area": f"""with {_MARKET},
      ranked as (select *, row_number() over (partition by PriceArea order by TimeUTC desc, arrival desc) as rk from market),
      valid as (select *, row_number() over (partition by PriceArea order by rk) as pick
                from ranked where rk <= 20 and ImbalancePriceEUR is not null)
      select PriceArea, TimeUTC, ImbalancePriceEUR, arrival from valid where pick = 1""",
    "area_filter_sort": "select ts, value, event_id from events where event_type in ('purchase') order by ts",
    "date_range": """
      select event_id, ts, value from events
      where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-13 00:00:00'""",
    "location_filter": "select event_id, ts, event_type, value from events where user_id = 7",
    "peek_one": f"""with {_MARKET}
      select case when ImbalancePriceEUR is null
                  then json_object('TimeUTC', TimeUTC, 'PriceArea', PriceArea, 'arrival', arrival)
                  else json_object('TimeUTC', TimeUTC, 'PriceArea', PriceArea,
                                   'ImbalancePriceEUR', ImbalancePriceEUR, 'arrival', arrival) end::varchar as json
      from market where PriceArea in ('7', '11') order by arrival limit 1""",
    "trade_signal": f"""with {_MARKET}
      select arrival, ImbalancePriceEUR,
             {_SIGNAL.format(p="coalesce(ImbalancePriceEUR, 0)")} as signal,
             case when ImbalancePriceEUR is null then null else {_SIGNAL.format(p="ImbalancePriceEUR")} end as signal_strict
      from market""",
    "fresh_rows": f"""with {_PRED}
      select arrival, Time, d_us / cast(1000000 as double) as seconds_from_now
      from pred where abs(d_us) < 7200000000""",
    "current_conditions": f"""with {_PRED},
      last as (select * from pred where abs(d_us) < 7200000000 order by arrival desc limit 1)
      select Time, price_rf as price, wind_speed, temperature, {_SIGNAL.format(p="price_rf")} as signal,
             printf('€ %.2f', price_rf) as price_text, printf('%.1f m/s', wind_speed) as wind_text,
             printf('%.1f °C', temperature) as temp_text
      from last""",
    "live_series": f"""with {_PRED},
      today as (select * from pred where d_us > -43200000000 and d_us < 86400000000),
      last100 as (select * from today order by arrival desc limit 100)
      select Time, arg_min(price_rf, arrival) as Price, arg_min(wind_speed, arrival) as Wind, 'Live' as Type,
             strftime(Time, '%H:%M') as Label
      from last100 group by Time""",
    "model_unpivot": f"with {_FUTURE_LONG} select Time, Model, Price, arrival from long",
    "forecast_buffer": f"with {_BUFFER} select Time, Model, Price, arrival from buffer",
    "model_comparison": f"""with {_BUFFER}
      select Time,
             arg_max(Price, arrival) filter (where Model = 'Random Forest (Champion)') as "Random Forest (Champion)",
             arg_max(Price, arrival) filter (where Model = 'Gradient Boost (Challenger)') as "Gradient Boost (Challenger)",
             strftime(Time, '%a %d') as Label
      from buffer group by Time order by Time""",
    "comparison_table": f"""with {_BUFFER},
      wide as (
        select Time,
               arg_max(Price, arrival) filter (where Model = 'Random Forest (Champion)') as rf,
               arg_max(Price, arrival) filter (where Model = 'Gradient Boost (Challenger)') as gbt
        from buffer group by Time)
      select Time, printf('%.2f', rf) as "Random Forest (Champion)", printf('%.2f', gbt) as "Gradient Boost (Challenger)"
      from wide""",
    "distinct_rows": "select distinct user_id, event_type from events",
    "stream_forecast_buffer": f"with {_BUFFER} select Time, Model, Price, arrival from buffer",
    "month_chunks": """
      with b as (select cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e from orders),
      m as (select s, e, cast(unnest(generate_series(cast(date_trunc('month', s) as timestamp),
                                                      cast(e as timestamp), interval 1 month)) as date) as mo from b),
      c as (select greatest(mo, s) as chunk_start, least(last_day(mo), e) as chunk_end from m)
      select strftime(chunk_start, '%Y_%m') as tag,
             strftime(chunk_start, '%Y-%m-%d') as start_text, strftime(chunk_end, '%Y-%m-%d') as end_text
      from c""",
}

# The serving views kept as stream state must equal the batch views.
ORACLE["stream_current_conditions"] = ORACLE["current_conditions"]
ORACLE["stream_live_series"] = ORACLE["live_series"]
ORACLE["stream_model_comparison"] = ORACLE["model_comparison"]

ORACLE["serving_views"] = f"""
  with now_ as ({ORACLE["current_conditions"]}), live_ as ({ORACLE["live_series"]}), models_ as ({ORACLE["model_comparison"]})
  select 'now' as "view", Time, price as Price from now_
  union all select 'live', Time, Price from live_
  union all select 'Random Forest (Champion)', Time, "Random Forest (Champion)" from models_
  union all select 'Gradient Boost (Challenger)', Time, "Gradient Boost (Challenger)" from models_"""
ORACLE["market_payloads"] = f"""
  with m as ({ORACLE["market_messages"]})
  select PriceArea, TimeUTC, ImbalancePriceEUR, 'n' || arrival as note, fetched_at from m"""
