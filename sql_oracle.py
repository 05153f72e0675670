"""Independent DuckDB SQL for every registered query.

Written from the semantics (not generated from the Spark plans).  Each query is
a WITH chain over the driver's tables, built from the named fragments below.
Double columns are rounded to 6 decimals (via 9) on both sides (the Spark results in
``__spark_entry__`` are rounded the same way) so that a different order of
floating-point additions does not show up as a difference.
"""

from __future__ import annotations

# Fixed values shared with the Spark side (see voltaic.sources.derived).
POINTS = ("HB_HOUSTON", "HB_NORTH", "HB_SOUTH", "HB_WEST",
          "LZ_HOUSTON", "LZ_NORTH", "ZONE_A", "RN_1", "HB_PAN", "HB_BUSAVG")
HUBS = tuple(sorted(p for p in POINTS if p.startswith("HB_")))
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

# Names of all double-typed result columns (rounded to 6 decimals).
DOUBLE_COLUMNS = (
    "GEN_SYSTEM_WIDE", "HSL_SYSTEM_WIDE", "STPPF_SYSTEM_WIDE", "PVGRPP_SYSTEM_WIDE",
    "COP_HSL_SYSTEM_WIDE", "STWPF_SYSTEM_WIDE", "WGRPP_SYSTEM_WIDE", "LMP",
    "actual_mw", "hsl_mw", "stppf_forecast_mw", "pvgrpp_forecast_mw", "cop_hsl_mw",
    "stwpf_forecast_mw", "wgrpp_forecast_mw", "stppf_error_mw", "stppf_error_pct",
    "stwpf_error_mw", "stwpf_error_pct", "estimated_curtailment_mw", "forecast_mw",
    "total_renewable_actual_mw", "total_renewable_hsl_mw", "total_curtailment_mw",
    "solar_actual_mw", "wind_actual_mw", "solar_pct", "wind_pct",
    "lmp_price", "gen_mw", "stppf_mw",
    "mae_mw", "mape_pct", "rmse_mw", "bias_mw", "total_actual_mw", "total_forecast_mw",
    "peak_actual_mw", "max_error_mw", "avg_mae_mw", "avg_mape_pct", "avg_bias_mw",
    "error_stddev_mw", "avg_total_mw", "avg_solar_mw", "avg_wind_mw", "p10_total_mw",
    "p50_total_mw", "p90_total_mw", "max_total_mw", "min_total_mw", "stddev_total_mw",
    "total_generation_mwh", "solar_generation_mwh", "wind_generation_mwh",
    "total_curtailment_mwh", "peak_hour_mw", "avg_hour_mw", "capacity_factor_estimate",
    "solar_share_pct", "wind_share_pct", "avg_curtailment_mw", "max_curtailment_mw",
    "solar_curtailment_mwh", "wind_curtailment_mwh", "curtailment_rate_pct",
    "avg_lmp", "min_lmp", "max_lmp", "median_lmp", "price_spread", "daily_price_range",
    "avg_price", "min_price", "max_price", "p25_price", "median_price", "p75_price",
    "p10_price", "p90_price", "stddev_price", "daily_range", "avg_peak_price",
    "avg_offpeak_price", "peak_offpeak_spread", "houston_west_spread",
    "north_south_spread", "avg_houston_west_spread", "min_houston_west_spread",
    "max_houston_west_spread", "avg_north_south_spread", "min_north_south_spread",
    "max_north_south_spread", "rolling_7d_avg", "rolling_7d_stddev", "rolling_30d_avg",
    "rolling_30d_stddev", "cv_7d", "cv_30d", "houston_lmp", "avg_renewable_mw",
    "actual_lag_1h", "actual_lag_24h", "actual_lag_168h", "actual_avg_24h",
    "actual_avg_168h", "actual_max_24h", "actual_min_24h", "actual_std_24h",
    "hour_sin", "hour_cos", "same_hour_yesterday", "same_hour_last_week",
    "target_actual_mw", "value", "o_totalprice", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "volatility_7d", "cv_7d_pct", "p10_mw", "p90_mw",
    "total_gwh", "curtailment_gwh",
    "stwpf_mw", "wgrpp_mw", "forecast_horizon_hours", "mse_forecast", "mse_persistence",
    "skill_score", "lmp_renewable_corr", "max_6h", "orders_mw",
    *HUBS,
    *[f"GEN_{r.replace(' ', '_')}" for r in REGIONS],
    *[f"STPPF_{r.replace(' ', '_')}" for r in REGIONS],
    *[f"GEN_{r}" for r in REGIONS if " " in r],
    *[f"STPPF_{r}" for r in REGIONS if " " in r],
)


def _i(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


def _parts(ts: str) -> str:
    return (f"{_i(f'year({ts})')} AS year, {_i(f'month({ts})')} AS month, "
            f"{_i(f'day({ts})')} AS day")


def _feed(event_type: str, fc: str, pot: str) -> str:
    return f"""
SELECT h.Interval_Start,
       h.Interval_Start + INTERVAL 1 HOUR AS Interval_End,
       h.Interval_Start - INTERVAL 1 DAY AS Publish_Time,
       a.s AS GEN_SYSTEM_WIDE,
       a.mx * a.n AS HSL_SYSTEM_WIDE,
       CAST(50.0 AS DOUBLE) * a.n AS {fc},
       CAST(55.0 AS DOUBLE) * a.n AS {pot},
       a.mx * a.n AS COP_HSL_SYSTEM_WIDE
FROM ev_hours h
LEFT JOIN (
  SELECT date_trunc('hour', ts) AS Interval_Start,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s,
         COUNT(*) AS n, MAX(value) AS mx
  FROM events WHERE event_type = '{event_type}' GROUP BY 1
) a ON a.Interval_Start = h.Interval_Start"""


def _silver(bronze: str, fc: str, pot: str, fc_bronze: str, pot_bronze: str, source: str) -> str:
    g, h, f = "GEN_SYSTEM_WIDE", "HSL_SYSTEM_WIDE", fc_bronze
    return f"""
SELECT Interval_Start AS interval_start, Interval_End AS interval_end,
       Publish_Time AS report_time, {g} AS actual_mw, {h} AS hsl_mw,
       {f} AS {fc}_forecast_mw, {pot_bronze} AS {pot}_forecast_mw,
       COP_HSL_SYSTEM_WIDE AS cop_hsl_mw,
       {_i('hour(Interval_Start)')} AS hour_of_day,
       dayname(Interval_Start) AS day_of_week,
       dayofweek(Interval_Start) IN (0, 6) AS is_weekend,
       CASE WHEN {g} IS NOT NULL THEN {f} - {g} END AS {fc}_error_mw,
       CASE WHEN {g} IS NOT NULL AND {g} > 0 THEN ({f} - {g}) / {g} * 100.0 END AS {fc}_error_pct,
       CASE WHEN {h} IS NOT NULL AND {g} IS NOT NULL AND {h} > {g} THEN {h} - {g}
            ELSE CAST(0.0 AS DOUBLE) END AS estimated_curtailment_mw,
       '{source}' AS _source_table,
       {_parts('Interval_Start')}
FROM {bronze}"""


_POINT_LIST = "[" + ", ".join(f"'{p}'" for p in POINTS) + "]"


def _slim(src: str, tag: str, fc: str) -> str:
    return (f"SELECT interval_start, interval_end, actual_mw, hsl_mw, estimated_curtailment_mw, "
            f"hour_of_day, day_of_week, is_weekend, year, month, day, '{tag}' AS resource_type, "
            f"{fc}_forecast_mw AS forecast_mw FROM {src}")


def _acc_base(src: str, fc: str, floor: float) -> str:
    return (f"SELECT * FROM {src} WHERE actual_mw IS NOT NULL AND {fc}_forecast_mw IS NOT NULL "
            f"AND actual_mw > {floor}")


def _acc_daily(base: str, fc: str, tag: str) -> str:
    e = f"{fc}_error_mw"
    return f"""
SELECT CAST(interval_start AS DATE) AS date,
       avg(abs({e})) AS mae_mw,
       avg(CASE WHEN actual_mw > 0 THEN abs({e}) / actual_mw * 100.0 END) AS mape_pct,
       sqrt(avg(power({e}, 2))) AS rmse_mw,
       avg({e}) AS bias_mw,
       sum(actual_mw) AS total_actual_mw,
       sum({fc}_forecast_mw) AS total_forecast_mw,
       count(*) AS observation_count,
       max(actual_mw) AS peak_actual_mw,
       max(abs({e})) AS max_error_mw,
       '{tag}' AS resource_type,
       {_i('year(CAST(interval_start AS DATE))')} AS year,
       {_i('month(CAST(interval_start AS DATE))')} AS month
FROM {base} GROUP BY CAST(interval_start AS DATE)"""


def _acc_hour(base: str, fc: str, tag: str) -> str:
    e = f"{fc}_error_mw"
    return f"""
SELECT hour_of_day,
       avg(abs({e})) AS avg_mae_mw,
       avg(CASE WHEN actual_mw > 0 THEN abs({e}) / actual_mw * 100.0 END) AS avg_mape_pct,
       avg({e}) AS avg_bias_mw,
       stddev_samp({e}) AS error_stddev_mw,
       count(*) AS observation_count,
       '{tag}' AS resource_type
FROM {base} GROUP BY hour_of_day"""


def _curt_hour(src: str, tag: str) -> str:
    v = "estimated_curtailment_mw"
    return (f"SELECT hour_of_day, avg({v}) AS avg_curtailment_mw, sum({v}) AS total_curtailment_mwh, "
            f"count(*) AS curtailment_hours, max({v}) AS max_curtailment_mw, "
            f"'{tag}' AS resource_type FROM {src} WHERE {v} > 0 GROUP BY hour_of_day")


def _daily_side(src: str, tag: str) -> str:
    return (f"SELECT CAST(interval_start AS DATE) AS date, "
            f"sum(estimated_curtailment_mw) AS {tag}_curtailment_mwh, "
            f"sum(actual_mw) AS {tag}_generation_mwh FROM {src} GROUP BY 1")


def _regional_wide(sanitized: bool) -> str:
    cols = []
    for r in REGIONS:
        name = r.replace(" ", "_") if sanitized else r
        cols.append(f"CAST(SUM(CASE WHEN g.r_name = '{r}' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) END)"
                    f" AS DOUBLE) AS \"GEN_{name}\"")
        cols.append(f"CAST(250000.0 AS DOUBLE) * NULLIF(COUNT(CASE WHEN g.r_name = '{r}' "
                    f"THEN o.o_totalprice END), 0) AS \"STPPF_{name}\"")
    return f"""
SELECT o.o_orderdate AS Interval_Start, o.o_orderdate + INTERVAL 1 DAY AS Interval_End,
       {', '.join(cols)}
FROM orders o JOIN geo g ON o.o_custkey = g.c_custkey
GROUP BY o.o_orderdate"""


def _wind_regional() -> str:
    parts = []
    for r in REGIONS:
        hit = f"g.r_name = '{r}'"
        n = f"NULLIF(COUNT(CASE WHEN {hit} THEN o.o_totalprice END), 0)"
        parts.append(f"""
SELECT o.o_orderdate AS interval_start, o.o_orderdate + INTERVAL 1 DAY AS interval_end,
       o.o_orderdate - INTERVAL 1 DAY AS "Publish_Time", '{r.replace(' ', '_')}' AS region,
       CAST(SUM(CASE WHEN {hit} THEN CAST(o.o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS gen_mw,
       MAX(CASE WHEN {hit} THEN o.o_totalprice END) * {n} AS hsl_mw,
       CAST(250000.0 AS DOUBLE) * {n} AS stwpf_mw, CAST(275000.0 AS DOUBLE) * {n} AS wgrpp_mw
FROM orders o JOIN geo g ON o.o_custkey = g.c_custkey GROUP BY o.o_orderdate""")
    return " UNION ALL ".join(parts)


def _regional_long() -> str:
    parts = []
    for r in REGIONS:
        n = r.replace(" ", "_")
        parts.append(f"SELECT Interval_Start AS interval_start, Interval_End AS interval_end, "
                     f"'{n}' AS region, \"GEN_{n}\" AS gen_mw, \"STPPF_{n}\" AS stppf_mw "
                     f"FROM regional_wide_s")
    return " UNION ALL ".join(parts)


def _price_group(src: str, by: str, suffix: str, qs, stddev: bool, range_name: str | None,
                 count_name: str, peak: bool) -> str:
    p = "lmp_price"
    cols = [f"avg({p}) AS avg_{suffix}", f"min({p}) AS min_{suffix}", f"max({p}) AS max_{suffix}"]
    for q in qs:
        name = "median" if q == 0.5 else f"p{round(q * 100):02d}"
        cols.append(f"quantile_cont({p}, {q}) AS {name}_{suffix}")
    if stddev:
        cols.append(f"stddev_samp({p}) AS stddev_{suffix}")
    if range_name:
        cols.append(f"max({p}) - min({p}) AS {range_name}")
    cols.append(f"count(*) AS {count_name}")
    if peak:
        cols += [f"avg(CASE WHEN is_peak_hour THEN {p} END) AS avg_peak_{suffix}",
                 f"avg(CASE WHEN NOT is_peak_hour THEN {p} END) AS avg_offpeak_{suffix}",
                 f"avg(CASE WHEN is_peak_hour THEN {p} END) - avg(CASE WHEN NOT is_peak_hour "
                 f"THEN {p} END) AS peak_offpeak_spread"]
    return f"SELECT {by}, {', '.join(cols)} FROM {src} GROUP BY {by}"


def _point_daily(cls: str, range_name: str) -> str:
    inner = _price_group(f"(SELECT * FROM lmp WHERE point_type = '{cls}')",
                         "delivery_date, settlement_point", "lmp", (0.5,), False, range_name,
                         "hours_count", False)
    return (f"SELECT *, {_i('year(delivery_date)')} AS year, {_i('month(delivery_date)')} AS month "
            f"FROM ({inner})")


def _pivot() -> str:
    cols = ", ".join(f"arg_min(lmp_price, interval_start) FILTER (WHERE settlement_point = '{h}') "
                     f"AS {h}" for h in HUBS)
    return (f"SELECT delivery_date, hour_of_day, {cols} FROM lmp WHERE point_type = 'Hub' "
            f"GROUP BY delivery_date, hour_of_day")


def _dround(expr: str, d: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


# ------------------------------------------------------------- fragments
F: dict[str, str] = {
    "ev_hours": """
SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS Interval_Start
FROM (SELECT min(date_trunc('hour', ts)) AS lo, max(date_trunc('hour', ts)) AS hi FROM events)""",
    "solar_bronze": _feed("click", "STPPF_SYSTEM_WIDE", "PVGRPP_SYSTEM_WIDE"),
    "wind_bronze": _feed("view", "STWPF_SYSTEM_WIDE", "WGRPP_SYSTEM_WIDE"),
    "solar": _silver("solar_bronze", "stppf", "pvgrpp", "STPPF_SYSTEM_WIDE",
                     "PVGRPP_SYSTEM_WIDE", "solar_hourly_actual_forecast"),
    "wind": _silver("wind_bronze", "stwpf", "wgrpp", "STWPF_SYSTEM_WIDE",
                    "WGRPP_SYSTEM_WIDE", "wind_hourly_actual_forecast"),
    "combined": _slim("solar", "solar", "stppf") + " UNION ALL " + _slim("wind", "wind", "stwpf"),
    "totals_raw": """
SELECT interval_start, max(interval_end) AS interval_end,
       sum(actual_mw) AS total_renewable_actual_mw,
       sum(hsl_mw) AS total_renewable_hsl_mw,
       sum(estimated_curtailment_mw) AS total_curtailment_mw,
       sum(CASE WHEN resource_type = 'solar' THEN actual_mw END) AS solar_actual_mw,
       sum(CASE WHEN resource_type = 'wind' THEN actual_mw END) AS wind_actual_mw
FROM combined GROUP BY interval_start""",
    "totals": f"""
SELECT *, {_i('hour(interval_start)')} AS hour_of_day, dayname(interval_start) AS day_of_week,
       dayofweek(interval_start) IN (0, 6) AS is_weekend, {_parts('interval_start')},
       solar_actual_mw / NULLIF(total_renewable_actual_mw, 0) * 100.0 AS solar_pct,
       wind_actual_mw / NULLIF(total_renewable_actual_mw, 0) * 100.0 AS wind_pct
FROM totals_raw""",
    "acc_base_solar": _acc_base("solar", "stppf", 10.0),
    "acc_base_wind": _acc_base("wind", "stwpf", 100.0),
    "acc_daily_solar": _acc_daily("acc_base_solar", "stppf", "solar"),
    "acc_hour_solar": _acc_hour("acc_base_solar", "stppf", "solar"),
    "acc_daily_wind": _acc_daily("acc_base_wind", "stwpf", "wind"),
    "acc_hour_wind": _acc_hour("acc_base_wind", "stwpf", "wind"),
    "hour_profile": """
SELECT hour_of_day,
       avg(total_renewable_actual_mw) AS avg_total_mw,
       avg(solar_actual_mw) AS avg_solar_mw,
       avg(wind_actual_mw) AS avg_wind_mw,
       quantile_disc(total_renewable_actual_mw, 0.1) AS p10_total_mw,
       quantile_disc(total_renewable_actual_mw, 0.5) AS p50_total_mw,
       quantile_disc(total_renewable_actual_mw, 0.9) AS p90_total_mw,
       max(total_renewable_actual_mw) AS max_total_mw,
       min(total_renewable_actual_mw) AS min_total_mw,
       stddev_samp(total_renewable_actual_mw) AS stddev_total_mw,
       count(*) AS observation_count
FROM totals GROUP BY hour_of_day""",
    "monthly": """
SELECT year, month,
       sum(total_renewable_actual_mw) AS total_generation_mwh,
       sum(solar_actual_mw) AS solar_generation_mwh,
       sum(wind_actual_mw) AS wind_generation_mwh,
       sum(total_curtailment_mw) AS total_curtailment_mwh,
       max(total_renewable_actual_mw) AS peak_hour_mw,
       avg(total_renewable_actual_mw) AS avg_hour_mw,
       count(*) AS hours_in_month,
       avg(total_renewable_actual_mw) / NULLIF(max(total_renewable_actual_mw), 0) * 100.0
         AS capacity_factor_estimate,
       sum(solar_actual_mw) / NULLIF(sum(total_renewable_actual_mw), 0) * 100.0 AS solar_share_pct,
       sum(wind_actual_mw) / NULLIF(sum(total_renewable_actual_mw), 0) * 100.0 AS wind_share_pct
FROM totals GROUP BY year, month""",
    "dow_profile": """
SELECT day_of_week, hour_of_day,
       avg(total_renewable_actual_mw) AS avg_total_mw,
       avg(solar_actual_mw) AS avg_solar_mw,
       avg(wind_actual_mw) AS avg_wind_mw
FROM totals GROUP BY day_of_week, hour_of_day""",
    "curt_hour_solar": _curt_hour("solar", "solar"),
    "curt_hour_wind": _curt_hour("wind", "wind"),
    "curt_hourly": "SELECT * FROM curt_hour_solar UNION ALL SELECT * FROM curt_hour_wind",
    "daily_solar": _daily_side("solar", "solar"),
    "daily_wind": _daily_side("wind", "wind"),
    "curt_daily": f"""
SELECT date, solar_curtailment_mwh, solar_generation_mwh, wind_curtailment_mwh,
       wind_generation_mwh,
       solar_curtailment_mwh + wind_curtailment_mwh AS total_curtailment_mwh,
       solar_generation_mwh + wind_generation_mwh AS total_generation_mwh,
       (solar_curtailment_mwh + wind_curtailment_mwh)
         / NULLIF((solar_generation_mwh + wind_generation_mwh)
                  + (solar_curtailment_mwh + wind_curtailment_mwh), 0) * 100.0
         AS curtailment_rate_pct,
       {_i('year(date)')} AS year, {_i('month(date)')} AS month
FROM daily_solar JOIN daily_wind USING (date)""",
    "feat_rolled": """
SELECT *,
       lag(actual_mw, 1) OVER w AS actual_lag_1h,
       lag(actual_mw, 24) OVER w AS actual_lag_24h,
       lag(actual_mw, 168) OVER w AS actual_lag_168h,
       avg(actual_mw) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS actual_avg_24h,
       avg(actual_mw) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS actual_avg_168h,
       max(actual_mw) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS actual_max_24h,
       min(actual_mw) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS actual_min_24h,
       stddev_samp(actual_mw) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS actual_std_24h
FROM (SELECT * FROM solar WHERE actual_mw IS NOT NULL)
WINDOW w AS (ORDER BY interval_start)""",
    "features": f"""
SELECT interval_start, hour_of_day, is_weekend, actual_lag_1h, actual_lag_24h, actual_lag_168h,
       actual_avg_24h, actual_avg_168h, actual_max_24h, actual_min_24h, actual_std_24h,
       sin(2 * pi() * hour_of_day / 24) AS hour_sin,
       cos(2 * pi() * hour_of_day / 24) AS hour_cos,
       {_i('dayofyear(interval_start)')} AS day_of_year,
       {_i('month(interval_start)')} AS month_num,
       {_i('dayofweek(interval_start) + 1')} AS day_of_week_num,
       actual_lag_24h AS same_hour_yesterday, actual_lag_168h AS same_hour_last_week,
       stppf_forecast_mw, actual_mw AS target_actual_mw, year, month, day
FROM feat_rolled WHERE actual_lag_168h IS NOT NULL""",
    "dam_bronze": f"""
SELECT date_trunc('hour', ts) AS Interval_Start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS Interval_End,
       CASE WHEN hour(ts) = 3 THEN 'HB_PAN'
            ELSE {_POINT_LIST}[CAST(user_id % {len(POINTS)} AS INTEGER) + 1] END AS Location,
       'SP' AS Location_Type, 'DAM' AS Market,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) - 30.0 AS LMP
FROM events GROUP BY 1, 2, 3""",
    "lmp": f"""
SELECT Interval_Start AS interval_start, Interval_End AS interval_end,
       Location AS settlement_point, Location_Type AS settlement_point_type, Market,
       LMP AS lmp_price,
       CAST(Interval_Start AS DATE) AS delivery_date,
       {_i('hour(Interval_End)')} AS hour_ending,
       {_i('hour(Interval_Start)')} AS hour_of_day,
       dayname(Interval_Start) AS day_of_week,
       dayofweek(Interval_Start) IN (0, 6) AS is_weekend,
       hour(Interval_Start) >= 7 AND hour(Interval_Start) < 22 AS is_peak_hour,
       CASE WHEN contains(Location, 'HB_') THEN 'Hub'
            WHEN contains(Location, 'LZ_') THEN 'Load Zone'
            WHEN contains(Location, 'ZONE') THEN 'Load Zone'
            ELSE 'Resource Node' END AS point_type,
       'lmp_day_ahead_market' AS _source_table,
       {_parts('Interval_Start')}
FROM dam_bronze""",
    "hub_daily": _point_daily("Hub", "price_spread"),
    "lz_daily": _point_daily("Load Zone", "daily_price_range"),
    "daily_stats": "SELECT *, " + _i("year(date)") + " AS year, " + _i("month(date)")
    + " AS month FROM (" + _price_group(
        "(SELECT * EXCLUDE (delivery_date), delivery_date AS date FROM lmp)",
        "date, settlement_point, point_type", "price", (0.25, 0.5, 0.75), True, "daily_range",
        "hours_count", True) + ")",
    "hub_hourly": _price_group("(SELECT * FROM lmp WHERE point_type = 'Hub')",
                               "settlement_point, hour_of_day", "price", (0.1, 0.5, 0.9), True,
                               None, "observation_count", False),
    "hub_pivot": _pivot(),
    "hub_comparison": f"""
SELECT *, HB_HOUSTON - HB_WEST AS houston_west_spread, HB_NORTH - HB_SOUTH AS north_south_spread,
       {_i('year(delivery_date)')} AS year, {_i('month(delivery_date)')} AS month
FROM hub_pivot""",
    "daily_spreads": f"""
SELECT delivery_date,
       avg(houston_west_spread) AS avg_houston_west_spread,
       min(houston_west_spread) AS min_houston_west_spread,
       max(houston_west_spread) AS max_houston_west_spread,
       avg(north_south_spread) AS avg_north_south_spread,
       min(north_south_spread) AS min_north_south_spread,
       max(north_south_spread) AS max_north_south_spread,
       {_i('year(delivery_date)')} AS year, {_i('month(delivery_date)')} AS month
FROM hub_comparison GROUP BY delivery_date""",
    "vol_raw": """
SELECT *,
       avg(avg_price) OVER w7 AS rolling_7d_avg,
       stddev_samp(avg_price) OVER w7 AS rolling_7d_stddev,
       avg(avg_price) OVER w30 AS rolling_30d_avg,
       stddev_samp(avg_price) OVER w30 AS rolling_30d_stddev
FROM daily_stats WHERE point_type = 'Hub'
WINDOW w7 AS (PARTITION BY settlement_point ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY settlement_point ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "volatility": """
SELECT *,
       rolling_7d_stddev / NULLIF(rolling_7d_avg, 0) * 100.0 AS cv_7d,
       rolling_30d_stddev / NULLIF(rolling_30d_avg, 0) * 100.0 AS cv_30d,
       max_price > rolling_30d_avg * 2.0 AS is_price_spike,
       max_price > 100.0 AS has_extreme_high,
       min_price < 0.0 AS has_negative_price
FROM vol_raw""",
    "houston_join": """
SELECT l.interval_start, l.delivery_date, l.hour_of_day, l.settlement_point,
       l.lmp_price AS houston_lmp, t.total_renewable_actual_mw, t.solar_actual_mw,
       t.wind_actual_mw, t.total_curtailment_mw
FROM lmp l JOIN totals t ON l.interval_start = t.interval_start
WHERE contains(l.settlement_point, 'HOUSTON')""",
    "correlation": f"""
SELECT delivery_date,
       avg(houston_lmp) AS avg_lmp,
       avg(total_renewable_actual_mw) AS avg_renewable_mw,
       avg(solar_actual_mw) AS avg_solar_mw,
       avg(wind_actual_mw) AS avg_wind_mw,
       avg(total_curtailment_mw) AS avg_curtailment_mw,
       CAST(sum(CASE WHEN houston_lmp < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_price_hours,
       count(*) AS hours_count,
       {_i('year(delivery_date)')} AS year, {_i('month(delivery_date)')} AS month
FROM houston_join GROUP BY delivery_date""",
    "geo": """
SELECT c.c_custkey, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "regional_wide": _regional_wide(False),
    "regional_wide_s": _regional_wide(True),
    "regional": f"""
SELECT *, {_i('hour(interval_start)')} AS hour_of_day, {_parts('interval_start')},
       'solar_hourly_actual_forecast_regional' AS _source_table
FROM ({_regional_long()})""",
    "wind_regional": f"""
SELECT *, {_i('hour(interval_start)')} AS hour_of_day, {_parts('interval_start')},
       'wind_hourly_actual_forecast_regional' AS _source_table
FROM ({_wind_regional()})""",
    "zoned": """
SELECT interval_start,
       (interval_start AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS local_start
FROM solar""",
    "ev_hwm": "SELECT max(CAST(ts AS DATE)) AS d FROM events",
    "up_target": "SELECT *, ts AS _ingested_at FROM events "
                 "WHERE ts < (SELECT d FROM ev_hwm) - INTERVAL 2 DAY",
    "up_batch": """
SELECT event_id, ts, user_id, event_type, value + 1.0 AS value, props,
       ts + INTERVAL 1 DAY AS _ingested_at
FROM events WHERE ts >= (SELECT d FROM ev_hwm) - INTERVAL 10 DAY
UNION ALL
SELECT event_id, ts, user_id, event_type, value + 2.0 AS value, props,
       ts + INTERVAL 2 DAY AS _ingested_at
FROM events WHERE ts >= (SELECT d FROM ev_hwm) - INTERVAL 10 DAY AND event_type = 'click'""",
    "up_batch_latest": """
SELECT * FROM up_batch
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at DESC, ts DESC,
        user_id DESC, event_type DESC, value DESC, props DESC) = 1""",
    "upserted": """
SELECT * FROM up_target t
WHERE NOT EXISTS (SELECT 1 FROM up_batch_latest b WHERE b.event_id IS NOT DISTINCT FROM t.event_id)
UNION ALL SELECT * FROM up_batch_latest""",
    "li_latest": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
  l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
  l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""",
    "dam_twice": """
SELECT *, Interval_Start AS _ingested_at FROM dam_bronze
UNION ALL
SELECT Interval_Start, Interval_End, Location, Location_Type, Market, LMP + 0.5 AS LMP,
       Interval_Start + INTERVAL 1 DAY AS _ingested_at
FROM dam_bronze WHERE starts_with(Location, 'HB_')""",
    "dam_latest": """
SELECT * FROM dam_twice
QUALIFY row_number() OVER (PARTITION BY Interval_Start, Location, Market, Location_Type
        ORDER BY _ingested_at DESC, Interval_End DESC, LMP DESC) = 1""",
    "o_hwm": "SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders",
}


def _qc(src: str, name: str, time_col: str, ingest: bool) -> str:
    ni = (f"count(*) FILTER (WHERE _ingested_at IS NULL)" if ingest
          else "CAST(NULL AS BIGINT)")
    return f"""
SELECT '{name}' AS table_name, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'ok' END AS status,
       '{time_col}' AS time_column, count(*) AS row_count,
       min(CAST({time_col} AS DATE)) AS min_date, max(CAST({time_col} AS DATE)) AS max_date,
       count(*) FILTER (WHERE {time_col} IS NULL) AS null_time_column,
       {ni} AS null_ingested_at,
       (SELECT count(*) FROM (SELECT {time_col} FROM {src} GROUP BY {time_col}
                              HAVING count(*) > 1)) AS duplicate_intervals
FROM {src}"""


F["solar_landed_i"] = "SELECT *, Interval_Start + INTERVAL 1 DAY AS _ingested_at FROM solar_bronze"
F["dam_twice_i"] = ("SELECT * EXCLUDE (_ingested_at), Interval_Start + INTERVAL 1 DAY "
                    "AS _ingested_at FROM dam_twice")
F["quality"] = " UNION ALL ".join([
    _qc("events", "events", "ts", False),
    _qc("lineitem", "lineitem", "l_shipdate", False),
    _qc("solar_landed_i", "solar_hourly_actual_forecast", "Interval_Start", True),
    _qc("dam_twice_i", "lmp_day_ahead_market", "Interval_Start", True),
    """SELECT 'customer' AS table_name, 'no_time_column' AS status, CAST(NULL AS VARCHAR) AS time_column,
       count(*) AS row_count, CAST(NULL AS DATE) AS min_date, CAST(NULL AS DATE) AS max_date,
       CAST(NULL AS BIGINT) AS null_time_column, CAST(NULL AS BIGINT) AS null_ingested_at,
       CAST(NULL AS BIGINT) AS duplicate_intervals FROM customer""",
    """SELECT 'fuel_mix' AS table_name, 'table_not_found' AS status, CAST(NULL AS VARCHAR) AS time_column,
       CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS DATE) AS min_date, CAST(NULL AS DATE) AS max_date,
       CAST(NULL AS BIGINT) AS null_time_column, CAST(NULL AS BIGINT) AS null_ingested_at,
       CAST(NULL AS BIGINT) AS duplicate_intervals""",
])

# dependency order of the fragments (a fragment may use any fragment above it)
ORDER = list(F)


def _deps(sql: str) -> list[str]:
    import re
    names = set()
    for name in ORDER:
        if re.search(rf"\b{re.escape(name)}\b", sql):
            names.add(name)
    return list(names)


def build(final: str, round_doubles: bool = True, other: dict[str, str] | None = None) -> str:
    """``WITH <needed fragments> <final>``; doubles rounded to 6 decimals; ``other`` fragments take the place of those of
    the same name."""
    needed, own = set(), F | (other or {})
    stack = _deps(final)
    while stack:
        n = stack.pop()
        if n in needed:
            continue
        needed.add(n)
        stack.extend(d for d in _deps(own[n]) if d != n)
    ctes = [f"{n} AS ({own[n]}\n)" for n in ORDER if n in needed]
    body = final
    if round_doubles:
        names = ", ".join(f"'{c}'" for c in DOUBLE_COLUMNS)
        # decimal rounding, half up, as Spark rounds: a double just under a ...5 boundary is on it
        body = (f"SELECT CAST(round(TRY_CAST(COLUMNS(lambda c: c IN ({names})) AS DECIMAL(38,9)), 6) AS DOUBLE) "
                f"+ CAST(0.0 AS DOUBLE), "
                f"COLUMNS(lambda c: c NOT IN ({names})) FROM ({final}) AS q")
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


def _sel(frag: str, *cols: str, where: str | None = None) -> str:
    return f"SELECT {', '.join(cols)} FROM {frag}" + (f" WHERE {where}" if where else "")


S = "interval_start"
SOLAR_CANON = ("interval_start", "interval_end", "report_time", "actual_mw", "hsl_mw",
               "stppf_forecast_mw", "pvgrpp_forecast_mw", "cop_hsl_mw")
WIND_CANON = ("interval_start", "interval_end", "report_time", "actual_mw", "hsl_mw",
              "stwpf_forecast_mw", "wgrpp_forecast_mw", "cop_hsl_mw")

_NO_ROUND = {"INC-1", "QC-1", "QC-2", "QC-3", "QC-4", "QC-5", "QC-6", "QC-8", "AGG-18",
             "PRJ-5", "PRJ-6", "PRJ-7", "PRJ-8", "PRJ-9", "PRJ-10", "PRJ-14", "PRJ-15",
             "PRJ-16", "EXT-zone", "PRJ-25", "PRJ-26", "PRJ-27", "SNK-1", "QC-7", "AGG-19",
             "EXT-rejects", "EXT-counts"}

_FINAL = {
    "SRC-1": ("SELECT *, CAST(hour(Interval_Start) AS VARCHAR) AS \"Operator_Note\" FROM solar_bronze "
              "WHERE Interval_Start >= (SELECT d FROM ev_hwm) - INTERVAL 9 DAY "
              "AND Interval_Start < (SELECT d FROM ev_hwm) - INTERVAL 1 DAY"),
    "SRC-2": "SELECT * FROM regional_wide_s",
    "SRC-3": "SELECT *, 'lmp_day_ahead_market' AS _source, 'dam_lmp' AS _endpoint, "
             "true AS has_ingested_at FROM dam_bronze",
    "SRC-4": "SELECT * FROM solar",
    "SNK-1": f"SELECT Interval_Start, {_parts('Interval_Start')} FROM solar_bronze",
    "SNK-2": (f"SELECT *, {_i('year(Interval_Start)')} AS year, {_i('month(Interval_Start)')} AS month "
              f"FROM solar_bronze UNION ALL BY NAME "
              f"SELECT *, {_i('year(Interval_Start)')} AS year, {_i('month(Interval_Start)')} AS month "
              f"FROM wind_bronze"),
    "SNK-3": (f"SELECT *, {_i('year(Interval_Start)')} AS year, {_i('month(Interval_Start)')} AS month "
              f"FROM solar_bronze"),
    "SNK-4": "SELECT * FROM wind_bronze",
    "SNK-5": "SELECT * FROM upserted",
    "SNK-6": "SELECT * FROM li_latest",
    "SNK-7": "SELECT * FROM dam_latest",
    "SNK-8": (f"SELECT *, {_i('year(Interval_Start)')} AS year, {_i('month(Interval_Start)')} AS month "
              f"FROM solar_bronze"),
    "INC-1": "SELECT d AS max_date FROM o_hwm",
    "INC-2": ("SELECT * FROM orders WHERE o_orderdate >= (SELECT d FROM o_hwm) - INTERVAL 7 DAY "
              "AND o_orderdate < (SELECT d FROM o_hwm) + INTERVAL 1 DAY"),
    "QC-1": "SELECT table_name, status FROM quality",
    "QC-2": "SELECT table_name, row_count FROM quality",
    "QC-3": "SELECT table_name, time_column FROM quality",
    "QC-4": "SELECT table_name, min_date, max_date FROM quality",
    "QC-5": "SELECT table_name, null_time_column, null_ingested_at FROM quality",
    "QC-6": "SELECT table_name, duplicate_intervals FROM quality",
    "QC-7": ("SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem "
             "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    "QC-8": "SELECT * FROM quality",
    "PRJ-1": _sel("solar", *SOLAR_CANON),
    "PRJ-2": _sel("wind", *WIND_CANON),
    "PRJ-3": _sel("lmp", S, "interval_end", "settlement_point", "settlement_point_type",
                  "lmp_price", "Market"),
    "PRJ-4": ("SELECT * EXCLUDE (Interval_Start, Interval_End), Interval_Start AS interval_start, "
              "Interval_End AS interval_end FROM regional_wide_s"),
    "PRJ-5": _sel("solar", S, "hour_of_day"),
    "PRJ-6": _sel("solar", S, "day_of_week"),
    "PRJ-7": _sel("solar", S, "is_weekend"),
    "PRJ-8": _sel("lmp", S, "settlement_point", "is_peak_hour"),
    "PRJ-9": _sel("lmp", S, "settlement_point", "hour_ending"),
    "PRJ-10": _sel("lmp", S, "settlement_point", "delivery_date"),
    "PRJ-11": _sel("solar", S, "stppf_error_mw"),
    "PRJ-12": _sel("solar", S, "stppf_error_pct"),
    "PRJ-13": _sel("combined", S, "resource_type", "estimated_curtailment_mw"),
    "PRJ-14": _sel("lmp", S, "settlement_point", "point_type"),
    "PRJ-15": _sel("solar", S, "year", "month", "day"),
    "PRJ-16": _sel("lmp", S, "settlement_point", "_source_table", "true AS has_transformed_at"),
    "PRJ-17": _sel("combined", S, "resource_type", "forecast_mw"),
    "PRJ-18": _sel("acc_base_solar", S, "actual_mw", "stppf_forecast_mw"),
    "PRJ-19": _sel("lmp", S, "settlement_point", "lmp_price", where="point_type = 'Hub'"),
    "PRJ-20": _sel("lmp", S, "settlement_point", "lmp_price",
                   where="contains(settlement_point, 'HOUSTON')"),
    "PRJ-21": _sel("totals", S, "solar_pct", "wind_pct"),
    "PRJ-22": _sel("monthly", "year", "month", "capacity_factor_estimate"),
    "PRJ-23": _sel("curt_daily", "date", "curtailment_rate_pct"),
    "PRJ-24": _sel("features", S, "hour_sin", "hour_cos"),
    "PRJ-25": _sel("features", S, "month_num", "day_of_week_num"),
    "PRJ-26": _sel("features", S, "day_of_year"),
    "PRJ-27": _sel("volatility", "date", "settlement_point", "is_price_spike",
                   "has_extreme_high", "has_negative_price"),
    "PRJ-28": _sel("volatility", "date", "settlement_point", "cv_7d", "cv_30d"),
    "PRJ-29": "SELECT * FROM features",
    "JOI-1": "SELECT * FROM curt_daily",
    "JOI-2": "SELECT * FROM houston_join",
    "AGG-1": "SELECT * FROM totals",
    "AGG-2": "SELECT * FROM hub_daily",
    "AGG-3": "SELECT * FROM lz_daily",
    "AGG-4": "SELECT * FROM acc_daily_solar",
    "AGG-5": "SELECT * FROM acc_hour_solar",
    "AGG-6": "SELECT * FROM acc_daily_wind",
    "AGG-7": "SELECT * FROM acc_hour_wind",
    "AGG-8": "SELECT * FROM hour_profile",
    "AGG-9": "SELECT * FROM monthly",
    "AGG-10": "SELECT * FROM dow_profile",
    "AGG-11": "SELECT * FROM curt_hour_solar",
    "AGG-12": "SELECT * FROM curt_hour_wind",
    "AGG-13": "SELECT * FROM curt_daily",
    "AGG-14": "SELECT * FROM daily_stats",
    "AGG-15": "SELECT * FROM hub_hourly",
    "AGG-16": "SELECT * FROM daily_spreads",
    "AGG-17": "SELECT * FROM correlation",
    "AGG-18": ("SELECT table_name, row_count, min_date, max_date, null_time_column, "
               "null_ingested_at FROM quality"),
    "AGG-19": ("SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem "
               "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    "AGG-20": "SELECT * FROM hub_pivot",
    "WIN-1": "SELECT * FROM li_latest",
    "WIN-2": _sel("feat_rolled", S, "actual_lag_1h", "actual_lag_24h", "actual_lag_168h"),
    "WIN-3": _sel("features", S, "same_hour_yesterday", "same_hour_last_week"),
    "WIN-4": _sel("feat_rolled", S, "actual_avg_24h", "actual_avg_168h"),
    "WIN-5": _sel("feat_rolled", S, "actual_max_24h", "actual_min_24h"),
    "WIN-6": _sel("feat_rolled", S, "actual_std_24h"),
    "WIN-7": _sel("features", S, "target_actual_mw", "actual_lag_168h"),
    "WIN-8": _sel("volatility", "date", "settlement_point", "rolling_7d_avg", "rolling_7d_stddev"),
    "WIN-9": _sel("volatility", "date", "settlement_point", "rolling_30d_avg",
                  "rolling_30d_stddev"),
    "SRT-1": "SELECT * FROM solar ORDER BY interval_start DESC LIMIT 100",
    "SRT-2": ("SELECT date, mae_mw, mape_pct, bias_mw, observation_count FROM acc_daily_solar "
              "ORDER BY date DESC LIMIT 30"),
    "SRT-3": "SELECT * FROM hub_hourly ORDER BY settlement_point, hour_of_day",
    "SET-1": "SELECT * FROM combined",
    "SET-2": "SELECT * FROM curt_hourly",
    "RSH-1": "SELECT * FROM regional",
    "RSH-2": _sel("hub_comparison", "delivery_date", "hour_of_day", "houston_west_spread",
                  "north_south_spread"),
    "RPT-1": ("SELECT date, mae_mw, mape_pct, bias_mw, observation_count FROM acc_daily_solar "
              "ORDER BY date DESC LIMIT 30"),
    "RPT-2": (f"SELECT hour_of_day, {_dround('avg_solar_mw', 0)} AS avg_solar_mw, "
              f"{_dround('avg_wind_mw', 0)} AS avg_wind_mw, {_dround('avg_total_mw', 0)} AS avg_total_mw, "
              f"{_dround('p10_total_mw', 0)} AS p10_mw, {_dround('p90_total_mw', 0)} AS p90_mw "
              f"FROM hour_profile ORDER BY hour_of_day"),
    "RPT-3": (f"SELECT year, month, {_dround('total_generation_mwh / 1000', 1)} AS total_gwh, "
              f"{_dround('solar_share_pct', 1)} AS solar_pct, {_dround('wind_share_pct', 1)} AS wind_pct, "
              f"{_dround('total_curtailment_mwh / 1000', 1)} AS curtailment_gwh "
              f"FROM monthly ORDER BY year DESC, month DESC"),
    "RPT-4": (f"SELECT date, settlement_point, {_dround('avg_price', 2)} AS avg_price, "
              f"{_dround('min_price', 2)} AS min_price, {_dround('max_price', 2)} AS max_price, "
              f"{_dround('peak_offpeak_spread', 2)} AS peak_offpeak_spread "
              f"FROM daily_stats WHERE point_type = 'Hub' "
              f"ORDER BY date DESC, settlement_point LIMIT 50"),
    "RPT-5": (f"SELECT settlement_point, hour_of_day, {_dround('avg_price', 2)} AS avg_price, "
              f"{_dround('p10_price', 2)} AS p10_price, {_dround('p90_price', 2)} AS p90_price, "
              f"observation_count FROM hub_hourly ORDER BY settlement_point, hour_of_day"),
    "RPT-6": (f"SELECT date, settlement_point, {_dround('avg_price', 2)} AS avg_price, "
              f"{_dround('rolling_7d_stddev', 2)} AS volatility_7d, {_dround('cv_7d', 1)} AS cv_7d_pct, "
              f"is_price_spike, has_negative_price FROM volatility "
              f"WHERE date >= (SELECT max(date) FROM volatility) - 30 "
              f"ORDER BY date DESC, settlement_point"),
    "PIP-1": "SELECT * FROM solar",
    "PIP-2": "SELECT * FROM wind",
    "PIP-3": "SELECT * FROM totals",
    "PIP-4": "SELECT * FROM regional",
    "PIP-5": "SELECT * FROM lmp",
    "PIP-6": "SELECT * FROM hub_daily",
    "PIP-7": "SELECT * FROM lz_daily",
    "PIP-8": "SELECT * FROM acc_daily_solar",
    "PIP-9": "SELECT * FROM acc_daily_wind",
    "PIP-10": "SELECT * FROM hour_profile",
    "PIP-11": "SELECT * FROM curt_daily",
    "PIP-12": "SELECT * FROM features",
    "PIP-13": "SELECT * FROM daily_stats",
    "PIP-14": "SELECT * FROM hub_comparison",
    "PIP-15": "SELECT * FROM volatility",
    "PIP-16": "SELECT * FROM correlation",
    "PIP-4-wind": "SELECT * FROM wind_regional",
    "EXT-horizon": ("SELECT interval_start, date_diff('second', report_time, interval_start) / 3600.0 "
                    "AS forecast_horizon_hours, report_time < interval_start AS is_forecast FROM solar"),
    "EXT-skill": """
SELECT CAST(interval_start AS DATE) AS date,
       avg(power(stppf_forecast_mw - actual_mw, 2)) AS mse_forecast,
       avg(power(actual_lag_24h - actual_mw, 2)) AS mse_persistence, count(*) AS observation_count,
       1.0 - avg(power(stppf_forecast_mw - actual_mw, 2)) / NULLIF(avg(power(actual_lag_24h - actual_mw, 2)), 0)
         AS skill_score
FROM feat_rolled
WHERE stppf_forecast_mw IS NOT NULL AND actual_mw > 10 AND actual_lag_24h IS NOT NULL
GROUP BY 1""",
    "EXT-quantiles": "SELECT * FROM daily_stats",
    "EXT-features": "SELECT * FROM features",
    "EXT-corr": ("SELECT c.*, x.lmp_renewable_corr FROM correlation c JOIN (SELECT delivery_date, "
                 "corr(houston_lmp, total_renewable_actual_mw) AS lmp_renewable_corr FROM houston_join "
                 "GROUP BY delivery_date) x USING (delivery_date)"),
    "EXT-zone": (f"SELECT interval_start, {_i('hour(local_start)')} AS hour_of_day, "
                 f"dayname(local_start) AS day_of_week, dayofweek(local_start) IN (0, 6) AS is_weekend FROM zoned"),
    "EXT-types": """
SELECT CAST(o_orderdate AS TIMESTAMP) AS "Time",
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN CAST(count(*) AS DOUBLE) ELSE count(*) / CAST(4.0 AS DOUBLE) END AS orders_mw
FROM orders GROUP BY o_orderdate""",
    "EXT-rejects": """
SELECT 'LMP' AS "column", 'N/A' AS raw, 'not a double' AS reason, count(*) AS n FROM dam_bronze WHERE Location = 'RN_1' AND hour(Interval_Start) = 5
HAVING count(*) > 0
UNION ALL
SELECT 'loaded', NULL, 'rejected ' || count(*) FILTER (WHERE Location = 'RN_1' AND hour(Interval_Start) = 5),
       count(*) FILTER (WHERE NOT (Location = 'RN_1' AND hour(Interval_Start) = 5)) FROM dam_bronze""",
    "EXT-counts": """
SELECT 'first' AS load, (SELECT count(*) FROM up_target) AS rows_in, (SELECT count(*) FROM up_target) AS rows, (SELECT count(*) FROM up_target) AS inserted,
       CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged
UNION ALL
SELECT 'again', (SELECT count(*) FROM up_batch), count(*), count(*) FILTER (WHERE t.event_id IS NULL), count(*) FILTER (WHERE t.event_id IS NOT NULL), 0
FROM up_batch_latest b LEFT JOIN up_target t ON t.event_id = b.event_id
UNION ALL
SELECT 'repeated', (SELECT count(*) FROM up_batch), count(*), 0, 0, count(*) FROM up_batch_latest""",
    "EXT-range": """
SELECT event_id,
       max(value) OVER (PARTITION BY event_type ORDER BY epoch_s RANGE BETWEEN 21600 PRECEDING AND 1 PRECEDING) AS max_6h,
       count(value) OVER (PARTITION BY event_type ORDER BY epoch_s RANGE BETWEEN 86400 PRECEDING AND 3600 PRECEDING) AS n_24h
FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s FROM events)""",
}


def _local(feed: str) -> str:
    """A feed with its times in the zone."""
    zoned = ", ".join(f"({c} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS {c}" for c in ("Interval_Start", "Interval_End", "Publish_Time"))
    return f"SELECT * REPLACE ({zoned}) FROM ({feed})"


_ORDER_HOUR = "CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_custkey % 24 AS INTEGER))"
_ZONED = {f"{t}_bronze": _local(F[f"{t}_bronze"]) for t in ("solar", "wind")}
_ORDERS = {
    "solar_bronze": f"""
SELECT Interval_Start, Interval_Start + INTERVAL 1 HOUR AS Interval_End, Interval_Start - INTERVAL 1 DAY AS Publish_Time,
       s AS GEN_SYSTEM_WIDE, mx * n AS HSL_SYSTEM_WIDE, CAST(50.0 AS DOUBLE) * n AS STPPF_SYSTEM_WIDE,
       CAST(55.0 AS DOUBLE) * n AS PVGRPP_SYSTEM_WIDE, mx * n AS COP_HSL_SYSTEM_WIDE
FROM (SELECT {_ORDER_HOUR} AS Interval_Start, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s, count(*) AS n,
             max(o_totalprice) AS mx FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)""",
    "dam_bronze": f"""
SELECT Interval_Start, Interval_Start + INTERVAL 1 HOUR AS Interval_End, Location, 'SP' AS Location_Type, 'DAM' AS Market,
       s / n - 30.0 AS LMP
FROM (SELECT {_ORDER_HOUR} AS Interval_Start, {_POINT_LIST}[CAST(o_custkey % {len(POINTS)} AS INTEGER) + 1] AS Location,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s, count(*) AS n FROM orders GROUP BY 1, 2)""",
}
#: Queries over other feeds: the query whose SQL they share, and the fragments that differ.
_OTHER = {
    "EXT-zone-accuracy": ("PIP-8", _ZONED),
    "EXT-zone-totals": ("PIP-3", _ZONED),
    "EXT-refresh-features": ("PIP-12", _ORDERS),
    "EXT-refresh-volatility": ("PIP-15", _ORDERS),
}


def oracle_sql() -> dict[str, str]:
    _FINAL["EXT-range-cells"] = _FINAL["EXT-range"]
    plain = {k: build(v, round_doubles=k not in _NO_ROUND) for k, v in _FINAL.items()}
    return plain | {k: build(_FINAL[like], True, other) for k, (like, other) in _OTHER.items()}
