"""Grouped measures: forecast accuracy, generation profiles, curtailment,
price statistics and price-versus-generation.

All are single ``groupBy().agg()`` passes (partial aggregation on the map side,
one shuffle on the group key).  Exact percentiles use one ``percentile(col,
array)`` aggregate per group (one buffer for all quantiles).  That buffer holds
a group's distinct values in one task, which is fine for the pipeline's groups
(a point-day has 24 hourly prices, a point-hour one price per day, so both are
bounded by the time span, not by the table size).  For groups without such a
bound, ``exact="distributed"`` computes the same values with
``quantiles.exact_quantiles`` (range-partitioned ranks; no group in one task),
and ``exact=False`` uses the bounded-memory ``percentile_approx`` sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.functions.measures import pct_of
from voltaic.operators.quantiles import with_exact_quantiles


# ---------------------------------------------------------------- accuracy

def accuracy_base(df: DataFrame, actual: str, forecast: str, floor: float) -> DataFrame:
    """Rows with both values present and the actual above ``floor``."""
    a = F.col(actual)
    return df.filter(a.isNotNull() & F.col(forecast).isNotNull() & (a > floor))


def _mape(actual: str, error: str) -> Column:
    a = F.col(actual)
    return F.avg(F.when(a > 0, F.abs(F.col(error)) / a * F.lit(100.0)))


def accuracy_daily(df: DataFrame, *, actual: str, forecast: str, error: str,
                   floor: float, tag: str, time_col: str = "interval_start") -> DataFrame:
    """MAE, MAPE, RMSE, bias, totals, count, peak and max error per day."""
    e = F.col(error)
    return (accuracy_base(df, actual, forecast, floor)
            .groupBy(F.to_date(time_col).alias("date"))
            .agg(F.avg(F.abs(e)).alias("mae_mw"),
                 _mape(actual, error).alias("mape_pct"),
                 F.sqrt(F.avg(F.pow(e, 2))).alias("rmse_mw"),
                 F.avg(e).alias("bias_mw"),
                 F.sum(actual).alias("total_actual_mw"),
                 F.sum(forecast).alias("total_forecast_mw"),
                 F.count(F.lit(1)).alias("observation_count"),
                 F.max(actual).alias("peak_actual_mw"),
                 F.max(F.abs(e)).alias("max_error_mw"))
            .withColumns({"resource_type": F.lit(tag),
                          "year": F.year("date"), "month": F.month("date")}))


def accuracy_by_hour(df: DataFrame, *, actual: str, forecast: str, error: str,
                     floor: float, tag: str, hour_col: str = "hour_of_day") -> DataFrame:
    """MAE, MAPE, bias, sample stddev of the error and count per hour of day."""
    e = F.col(error)
    return (accuracy_base(df, actual, forecast, floor)
            .groupBy(hour_col)
            .agg(F.avg(F.abs(e)).alias("avg_mae_mw"),
                 _mape(actual, error).alias("avg_mape_pct"),
                 F.avg(e).alias("avg_bias_mw"),
                 F.stddev_samp(e).alias("error_stddev_mw"),
                 F.count(F.lit(1)).alias("observation_count"))
            .withColumn("resource_type", F.lit(tag)))


def skill_score(df: DataFrame, *, actual: str, forecast: str, floor: float,
                persistence: str, time_col: str = "interval_start") -> DataFrame:
    """Daily skill of the forecast against a persistence forecast (the value
    ``persistence`` holds, e.g. the actual 24 rows earlier): ``1 − MSE/MSE_p``."""
    a = F.col(actual)
    base = accuracy_base(df, actual, forecast, floor).filter(F.col(persistence).isNotNull())
    return (base.groupBy(F.to_date(time_col).alias("date"))
            .agg(F.avg(F.pow(F.col(forecast) - a, 2)).alias("mse_forecast"),
                 F.avg(F.pow(F.col(persistence) - a, 2)).alias("mse_persistence"),
                 F.count(F.lit(1)).alias("observation_count"))
            .withColumn("skill_score",
                        F.lit(1.0) - F.try_divide("mse_forecast", "mse_persistence")))


def instant(*frames: DataFrame) -> list[str]:
    """The column that tells intervals apart where local times repeat (clocks going back), if all frames have it."""
    return ["interval_start_utc"] if all("interval_start_utc" in f.columns for f in frames) else []


# ------------------------------------------------------ generation profiles

def hourly_totals(combined: DataFrame, *, parts=("solar", "wind"),
                  tag_col: str = "resource_type") -> DataFrame:
    """Totals per interval over all resources, with one conditional sum per
    resource and its share.  Grouped by the interval only; calendar columns
    are derived again from it."""
    tag = F.col(tag_col)
    aggs = [F.max("interval_end").alias("interval_end"),
            F.sum("actual_mw").alias("total_renewable_actual_mw"),
            F.sum("hsl_mw").alias("total_renewable_hsl_mw"),
            F.sum("estimated_curtailment_mw").alias("total_curtailment_mw")]
    aggs += [F.sum(F.when(tag == p, F.col("actual_mw"))).alias(f"{p}_actual_mw") for p in parts]
    ts = F.col("interval_start")
    out = combined.groupBy("interval_start", *instant(combined)).agg(*aggs)
    derived = {"hour_of_day": F.hour(ts), "day_of_week": F.date_format(ts, "EEEE"),
               "is_weekend": F.dayofweek(ts).isin(1, 7),
               "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    derived.update({f"{p}_pct": pct_of(f"{p}_actual_mw", "total_renewable_actual_mw")
                    for p in parts})
    return out.withColumns(derived)


def hour_profile(totals: DataFrame, *, total: str = "total_renewable_actual_mw",
                 parts=("solar", "wind"), quantiles=(0.10, 0.50, 0.90)) -> DataFrame:
    """Typical-day profile: averages, approximate quantiles, extremes,
    stddev and count per hour of day."""
    t = F.col(total)
    q = F.percentile_approx(t, list(quantiles))
    aggs = [F.avg(t).alias("avg_total_mw")]
    aggs += [F.avg(f"{p}_actual_mw").alias(f"avg_{p}_mw") for p in parts]
    aggs += [q.alias("_q"), F.max(t).alias("max_total_mw"), F.min(t).alias("min_total_mw"),
             F.stddev_samp(t).alias("stddev_total_mw"),
             F.count(F.lit(1)).alias("observation_count")]
    out = totals.groupBy("hour_of_day").agg(*aggs)
    qcols = {f"p{round(x * 100):02d}_total_mw": F.col("_q")[i] for i, x in enumerate(quantiles)}
    return out.withColumns(qcols).drop("_q")


def monthly_summary(totals: DataFrame, *, parts=("solar", "wind")) -> DataFrame:
    t = F.col("total_renewable_actual_mw")
    aggs = [F.sum(t).alias("total_generation_mwh")]
    aggs += [F.sum(f"{p}_actual_mw").alias(f"{p}_generation_mwh") for p in parts]
    aggs += [F.sum("total_curtailment_mw").alias("total_curtailment_mwh"),
             F.max(t).alias("peak_hour_mw"), F.avg(t).alias("avg_hour_mw"),
             F.count(F.lit(1)).alias("hours_in_month")]
    ratios = {"capacity_factor_estimate": pct_of("avg_hour_mw", "peak_hour_mw")}
    ratios.update({f"{p}_share_pct": pct_of(f"{p}_generation_mwh", "total_generation_mwh")
                   for p in parts})
    return totals.groupBy("year", "month").agg(*aggs).withColumns(ratios)


def dow_profile(totals: DataFrame, *, parts=("solar", "wind")) -> DataFrame:
    aggs = [F.avg("total_renewable_actual_mw").alias("avg_total_mw")]
    aggs += [F.avg(f"{p}_actual_mw").alias(f"avg_{p}_mw") for p in parts]
    return totals.groupBy("day_of_week", "hour_of_day").agg(*aggs)


# ------------------------------------------------------------- curtailment

def curtailment_by_hour(df: DataFrame, *, tag: str,
                        value: str = "estimated_curtailment_mw") -> DataFrame:
    v = F.col(value)
    return (df.filter(v > 0).groupBy("hour_of_day")
            .agg(F.avg(v).alias("avg_curtailment_mw"),
                 F.sum(v).alias("total_curtailment_mwh"),
                 F.count(F.lit(1)).alias("curtailment_hours"),
                 F.max(v).alias("max_curtailment_mw"))
            .withColumn("resource_type", F.lit(tag)))


def _daily_side(df: DataFrame, tag: str) -> DataFrame:
    return (df.groupBy(F.to_date("interval_start").alias("date"))
            .agg(F.sum("estimated_curtailment_mw").alias(f"{tag}_curtailment_mwh"),
                 F.sum("actual_mw").alias(f"{tag}_generation_mwh")))


def daily_curtailment(a: DataFrame, b: DataFrame, tags=("solar", "wind")) -> DataFrame:
    """Each side is summed per day first, then the two daily tables are
    joined on the date (days present on both sides).  Both aggregates are
    hash-partitioned on the date, so the join reuses that partitioning."""
    ta, tb = tags
    joined = _daily_side(a, ta).join(_daily_side(b, tb), "date", "inner")
    tc = F.col(f"{ta}_curtailment_mwh") + F.col(f"{tb}_curtailment_mwh")
    tg = F.col(f"{ta}_generation_mwh") + F.col(f"{tb}_generation_mwh")
    return (joined.withColumns({"total_curtailment_mwh": tc, "total_generation_mwh": tg})
            .withColumns({"curtailment_rate_pct":
                          pct_of("total_curtailment_mwh",
                                 F.col("total_generation_mwh") + F.col("total_curtailment_mwh")),
                          "year": F.year("date"), "month": F.month("date")}))


# ------------------------------------------------------------------ prices

def _qname(q: float) -> str:
    return "median" if q == 0.5 else f"p{round(q * 100):02d}"


def price_stats(df: DataFrame, by: list, *, price: str = "lmp_price",
                quantiles=(0.5,), suffix: str = "price", stddev: bool = True,
                range_name: str | None = None, count_name: str = "hours_count",
                peak_flag: str | None = None, exact: bool = True,
                name_style: str = "suffix") -> DataFrame:
    """avg/min/max, quantiles, stddev, max−min and count of ``price`` per group.

    ``exact``: True = ``percentile``, ``"distributed"`` = the same values
    without holding a group in one task, False = ``percentile_approx``.
    ``name_style='suffix'`` names columns ``avg_price``/``p25_price``,
    ``'lmp'`` names them ``avg_lmp``/``median_lmp``.  With ``peak_flag`` the
    peak and off-peak averages and their spread are added.
    """
    p = F.col(price)
    distributed = exact == "distributed"
    aggs = [F.avg(p).alias(f"avg_{suffix}"), F.min(p).alias(f"min_{suffix}"),
            F.max(p).alias(f"max_{suffix}")]
    if not distributed:
        aggs.append((F.percentile(p, list(quantiles)) if exact
                     else F.percentile_approx(p, list(quantiles))).alias("_q"))
    if stddev:
        aggs.append(F.stddev_samp(p).alias(f"stddev_{suffix}"))
    if range_name:
        aggs.append((F.max(p) - F.min(p)).alias(range_name))
    aggs.append(F.count(F.lit(1)).alias(count_name))
    if peak_flag:
        flag = F.col(peak_flag)
        aggs += [F.avg(F.when(flag, p)).alias(f"avg_peak_{suffix}"),
                 F.avg(F.when(~flag, p)).alias(f"avg_offpeak_{suffix}")]
    out = df.groupBy(*by).agg(*aggs)
    qnames = [f"{_qname(q)}_{suffix}" for q in quantiles]
    if distributed:
        out = with_exact_quantiles(out, df, list(by), price, quantiles, qnames)
    else:
        out = out.withColumns({n: F.col("_q")[i] for i, n in enumerate(qnames)}).drop("_q")
    if peak_flag:
        out = out.withColumn("peak_offpeak_spread",
                             F.col(f"avg_peak_{suffix}") - F.col(f"avg_offpeak_{suffix}"))
    return out


def point_daily_summary(lmp: DataFrame, point_class: str, range_name: str) -> DataFrame:
    """Daily avg/min/max/median/range/count per point of one class."""
    return (price_stats(lmp.filter(F.col("point_type") == point_class),
                        ["delivery_date", "settlement_point"], quantiles=(0.5,),
                        suffix="lmp", stddev=False, range_name=range_name)
            .withColumns({"year": F.year("delivery_date"),
                          "month": F.month("delivery_date")}))


def daily_price_statistics(lmp: DataFrame, exact: bool = True) -> DataFrame:
    return (price_stats(lmp.withColumnRenamed("delivery_date", "date"),
                        ["date", "settlement_point", "point_type"],
                        quantiles=(0.25, 0.5, 0.75), range_name="daily_range",
                        peak_flag="is_peak_hour", exact=exact)
            .withColumns({"year": F.year("date"), "month": F.month("date")}))


def hub_hourly_patterns(lmp: DataFrame, exact: bool = True) -> DataFrame:
    return price_stats(lmp.filter(F.col("point_type") == "Hub"),
                       ["settlement_point", "hour_of_day"], quantiles=(0.1, 0.5, 0.9),
                       count_name="observation_count", exact=exact)


def houston_join(lmp: DataFrame, totals: DataFrame, *, point_like: str = "HOUSTON") -> DataFrame:
    """Prices of the points whose name contains ``point_like`` next to the
    renewable totals of the same interval (inner join on the interval; the
    totals have one row per interval, so the join does not multiply rows)."""
    hub = (lmp.filter(F.col("settlement_point").contains(point_like))
           .select("interval_start", *instant(lmp, totals), "delivery_date", "hour_of_day", "settlement_point",
                   F.col("lmp_price").alias("houston_lmp")))
    at = instant(lmp, totals) or ["interval_start"]
    gen = totals.select(*at, "total_renewable_actual_mw", "solar_actual_mw",
                        "wind_actual_mw", "total_curtailment_mw")
    return hub.join(gen, at, "inner")


def price_vs_generation(lmp: DataFrame, totals: DataFrame, *, point_like: str = "HOUSTON",
                        with_corr: bool = False) -> DataFrame:
    """Daily price at the ``point_like`` points against renewable generation:
    averages, negative-price hours and count per delivery day (optionally the
    Pearson correlation of price and total generation)."""
    lmp_c = F.col("houston_lmp")
    aggs = [F.avg(lmp_c).alias("avg_lmp"),
            F.avg("total_renewable_actual_mw").alias("avg_renewable_mw"),
            F.avg("solar_actual_mw").alias("avg_solar_mw"),
            F.avg("wind_actual_mw").alias("avg_wind_mw"),
            F.avg("total_curtailment_mw").alias("avg_curtailment_mw"),
            F.sum(F.when(lmp_c < 0, 1).otherwise(0)).alias("negative_price_hours"),
            F.count(F.lit(1)).alias("hours_count")]
    if with_corr:
        # NULL, not NaN, where either side doesn't vary
        aggs.append(F.nullif(F.corr(lmp_c, "total_renewable_actual_mw"), F.lit(float("nan"))).alias("lmp_renewable_corr"))
    return (houston_join(lmp, totals, point_like=point_like).groupBy("delivery_date").agg(*aggs)
            .withColumns({"year": F.year("delivery_date"), "month": F.month("delivery_date")}))
