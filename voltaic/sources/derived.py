"""Landing feeds derived from the driver's tables.

There is no grid operator API here, so the feeds the pipeline consumes are
derived, with Spark, from the given tables.  Every feed is a whole-table
aggregate, so its cost grows with the tables:

* ``resource_feed`` – one row per hour of the ``events`` time span
  (a scaffold, so empty hours exist with NULL measures); the measures of an hour
  come from the ``click`` (solar) or ``view`` (wind) events in it.
* ``dam_feed`` – hourly prices per settlement point from all events; the point
  of an event is picked by ``user_id`` over ten point names, but for one hour of the day
  that has a single hub.
* ``regional_feed`` – orders per order date and customer region, wide
  (``GEN_<REGION>``, ``STPPF_<REGION>``; for wind four metrics and the publish time), with the raw region name in the column
  (so ``MIDDLE EAST`` needs sanitising).

Sums of ``value``/``o_totalprice`` (two decimals) are taken as decimals so the
result does not depend on the order rows are added in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Event type feeding each resource, price point names (picked by
# user_id modulo their count), and the constants of the derived measures.
RESOURCE_EVENT = {"solar": "click", "wind": "view"}
POINT_NAMES = ("HB_HOUSTON", "HB_NORTH", "HB_SOUTH", "HB_WEST",
               "LZ_HOUSTON", "LZ_NORTH", "ZONE_A", "RN_1", "HB_PAN", "HB_BUSAVG")
# from this hour of the day on, for an hour, one hub alone is priced
LONE_HOUR, LONE_HUB = 3, "HB_PAN"
FORECAST_PER_EVENT = 50.0
POTENTIAL_PER_EVENT = 55.0
PRICE_OFFSET = 30.0
REGIONAL_FORECAST_PER_ORDER = 250000.0
REGIONAL_POTENTIAL_PER_ORDER = 275000.0
DAM_MARKET = "DAM"
DAM_LOCATION_TYPE = "SP"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's (read-only) table ``name``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hour_start(ts: str = "ts"):
    """The wall-clock hour of a ``timestamp_ntz`` built from its fields, so the
    session time zone (and its clock changes) plays no part."""
    c = f"`{ts}`"
    return F.expr(f"make_timestamp_ntz(year({c}), month({c}), day({c}), hour({c}), 0, 0)")


def _exact_sum(c: str, when: str | None = None) -> str:
    """SQL for the exact (decimal) sum of a two-decimal column, as a double."""
    v = f"CAST(`{c}` AS DECIMAL(18,2))"
    v = f"CASE WHEN {when} THEN {v} END" if when else v
    return f"CAST(sum({v}) AS DOUBLE)"


# The helpers below write their expressions as SQL text: one expression is one
# call into the JVM, however many functions it nests.

def hourly_event_stats(events: DataFrame) -> DataFrame:
    """One row per hour that has any event: per resource the exact sum, the
    count (NULL when the resource has no event in the hour) and the max of
    ``value``.  One scan and one shuffle serve both resources and the span, for a
    caller that stores the result and builds the feeds from it."""
    aggs = []
    for res, etype in RESOURCE_EVENT.items():
        hit = f"event_type = '{etype}'"
        aggs += [F.expr(f"{_exact_sum('value', hit)} AS _sum_{res}"),
                 F.expr(f"nullif(count_if({hit}), 0) AS _n_{res}"),
                 F.expr(f"max(CASE WHEN {hit} THEN value END) AS _max_{res}")]
    return events.groupBy(hour_start("ts").alias("Interval_Start")).agg(*aggs)


def hour_scaffold(stats: DataFrame) -> DataFrame:
    """Every hour from the first to the last event hour (bounded by the time
    span, not by the row count).  Days are dealt out before their hours are made, so a
    span that one stray timestamp stretches is no single task's work."""
    bounds = stats.agg(F.expr("min(Interval_Start) AS lo"), F.expr("max(Interval_Start) AS hi"))
    days = bounds.selectExpr("lo", "hi", "explode(sequence(date_trunc('DAY', lo), hi, INTERVAL 1 DAY)) AS day")
    hours = days.repartition("day").selectExpr(
        "lo", "hi", "explode(sequence(day, day + INTERVAL 23 HOURS, INTERVAL 1 HOUR)) AS Interval_Start")
    return hours.where("Interval_Start BETWEEN lo AND hi").select("Interval_Start")


def resource_feed(stats: DataFrame, resource: str) -> DataFrame:
    """The landed hourly feed of one resource, columns in declared order, from
    ``hourly_event_stats``."""
    fc, pot = (("STPPF_SYSTEM_WIDE", "PVGRPP_SYSTEM_WIDE") if resource == "solar"
               else ("STWPF_SYSTEM_WIDE", "WGRPP_SYSTEM_WIDE"))
    n, mx = f"_n_{resource}", f"_max_{resource}"
    return (hour_scaffold(stats).join(stats, "Interval_Start", "left")
            .selectExpr(
                "Interval_Start",
                "Interval_Start + INTERVAL 1 HOUR AS Interval_End",
                "Interval_Start - INTERVAL 1 DAY AS Publish_Time",
                f"_sum_{resource} AS GEN_SYSTEM_WIDE",
                f"{mx} * {n} AS HSL_SYSTEM_WIDE",
                f"{FORECAST_PER_EVENT!r}D * {n} AS {fc}",
                f"{POTENTIAL_PER_EVENT!r}D * {n} AS {pot}",
                f"{mx} * {n} AS COP_HSL_SYSTEM_WIDE"))


def dam_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    names = ", ".join(f"'{n}'" for n in POINT_NAMES)
    point = F.expr(f"CASE WHEN hour(ts) = {LONE_HOUR} THEN '{LONE_HUB}' ELSE "
                   f"element_at(array({names}), CAST(pmod(user_id, {len(POINT_NAMES)}) + 1 AS INT)) END")
    return (ev.groupBy(hour_start("ts").alias("Interval_Start"), point.alias("Location"))
            .agg(F.expr(f"{_exact_sum('value')} AS _sum"), F.expr("count(1) AS _n"))
            .selectExpr(
                "Interval_Start",
                "Interval_Start + INTERVAL 1 HOUR AS Interval_End",
                "Location",
                f"'{DAM_LOCATION_TYPE}' AS Location_Type",
                f"'{DAM_MARKET}' AS Market",
                f"_sum / _n - {PRICE_OFFSET!r}D AS LMP"))


# Fixed value: orders of this status feed the first resource, all others the second.
FINISHED = "F"


def _order_hour(c: str = "o_orderdate") -> str:
    """Orders have a day; the hour comes from the customer."""
    return f"CAST({c} AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(pmod(o_custkey, 24) AS INT), 0, 0)"


def order_feed(spark: SparkSession, sf_dir: str, resource: str = "solar") -> DataFrame:
    """An hourly feed over the years of the orders, with gaps: as ``resource_feed``, from their prices."""
    fc, pot = ("STPPF_SYSTEM_WIDE", "PVGRPP_SYSTEM_WIDE") if resource == "solar" else ("STWPF_SYSTEM_WIDE", "WGRPP_SYSTEM_WIDE")
    own = table(spark, sf_dir, "orders").where(f"o_orderstatus {'=' if resource == 'solar' else '<>'} '{FINISHED}'")
    per_hour = own.groupBy(F.expr(_order_hour()).alias("Interval_Start")).agg(
        F.expr(f"{_exact_sum('o_totalprice')} AS s"), F.expr("count(1) AS n"), F.expr("max(o_totalprice) AS mx"))
    return per_hour.selectExpr(
        "Interval_Start", "Interval_Start + INTERVAL 1 HOUR AS Interval_End", "Interval_Start - INTERVAL 1 DAY AS Publish_Time",
        "s AS GEN_SYSTEM_WIDE", "mx * n AS HSL_SYSTEM_WIDE", f"{FORECAST_PER_EVENT!r}D * n AS {fc}",
        f"{POTENTIAL_PER_EVENT!r}D * n AS {pot}", "mx * n AS COP_HSL_SYSTEM_WIDE")


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices over the years of the orders, a point picked by customer."""
    names = ", ".join(f"'{n}'" for n in POINT_NAMES)
    point = F.expr(f"element_at(array({names}), CAST(pmod(o_custkey, {len(POINT_NAMES)}) + 1 AS INT))")
    return (table(spark, sf_dir, "orders").groupBy(F.expr(_order_hour()).alias("Interval_Start"), point.alias("Location"))
            .agg(F.expr(f"{_exact_sum('o_totalprice')} AS s"), F.expr("count(1) AS n"))
            .selectExpr("Interval_Start", "Interval_Start + INTERVAL 1 HOUR AS Interval_End", "Location",
                        f"'{DAM_LOCATION_TYPE}' AS Location_Type", f"'{DAM_MARKET}' AS Market", f"s / n - {PRICE_OFFSET!r}D AS LMP"))


def region_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """Pivot values: the names in the ``region`` dimension (a handful of rows)."""
    return sorted(r[0] for r in table(spark, sf_dir, "region").select("r_name").distinct().collect())


def regional_feed(spark: SparkSession, sf_dir: str, regions: list[str] | None = None,
                  resource: str = "solar") -> DataFrame:
    """Wide regional feed, one row per order date; raw region names in the column names
    (``GEN_MIDDLE EAST``).  Solar has two metrics; wind four, and its publish time."""
    regions = regions if regions is not None else region_names(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    geo = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
           .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("c_custkey", "r_name"))
    joined = orders.join(geo, F.col("o_custkey") == F.col("c_custkey"))
    aggs = []
    for r in regions:
        hit = F.col("r_name") == r
        n = F.nullif(F.count(F.when(hit, F.col("o_totalprice"))), F.lit(0))
        aggs.append(F.sum(F.when(hit, F.col("o_totalprice").cast("decimal(18,2)"))).cast("double").alias(f"GEN_{r}"))
        forecast = F.lit(REGIONAL_FORECAST_PER_ORDER) * n
        if resource == "solar":
            aggs.append(forecast.alias(f"STPPF_{r}"))
        else:
            aggs += [forecast.alias(f"STWPF_{r}"),
                     (F.max(F.when(hit, F.col("o_totalprice"))) * n).alias(f"HSL_{r}"),
                     (F.lit(REGIONAL_POTENTIAL_PER_ORDER) * n).alias(f"WGRPP_{r}")]
    wide = joined.groupBy(F.col("o_orderdate").alias("Interval_Start")).agg(*aggs)
    times = {"Interval_End": "Interval_Start + INTERVAL 1 DAY"}
    if resource != "solar":
        times["Publish_Time"] = "Interval_Start - INTERVAL 1 DAY"
    return wide.select(
        "Interval_Start", *[F.expr(e).alias(c) for c, e in times.items()],
        *[F.col(f"`{c}`") for c in wide.columns if c != "Interval_Start"])
