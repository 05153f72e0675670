"""Silver and gold brought up to date from what changed in bronze.

``layers.build_silver`` and ``build_gold`` make every table from all of history.  Here each table is made
again only where a change can reach it:

* row by row and daily tables: the partitions that changed;
* trailing ROWS windows (168 hours back, 29 days back): those, and the partitions after them that fewer than so many
  rows lie between, read together with the partitions before that the windows look back into (``reach``, from row counts
  a partition that are kept beside the tables);
* profiles over all of history: states a partition (``operators.states``), merged.

Bronze tables note what commits change (``sources.redo``); ``refresh`` takes these notes, and clears them when all tables are
written.  Run again after a failure it does the same work again, with the same result.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltaic.operators import metrics, reshape, states
from voltaic.plans import gold, silver
from voltaic.plans.layers import GOLD_TABLES, SILVER_TABLES, YM
from voltaic.sources import files, redo
from voltaic.sources.registry import DAM, SOLAR, SOLAR_REGIONAL, WIND, WIND_REGIONAL
from voltaic.sources.tables import _read_partitions, read_table, replace_scope, table_exists, write_partitioned

#: How many rows back the windows of the feature and volatility tables look.
FEATURE_REACH = max([*gold.FEATURE_LAGS.values(), *[-lo for _, lo, _ in gold.FEATURE_FRAMES.values()]])
VOLATILITY_REACH = max(-lo for _, lo, _ in gold.VOLATILITY_FRAMES.values())

Partitions = set[tuple] | None  # None: all


def reach(counts: DataFrame, entity: list[str], changed: set[tuple], rows: int, parts=YM) -> tuple[set[tuple], set[tuple]]:
    """(partitions whose window results a change reaches, partitions to read for these).

    ``counts`` has ``parts``, ``entity`` and n, the rows of each entity in a partition; 0 where it had rows before the change and has
    none now.  A window that looks ``rows`` rows back from a later partition gets to the changed one if fewer lie between."""
    parts, hit = list(parts), _in(changed, parts)
    order = Window.partitionBy(*entity).orderBy(*parts)
    so_far = counts.withColumn("cum", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("hit", hit)
    last = F.max(F.when(F.col("hit"), F.col("cum"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    reached = so_far.withColumn("last", last).where((F.col("n") > 0) & (F.col("cum") - F.col("n") - F.col("last") < rows))
    out = set(changed) | {tuple(r) for r in reached.select(*parts).distinct().collect()}  # a row a partition
    next_ = F.min(F.when(_in(out, parts) & (F.col("n") > 0), F.col("cum") - F.col("n"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    read = so_far.withColumn("next", next_).where((F.col("n") > 0) & (F.col("next") - F.col("cum") < rows))
    return out, out | {tuple(r) for r in read.select(*parts).distinct().collect()}


class Refresh:
    """One run over the layers below two roots; ``written`` names the partitions written of each table."""

    def __init__(self, spark: SparkSession, silver_root: str, gold_root: str):
        self.spark, self.roots = spark, {"silver": silver_root, "gold": gold_root}
        self.written: dict[str, list[tuple]] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.roots["silver" if name in SILVER_TABLES else "gold"], name)

    def state_path(self, name: str) -> str:
        return os.path.join(self.roots["gold"], "states", name)

    def there(self, path: str) -> bool:
        return table_exists(self.spark, path)

    def read(self, path: str, where: Partitions, parts=YM) -> DataFrame:
        if where is None:
            return read_table(self.spark, path)
        found = _read_partitions(self.spark, path, parts, where, like=None)
        return found if found is not None else read_table(self.spark, path).limit(0)

    def put(self, name: str, df: DataFrame | None, scope: Partitions, path: str | None = None, parts=None) -> None:
        """The partitions ``scope`` of a table hold the rows of ``df`` from now on."""
        if df is None:
            return
        state, path = path is not None, path or self.path(name)
        parts = parts or (SILVER_TABLES | GOLD_TABLES).get(name, YM)
        if scope is None or not self.there(path) or not parts:
            write_partitioned(df, path, parts, "overwrite")
            done = sorted(files.partition_dirs(self.spark, path, parts), key=str)
        else:
            done = replace_scope(self.spark, path, df, parts, scope)
            redo.clear(self.spark, path, redo.pending(self.spark, path)[1])  # nobody follows these tables
        if not state:
            self.written[name] = done

    # -------------------------------------------------------------- silver

    def silver(self, bronze: dict[str, str], changed: dict[str, Partitions]) -> dict[str, Partitions]:
        """Silver tables; returns what changed in those that gold reads."""
        out: dict[str, Partitions] = {}
        steps = ((SOLAR.name, "solar_hourly", silver.transform_solar_hourly), (WIND.name, "wind_hourly", silver.transform_wind_hourly),
                 (SOLAR_REGIONAL.name, "solar_hourly_regional", lambda b: silver.transform_regional(b, SOLAR_REGIONAL)),
                 (WIND_REGIONAL.name, "wind_hourly_regional", lambda b: silver.transform_regional(b, WIND_REGIONAL)),
                 (DAM.name, "lmp_day_ahead_market", silver.transform_lmp_dam))
        for source, name, transform in steps:
            if source not in bronze:
                continue
            scope = self._scope(changed.get(source, set()), name)
            out[name] = scope
            if scope != set():
                self.put(name, transform(self.read(bronze[source], scope)), scope)
        if "solar_hourly" in out and "wind_hourly" in out:
            scope = self._scope(_both(out["solar_hourly"], out["wind_hourly"]), "renewable_generation_totals")
            out["renewable_generation_totals"] = scope
            if scope != set():
                by_tag = {t: self.read(self.path(f"{t}_hourly"), scope) for t in ("solar", "wind")}
                self._combined(by_tag, scope)
                self.put("renewable_generation_totals", silver.renewable_totals(by_tag), scope)
        if out.get("lmp_day_ahead_market", set()) != set():
            scope = out["lmp_day_ahead_market"]
            lmp = self.read(self.path("lmp_day_ahead_market"), scope)
            self.put("lmp_hub_daily_summary", silver.lmp_hub_daily_summary(lmp), scope)
            self.put("lmp_load_zone_daily_summary", silver.lmp_load_zone_daily_summary(lmp), scope)
        return out

    def _scope(self, changed: Partitions, name: str) -> Partitions:
        return changed if self.there(self.path(name)) else None

    def _combined(self, by_tag: dict[str, DataFrame], scope: Partitions) -> None:
        """The combined table has a partition a resource too: each resource's are replaced below its own name."""
        name = "renewable_generation_combined"
        path, df = self.path(name), silver.combined_resources(by_tag)
        if scope is None or not self.there(path):
            write_partitioned(df, path, SILVER_TABLES[name], "overwrite")
        else:
            write_partitioned(df, path, SILVER_TABLES[name], "replace_partitions")
            for tag, rows in by_tag.items():
                kept = {tuple(r) for r in rows.select(*YM).distinct().collect()}  # bounded by the scope
                for v in scope - kept:
                    files.delete(self.spark, f"{path}/{files.partition_dir(YM, v)}/resource_type={tag}")
        self.written[name] = sorted(scope, key=str) if scope is not None else sorted(files.partition_dirs(self.spark, path, YM), key=str)

    # ---------------------------------------------------------------- gold

    def _due(self, changed: dict[str, Partitions], inputs: tuple, tables: tuple) -> Partitions:
        """What changed in the inputs of some tables; all, if one of the tables isn't there yet; none without the inputs."""
        if not all(i in changed for i in inputs):
            return set()
        if not all(self.there(self.path(t)) for t in tables):
            return None
        return functools.reduce(_both, [changed[i] for i in inputs])

    def gold(self, changed: dict[str, Partitions]) -> None:
        for tag, floor in (("solar", gold.SOLAR_FLOOR), ("wind", gold.WIND_FLOOR)):
            due = self._due(changed, (f"{tag}_hourly",), (f"{tag}_forecast_accuracy_daily", f"{tag}_forecast_accuracy_by_hour"))
            if due != set():
                self._accuracy(tag, floor, due)
        if (due := self._due(changed, ("solar_hourly",), ("solar_forecast_features",))) != set():
            self._features(due)
        if (due := self._due(changed, ("renewable_generation_totals",), (
                "generation_hourly_patterns", "generation_monthly_summary", "generation_dow_patterns"))) != set():
            self._patterns(due)
        if (due := self._due(changed, ("solar_hourly", "wind_hourly"), ("curtailment_hourly_patterns", "curtailment_daily_summary"))) != set():
            self._curtailment(due)
        if (due := self._due(changed, ("lmp_day_ahead_market",), (
                "lmp_daily_statistics", "lmp_hourly_patterns", "lmp_hub_hourly_comparison", "lmp_volatility_metrics"))) != set():
            self._prices(due)
        if (due := self._due(changed, ("lmp_day_ahead_market", "renewable_generation_totals"), ("lmp_renewable_correlation",))) != set():
            lmp, totals = (self.read(self.path(n), due) for n in ("lmp_day_ahead_market", "renewable_generation_totals"))
            self.put("lmp_renewable_correlation", gold.lmp_renewable_correlation(lmp, totals), due)

    def _state(self, name: str, scope: Partitions, make, source: str) -> DataFrame:
        """The states ``name`` with the partitions ``scope`` made again from the table ``source``; all of them are returned."""
        path = self.state_path(name)
        scope = scope if self.there(path) else None
        self.put(name, make(self.read(self.path(source), scope)), scope, path, YM)
        return read_table(self.spark, path)

    def _accuracy(self, tag: str, floor: float, scope: Partitions) -> None:
        forecast, source = silver.RESOURCE_FORECAST[tag], f"{tag}_hourly"
        kw = dict(actual="actual_mw", forecast=f"{forecast}_forecast_mw", error=f"{forecast}_error_mw", floor=floor, tag=tag)
        name = f"{tag}_forecast_accuracy_daily"
        own = self._scope(scope, name)
        self.put(name, metrics.accuracy_daily(self.read(self.path(source), own), **kw), own)
        e, a = F.col(kw["error"]), F.col("actual_mw")
        values = {"abs": F.abs(e), "pct": F.when(a > 0, F.abs(e) / a * F.lit(100.0)), "err": e}
        name = f"{tag}_forecast_accuracy_by_hour"
        kept = self._state(name, scope, lambda s: states.state(
            metrics.accuracy_base(s, kw["actual"], kw["forecast"], floor), list(YM), ["hour_of_day"], values), source)
        m = states.merged(kept, ["hour_of_day"], list(values))
        self.put(name, m.select("hour_of_day", states.mean("abs").alias("avg_mae_mw"), states.mean("pct").alias("avg_mape_pct"),
                                states.mean("err").alias("avg_bias_mw"), states.stddev("err").alias("error_stddev_mw"),
                                F.col("rows").alias("observation_count"), F.lit(tag).alias("resource_type")), None)

    def _counts(self, name: str, scope: Partitions, make, source: str, entity: list[str]) -> DataFrame:
        """Rows a partition and entity, brought up to date; entities that ``scope`` has lost stand there with 0."""
        path, before = self.state_path(name), None
        if scope is not None and self.there(path):
            gone = self.read(path, scope)
            before = gone.withColumn("n", F.lit(0).cast("long"))
            # kept apart from the table that is written next
            staged = os.path.join(self.roots["gold"], "states", f"{name}_before")
            write_partitioned(before, staged, (), "overwrite")
            before = self.spark.read.schema(before.schema).parquet(staged)
        now = self._state(name, scope, make, source)
        if before is None:
            return now
        return now.unionByName(before).groupBy(*YM, *entity).agg(F.sum("n").alias("n"))

    def _features(self, scope: Partitions) -> None:
        name, source = "solar_forecast_features", "solar_hourly"
        scope = scope if self.there(self.state_path(f"{name}_rows")) else None  # what was there before isn't known
        counts = self._counts(f"{name}_rows", scope, lambda s: s.where("actual_mw IS NOT NULL").groupBy(*YM).agg(
            F.count(F.lit(1)).alias("n")).withColumn("series", F.lit(0)), source, ["series"])
        scope = self._scope(scope, name)
        if scope is None:
            self.put(name, gold.solar_features(read_table(self.spark, self.path(source))), None)
            return
        out, read = reach(counts, ["series"], scope, FEATURE_REACH)
        made = gold.solar_features(self.read(self.path(source), read))
        self.put(name, made.where(_in(out)), out)

    def _patterns(self, scope: Partitions) -> None:
        source, total = "renewable_generation_totals", F.col("total_renewable_actual_mw")
        values = {"total": total, "solar": F.col("solar_actual_mw"), "wind": F.col("wind_actual_mw")}
        name = "generation_hourly_patterns"
        kept = self._state(name, scope, lambda s: states.state(s, list(YM), ["hour_of_day"], values, quantiles={"total": "values"}), source)
        by = ["hour_of_day"]
        m = states.merged(kept, by, list(values)).select(
            *by, *[states.mean(n).alias(f"avg_{n}_mw") for n in values], F.col("total_max").alias("max_total_mw"),
            F.col("total_min").alias("min_total_mw"), states.stddev("total").alias("stddev_total_mw"), F.col("rows").alias("observation_count"))
        q = states.quantiles(kept, by, "total", (0.1, 0.5, 0.9), ["p10_total_mw", "p50_total_mw", "p90_total_mw"], "percentile_approx")
        self.put(name, states.with_quantiles(m, q, by), None)
        # a month is a partition: its row is its state
        self.put("generation_monthly_summary", self._state("generation_monthly_summary", scope, metrics.monthly_summary, source), None)
        name, by = "generation_dow_patterns", ["day_of_week", "hour_of_day"]
        kept = self._state(name, scope, lambda s: states.state(s, list(YM), by, values), source)
        self.put(name, states.merged(kept, by, list(values)).select(*by, *[states.mean(n).alias(f"avg_{n}_mw") for n in values]), None)

    def _curtailment(self, scope: Partitions) -> None:
        v, by, made = F.col("estimated_curtailment_mw"), ["hour_of_day"], []
        for tag in ("solar", "wind"):
            kept = self._state(f"curtailment_hourly_patterns_{tag}", scope, lambda s: states.state(
                s.where(v > 0), list(YM), by, {"c": v}), f"{tag}_hourly")
            made.append(states.merged(kept, by, ["c"]).select(
                *by, states.mean("c").alias("avg_curtailment_mw"), F.col("c_sum").alias("total_curtailment_mwh"),
                F.col("rows").alias("curtailment_hours"), F.col("c_max").alias("max_curtailment_mw"), F.lit(tag).alias("resource_type")))
        self.put("curtailment_hourly_patterns", reshape.combine(made), None)
        name = "curtailment_daily_summary"
        own = self._scope(scope, name)
        self.put(name, metrics.daily_curtailment(*(self.read(self.path(f"{t}_hourly"), own) for t in ("solar", "wind"))), own)

    def _prices(self, scope: Partitions) -> None:
        source, hub = "lmp_day_ahead_market", F.col("point_type") == "Hub"
        name = "lmp_daily_statistics"
        own = self._scope(scope, name)
        self.put(name, metrics.daily_price_statistics(self.read(self.path(source), own)), own)
        name, by, p = "lmp_hourly_patterns", ["settlement_point", "hour_of_day"], F.col("lmp_price")
        kept = self._state(name, scope, lambda s: states.state(s.where(hub), list(YM), by, {"price": p}, quantiles={"price": "values"}), source)
        m = states.merged(kept, by, ["price"]).select(
            *by, states.mean("price").alias("avg_price"), F.col("price_min").alias("min_price"), F.col("price_max").alias("max_price"),
            states.stddev("price").alias("stddev_price"), F.col("rows").alias("observation_count"))
        q = states.quantiles(kept, by, "price", (0.1, 0.5, 0.9), ["p10_price", "median_price", "p90_price"])
        self.put(name, states.with_quantiles(m, q, by), None)
        self._hubs(scope, source)
        self._volatility(scope)

    def _hubs(self, scope: Partitions, source: str) -> None:
        """A column for every hub in the data: a new one is NULL in partitions written before; when one is gone
        from the data, its column goes with a new build."""
        name = "lmp_hub_hourly_comparison"
        kept = self._state(f"{name}_hubs", scope, lambda s: s.where((F.col("point_type") == "Hub") & F.col("settlement_point").isNotNull())
                           .select(*YM, "settlement_point").distinct(), source)
        hubs = sorted(r[0] for r in kept.select("settlement_point").distinct().limit(reshape.MOST_PIVOT_VALUES + 1).collect())
        scope = self._scope(scope, name)
        if scope is not None:
            fixed = {"delivery_date", "hour_of_day", *YM, *[s for _, _, s in gold.SPREADS]}
            if set(read_table(self.spark, self.path(name)).columns) - fixed - set(hubs):
                scope = None
        self.put(name, gold.hub_hourly_comparison(self.read(self.path(source), scope), hubs), scope)
        own = self._scope(scope, "lmp_daily_spreads")
        spreads = reshape.daily_spreads(self.read(self.path(name), own))
        if spreads is None:
            files.delete(self.spark, self.path("lmp_daily_spreads"))
        self.put("lmp_daily_spreads", spreads, own)

    def _volatility(self, scope: Partitions) -> None:
        name, source, hub = "lmp_volatility_metrics", "lmp_daily_statistics", F.col("point_type") == "Hub"
        scope = scope if self.there(self.state_path(f"{name}_rows")) else None
        counts = self._counts(f"{name}_rows", scope, lambda s: s.where(hub).groupBy(*YM, "settlement_point").agg(
            F.count(F.lit(1)).alias("n")), source, ["settlement_point"])
        scope = self._scope(scope, name)
        if scope is None:
            self.put(name, gold.lmp_volatility(read_table(self.spark, self.path(source))), None)
            return
        out, read = reach(counts, ["settlement_point"], scope, VOLATILITY_REACH)
        self.put(name, gold.lmp_volatility(self.read(self.path(source), read)).where(_in(out)), out)


def _both(a: Partitions, b: Partitions) -> Partitions:
    return None if a is None or b is None else a | b


def _in(where: set[tuple], parts=YM) -> Column:
    """Whether a row is of one of the partitions (the NULL partition is one)."""
    each = [functools.reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(x)) for p, x in zip(parts, v)]) for v in sorted(where, key=str)]
    return functools.reduce(lambda a, b: a | b, each, F.lit(False))


def refresh(spark: SparkSession, bronze: dict[str, str], silver_root: str, gold_root: str,
            changed: dict[str, Partitions] | None = None) -> dict[str, list[tuple]]:
    """Bring the silver and gold tables up to date with the bronze tables (by source name); returns the partitions written
    of each table (of unpartitioned ones none).

    What changed is taken from the notes of the bronze tables' commits, and these are cleared at the end; ``changed`` (partitions by source,
    None: all) is used instead where it is given.  Tables that don't exist yet are built whole.
    """
    notes = {}
    for s, path in bronze.items():
        redo.recover(spark, path)
        notes[s] = redo.pending(spark, path)
    run = Refresh(spark, silver_root, gold_root)
    run.gold(run.silver(bronze, changed if changed is not None else {s: c for s, (c, _) in notes.items()}))
    if changed is None:
        for s, (_, names) in notes.items():
            redo.clear(spark, bronze[s], names)
    return run.written
