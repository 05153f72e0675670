"""Materialised layers equal the registered queries."""

import os

import pytest
from pyspark.sql import functions as F

from voltaic.plans import layers
from voltaic.plans.catalog import Frames
from voltaic.sources.registry import DAM, SOLAR, SOLAR_REGIONAL, WIND
from voltaic.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_build_silver_and_gold(spark, scratch):
    f = Frames(spark, SF)
    bronze = {SOLAR.name: f.solar_bronze, WIND.name: f.wind_bronze,
              DAM.name: f.dam_bronze, SOLAR_REGIONAL.name: f.regional_bronze}
    # URIs, as on a cluster (shared storage), not bare local folder names
    s_root, g_root = "file://" + scratch("silver"), "file://" + scratch("gold")
    silver = layers.build_silver(spark, bronze, s_root)
    assert set(silver) == set(layers.SILVER_TABLES) - {"wind_hourly_regional"}
    gold = layers.build_gold(spark, s_root, g_root)
    assert set(gold) == set(layers.GOLD_TABLES)

    def rows(df, cols):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())

    acc = read_table(spark, gold["solar_forecast_accuracy_daily"])
    cols = ["date", "mae_mw", "rmse_mw", "observation_count"]
    assert rows(acc, cols) == rows(f.solar_acc[0], cols)
    feats = read_table(spark, gold["solar_forecast_features"])
    assert feats.count() == f.features.count()
    vol = read_table(spark, gold["lmp_volatility_metrics"])
    cols = ["date", "settlement_point", "rolling_30d_avg"]
    assert rows(vol, cols) == rows(f.volatility, cols)
    parts = read_table(spark, silver["renewable_generation_combined"]).select(
        "resource_type").distinct().collect()
    assert {r.resource_type for r in parts} == {"solar", "wind"}
    assert read_table(spark, silver["lmp_day_ahead_market"]).filter(
        F.col("_transformed_at").isNull()).count() == 0
