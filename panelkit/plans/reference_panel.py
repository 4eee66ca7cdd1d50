"""The reference's own processed national panel (149 rows, read as data)
run through our feature, split and model operators - used by the golden
tests and by the bench's accuracy section."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import ml as M
from ..operators import split as SP
from .flows import PanelSpec, features

# The reference panel's season order and column roles.
SEASON_CODES = {"Maha": 0, "Yala": 1}

SPEC = PanelSpec(
    keys=("year", "season"), series=(), order=("year", "season_code"),
    season="season", positive_season="Maha", season_codes=SEASON_CODES,
    rainfall="rainfall_mm", temperature="temperature_c", gdp="gdp_billion_usd", inflation="inflation_pct",
    sown="sown_000_acres", harvested="harvested_000_acres", target_src="production_000_mt",
    target="target_yield_production", split_order=("year", "season_code"), first_by=("season_code",), ratio=0.85,
)

# Feature names (fixed values of the reference's feature table).
FEATURES = [
    "season_binary", "rainfall_mm_scaled", "temperature_c_scaled", "gdp_billion_usd_scaled", "inflation_pct_scaled",
    "sown_000_acres_scaled", "harvested_000_acres_scaled", "yield_lag1", "yield_lag2", "rainfall_roll3", "temp_roll3",
    "rain_x_temp", "inf_x_gdp", "drought_flag", "harvest_efficiency",
]

_D = T.DoubleType()
SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()), T.StructField("season", T.StringType()),
    *[T.StructField(c, _D) for c in ("sown_000_acres", "harvested_000_acres", "gdp_billion_usd", "inflation_pct",
                                      "rainfall_mm", "temperature_c", "production_000_mt")],
    T.StructField("season_binary", T.IntegerType()),
    *[T.StructField(f"{c}_scaled", _D) for c in ("rainfall_mm", "temperature_c", "gdp_billion_usd", "inflation_pct",
                                                  "sown_000_acres", "harvested_000_acres")],
    T.StructField("target_yield_production", _D),
])


def read_model_ready(spark, path):
    df = spark.read.option("header", "true").schema(SCHEMA).csv(path)
    return df.withColumn("season_code", S.map_order_code("season", SEASON_CODES))


def feature_table(spark, path):
    f = features(read_model_ready(spark, path), SPEC)
    return SP.split_chrono(f, list(SPEC.split_order), SPEC.ratio)


def fit_reference_models(spark, path) -> dict:
    f = feature_table(spark, path).cache()
    train = f.where(F.col("split") == "train")
    out = {}
    for name, pipe in {
        "linear_regression": M.ols(FEATURES, SPEC.target),
        "random_forest": M.random_forest(FEATURES, SPEC.target, num_trees=200, max_depth=8, subset="onethird"),
    }.items():
        model = pipe.fit(train)
        wide = M.metrics_wide(M.scored(name, model.transform(f), M.PRED, SPEC.target)).first().asDict()
        out[name] = {k: (round(v, 4) if isinstance(v, float) else v) for k, v in wide.items()}
    f.unpersist()
    return out
