"""Batch what-if scoring: a scenario table (one row per scenario) is turned
into the model's feature vector with stored scaling parameters and fixed
rules, scored in bulk, and summarised into KPIs.  The interactive form of
the reference scores one scenario per request; here any number of scenarios
is one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .joins import attach_group_stats, attach_row
from .split import _param_row

# Drought cut-offs of the scenario form (first season 900,
# second season 500) and its risk labels.
DROUGHT_CUTOFFS = {"first": 900.0, "second": 500.0}
RISK_DROUGHT = "Severe Drought Anomaly"
RISK_OK = "Favorable Precipitation"
RISK_DROUGHT_NOTE = "-1.0 Std Deviation"
RISK_OK_NOTE = "Optimal Range"


# The simulator's input ranges, and the values it starts from (by season where they differ).
RANGES = {"rainfall": (200.0, 3000.0), "temperature": (20.0, 40.0), "gdp": (1.0, 120.0), "inflation": (0.0, 100.0),
          "sown": (200.0, 2000.0), "ratio": (0.60, 1.00), "lag1": (100.0, 3500.0)}
DEFAULTS = {"rainfall": {"first": 1450.0, "second": 750.0}, "temperature": {"first": 26.5, "second": 28.8}, "gdp": 85.0, "inflation": 5.5,
            "sown": {"first": 1350.0, "second": 850.0}, "ratio": 0.95}


def space_size(seasons, steps: dict) -> int:
    n = len(seasons)
    for k in steps.values():
        n *= k
    return n


def scenario_space(spark, seasons: dict, steps: dict, fixed: dict | None = None, ranges: dict = RANGES, defaults: dict = DEFAULTS,
                   start: int = 0, stop: int | None = None) -> DataFrame:
    """All combinations of the seasons and of ``steps`` ({input: number of evenly spaced values of its range}), every other input at its
    default: (scenario, season, inputs...).  ``seasons`` maps labels to "first" or "second".

    A scenario's number is its place in mixed radix - season first, then the inputs in the order of ``steps`` - so the table is
    ``spark.range`` and arithmetic: no product of tables is built, and any slice [start, stop) of a space of any size can run by itself.
    ``fixed`` ({input: value}) replaces defaults, for instance the last observed production as the previous one."""
    total, labels = space_size(seasons, steps), list(seasons)
    rows = spark.range(start, total if stop is None else min(stop, total)).withColumnRenamed("id", "scenario")
    rest = F.col("scenario")

    def digit(k):
        nonlocal rest
        d = rest % k
        rest = F.floor(rest / k)
        return d

    place = digit(len(labels))
    season = F.element_at(F.array(*[F.lit(x) for x in labels]), (place + 1).cast("int"))
    rows = rows.withColumn("season", season)
    cols = {}
    for name, k in steps.items():
        lo, hi = ranges[name]
        cols[name] = F.lit(lo) + F.lit(hi - lo) * digit(k) / F.lit(float(max(k - 1, 1)))
    for name, value in {**defaults, **(fixed or {})}.items():
        if name in cols:
            continue
        if isinstance(value, dict):
            cols[name] = F.element_at(F.array(*[F.lit(float(value[seasons[x]])) for x in labels]), (place + 1).cast("int"))
        else:
            cols[name] = F.lit(float(value))
    return rows.withColumns(cols)


def grid_from_ranges(ranges: DataFrame, dims: dict, steps: int, by=("season",)) -> DataFrame:
    """Cross product of ``steps`` evenly spaced values per dimension, per
    group.  ``ranges`` holds ``{dim}_lo`` / ``{dim}_hi`` per group; ``dims``
    maps output name -> range prefix.  Size = groups x steps^len(dims); it
    is generated from the (small) ranges table with ``sequence`` +
    ``explode``, one dimension at a time."""
    out = ranges
    for name, pref in dims.items():
        lo, hi = F.col(f"{pref}_lo"), F.col(f"{pref}_hi")
        k = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias(f"__k_{name}")
        out = out.select("*", k).withColumn(
            name, lo + (hi - lo) * F.col(f"__k_{name}") / F.lit(float(max(steps - 1, 1)))).drop(f"__k_{name}")
    keep = list(by) + list(dims)
    return out.select(*keep)


def scenario_features(scen: DataFrame, params: DataFrame, cols: dict, season: str, positive: str,
                      cutoffs: dict) -> DataFrame:
    """``cols`` maps the roles rainfall, temperature, gdp, inflation, sown,
    ratio, lag1 to scenario columns; ``params`` is the scaler table (column
    mean / std, keyed by the scaled column's source name ``cols[role]``
    unless the table uses other names - see ``param_names``).
    Rules: harvested = sown x ratio; lag2 := lag1; roll3 := the inputs;
    efficiency := ratio (not clipped); drought by fixed cut-offs per season."""
    c = cols
    names = c.get("param_names", {})
    scaled_roles = ["rainfall", "temperature", "gdp", "inflation", "sown", "harvested"]
    pnames = [names.get(r, r) for r in scaled_roles]
    j = attach_row(scen.withColumn("__harvested", F.col(c["sown"]) * F.col(c["ratio"])), _param_row(params, pnames))
    src = {r: (F.col("__harvested") if r == "harvested" else F.col(c[r])) for r in scaled_roles}
    feats = {f"{names.get(r, r)}_scaled": (src[r] - F.col(f"{names.get(r, r)}__mean")) / F.col(f"{names.get(r, r)}__std")
             for r in scaled_roles}
    j = j.withColumns(feats)
    cut = None
    for lab, v in cutoffs.items():
        cond = F.col(season) == F.lit(lab)
        cut = F.when(cond, F.lit(v)) if cut is None else cut.when(cond, F.lit(v))
    rn, tn = names.get("rainfall", "rainfall"), names.get("temperature", "temperature")
    gn, inn = names.get("gdp", "gdp"), names.get("inflation", "inflation")
    j = j.withColumns({
        "season_binary": S.encode_binary(season, positive),
        "yield_lag1": F.col(c["lag1"]).cast("double"),
        "yield_lag2": F.col(c["lag1"]).cast("double"),
        "rainfall_roll3": F.col(c["rainfall"]).cast("double"),
        "temp_roll3": F.col(c["temperature"]).cast("double"),
        "rain_x_temp": F.col(f"{rn}_scaled") * F.col(f"{tn}_scaled"),
        "inf_x_gdp": F.col(f"{inn}_scaled") * F.col(f"{gn}_scaled"),
        "drought_flag": F.coalesce(F.col(c["rainfall"]) < cut, F.lit(False)).cast("int"),
        "harvest_efficiency": F.col(c["ratio"]).cast("double"),
    })
    return j.drop(*[f"{p}__{s}" for p in pnames for s in ("mean", "std")])


def kpis(scored: DataFrame, history: DataFrame, season: str, pred: str, harvested: str, ratio: str,
         drought: str = "drought_flag") -> DataFrame:
    """tonnes, delta % vs the season's historical mean target, kg per acre,
    efficiency %, risk status text.  ``history`` = (season, mean_target)."""
    j = attach_group_stats(scored, history, [season])
    return j.withColumns({
        "pred_tonnes": S.tonnes(pred),
        "delta_pct": S.delta_pct(pred, "mean_target"),
        "kg_per_acre": S.kg_per_acre(pred, harvested),
        "efficiency_pct": F.col(ratio) * 100.0,
        "risk_status": F.when(F.col(drought) == 1, F.lit(RISK_DROUGHT)).otherwise(F.lit(RISK_OK)),
        "risk_note": F.when(F.col(drought) == 1, F.lit(RISK_DROUGHT_NOTE)).otherwise(F.lit(RISK_OK_NOTE)),
    })
