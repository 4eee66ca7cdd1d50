"""Composed flows: cleaning (dedup -> impute -> winsorize -> encode ->
chronological split -> train-only scaling -> target alias) and feature
engineering (lags, rolling means, interactions, anomaly flag, efficiency,
back-filled lags).  Each is one lazy plan; the only actions are the small
size checks and the ordinal checkpoint."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import features as FE
from ..operators import quality as QL
from ..operators import split as SP


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a seasonal panel."""

    keys: tuple            # unique row key
    series: tuple          # series key ('' for one national series)
    order: tuple           # time order inside a series
    season: str
    positive_season: str   # label encoded as 1
    season_codes: dict
    rainfall: str
    temperature: str
    gdp: str
    inflation: str
    sown: str
    harvested: str
    target_src: str
    target: str = "target"
    split_order: tuple = ()
    first_by: tuple = ()   # what says which of several rows with one key came first
    ratio: float = 0.85
    impute: dict = field(default_factory=dict)

    @property
    def continuous(self) -> list[str]:
        return [self.rainfall, self.temperature, self.gdp, self.inflation, self.sown, self.harvested]

    @property
    def scaled(self) -> list[str]:
        return [f"{c}_scaled" for c in self.continuous]


# The driver-table panel: series = customer nation, monthly rows, halves as seasons.
PANEL = PanelSpec(
    keys=("series", "year", "month"), series=("series",), order=("year", "month"),
    season="season", positive_season="H1", season_codes={"H1": 0, "H2": 1},
    rainfall="rainfall", temperature="temperature", gdp="gdp", inflation="inflation",
    sown="sown", harvested="harvested", target_src="production",
    split_order=("year", "month", "series"), first_by=("month",),  # its keys don't repeat
    impute={"rainfall": "median", "inflation": "median", "temperature": "mean", "gdp": "median",
            "sown": "mean", "harvested": "mean", "production": "mean"},
)

# The same with an ingest ordinal, for input whose keys repeat.
DIRTY = replace(PANEL, first_by=("seq",))

# Feature names (fixed values of the reference's feature table).
FEATURES = [
    "season_binary", "rainfall_scaled", "temperature_scaled", "gdp_scaled", "inflation_scaled",
    "sown_scaled", "harvested_scaled", "yield_lag1", "yield_lag2", "rainfall_roll3", "temp_roll3",
    "rain_x_temp", "inf_x_gdp", "drought_flag", "harvest_efficiency",
]


def clean(df: DataFrame, spec: PanelSpec = PANEL, method: str | None = None, fit_on: str = "all") -> DataFrame:
    """Each statistics step reads its input twice (fit, then apply), so the
    inputs of those steps are persisted rather than recomputed from the
    source joins.

    ``fit_on='all'`` (default, as the reference) fits the imputation values and
    winsor fences on every row; ``fit_on='train'`` fits them on the training
    rows only.  The chronological split depends only on the order columns, so
    in that mode it is taken first and the result is identical in layout."""
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    train = F.col("split") == "train"
    d = QL.dedup_keep_first(df, spec.keys, spec.first_by)
    if fit_on == "train":
        d = SP.split_chrono(d, list(spec.split_order), spec.ratio)
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    fw = train if fit_on == "train" else None
    d = QL.impute(d, spec.impute, method=method, fit_where=fw).persist(StorageLevel.MEMORY_AND_DISK)
    d = QL.winsorize(d, spec.continuous, method=method, fit_where=fw)
    d = d.withColumn("season_binary", S.encode_binary(spec.season, spec.positive_season))
    if fit_on == "all":
        d = SP.split_chrono(d, list(spec.split_order), spec.ratio)
    else:  # same column order as the default mode
        d = d.select(*[c for c in d.columns if c not in ("ordinal", "split")], "ordinal", "split")
    params = SP.scale_fit(d, spec.continuous, where=train)
    d = SP.scale_apply(d, params, spec.continuous)
    return d.withColumn(spec.target, F.col(spec.target_src))


def features(df: DataFrame, spec: PanelSpec = PANEL, fit_on: str = "all") -> DataFrame:
    """Expects the output of :func:`clean`.  ``fit_on='train'`` takes the
    anomaly statistics from the training rows only."""
    t = spec.target
    out = FE.lags_and_rolls(
        df, spec.series, spec.order,
        lags={"__lag1": (t, 1), "__lag2": (t, 2)},
        rolls={"rainfall_roll3": (spec.rainfall, 3), "temp_roll3": (spec.temperature, 3)},
        backfill={"yield_lag1": "__lag1", "yield_lag2": "__lag2"},
    ).drop("__lag1", "__lag2")
    out = FE.add_interactions(out, {
        "rain_x_temp": (f"{spec.rainfall}_scaled", f"{spec.temperature}_scaled"),
        "inf_x_gdp": (f"{spec.inflation}_scaled", f"{spec.gdp}_scaled"),
    })
    fw = (F.col("split") == "train") if fit_on == "train" else None
    out = FE.anomaly_flag(out, spec.rainfall, [*spec.series, spec.season], fit_where=fw)
    return FE.add_efficiency(out, spec.harvested, spec.sown)
