"""SQL twins of the composed flows (DuckDB dialect), generated from the same
:class:`PanelSpec` as the Spark side."""

from __future__ import annotations

from .bindings import PANEL_SQL, with_ctes
from .flows import PANEL, PanelSpec


def _all_cols_panel():
    return ["series", "year", "month", "season", "sown", "harvested", "rainfall", "temperature", "gdp",
            "inflation", "production"]


def clean_ctes(spec: PanelSpec = PANEL, src: str = "panel") -> dict:
    cols = _all_cols_panel()
    keys = list(spec.keys)
    rest = [*spec.first_by, *[c for c in cols if c not in keys]]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in rest)
    real = ", ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in spec.impute)
    med = [c for c, m in spec.impute.items() if m == "median"]
    mean = [c for c, m in spec.impute.items() if m == "mean"]
    fills = ", ".join([f"quantile_cont({c}, 0.5) AS {c}__fill" for c in med] + [f"avg({c}) AS {c}__fill" for c in mean])
    imp_rep = ", ".join(f"coalesce({c}, s.{c}__fill) AS {c}" for c in spec.impute)
    cont = spec.continuous
    bnd = ", ".join(
        f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}__lo, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}__hi"
        for c in cont)
    win_rep = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, b.{c}__lo), b.{c}__hi) END AS {c}"
                        for c in cont)
    so = ", ".join(spec.split_order)
    pos = spec.positive_season
    sc = ", ".join(
        f"avg({c}) AS {c}__m, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}__s" for c in cont)
    scaled = ", ".join(f"({c} - p.{c}__m) / p.{c}__s AS {c}_scaled" for c in cont)
    return {
        "c_dedup": f"SELECT * EXCLUDE (__rn) REPLACE ({real}) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS __rn FROM {src}) WHERE __rn = 1",
        "c_imp": f"SELECT d.* REPLACE ({imp_rep}) FROM c_dedup d, (SELECT {fills} FROM c_dedup) s",
        "c_win": f"SELECT i.* REPLACE ({win_rep}) FROM c_imp i, (SELECT {bnd} FROM c_imp) b",
        "c_enc": f"SELECT *, CASE WHEN upper(left(trim({spec.season}), 1)) || lower(substr(trim({spec.season}), 2)) = '{pos}' THEN 1 ELSE 0 END AS season_binary FROM c_win",
        "c_ord": f"SELECT *, row_number() OVER (ORDER BY {so}) - 1 AS ordinal, count(*) OVER () AS __n FROM c_enc",
        "c_split": f"SELECT * EXCLUDE (__n), CASE WHEN ordinal < floor(__n * {spec.ratio}) THEN 'train' ELSE 'test' END AS split FROM c_ord",
        "c_par": f"SELECT {sc} FROM c_split WHERE split = 'train'",
        "clean": f"SELECT c.*, {scaled}, {spec.target_src} AS {spec.target} FROM c_split c, c_par p",
    }


def feature_ctes(spec: PanelSpec = PANEL, src: str = "clean") -> dict:
    ser = ", ".join(spec.series)
    part = f"PARTITION BY {ser} " if spec.series else ""
    o = ", ".join(spec.order)
    w = f"({part}ORDER BY {o})"
    wf = f"({part}ORDER BY {o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    w3 = f"({part}ORDER BY {o} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    t = spec.target
    grp = ", ".join([*spec.series, spec.season])
    return {
        "f_lag": f"SELECT *, lag({t}, 1) OVER {w} AS __l1, lag({t}, 2) OVER {w} AS __l2, "
                 f"avg({spec.rainfall}) OVER {w3} AS rainfall_roll3, avg({spec.temperature}) OVER {w3} AS temp_roll3 FROM {src}",
        "f_fill": f"SELECT * EXCLUDE (__l1, __l2), "
                  f"coalesce(__l1, first_value(__l1 IGNORE NULLS) OVER {wf}) AS yield_lag1, "
                  f"coalesce(__l2, first_value(__l2 IGNORE NULLS) OVER {wf}) AS yield_lag2 FROM f_lag",
        "f_stat": f"SELECT {grp}, avg({spec.rainfall}) AS __mean, stddev_samp({spec.rainfall}) AS __std FROM f_fill GROUP BY {grp}",
        "features": f"SELECT f.*, {spec.rainfall}_scaled * {spec.temperature}_scaled AS rain_x_temp, "
                    f"{spec.inflation}_scaled * {spec.gdp}_scaled AS inf_x_gdp, "
                    f"CAST(coalesce(f.{spec.rainfall} < s.__mean - 1.0 * s.__std, false) AS INT) AS drought_flag, "
                    f"CASE WHEN {spec.harvested} IS NULL OR {spec.sown} IS NULL THEN NULL "
                    f"WHEN {spec.sown} = 0 AND {spec.harvested} > 0 THEN 1.0 WHEN {spec.sown} = 0 AND {spec.harvested} < 0 THEN 0.5 "
                    f"WHEN {spec.sown} = 0 THEN NULL ELSE least(greatest({spec.harvested} / {spec.sown}, 0.5), 1.0) END AS harvest_efficiency "
                    f"FROM f_fill f JOIN f_stat s USING ({grp})",
    }


def clean_sql(body: str, spec: PanelSpec = PANEL, source: str = PANEL_SQL, **extra) -> str:
    return with_ctes(body, panel=source, **clean_ctes(spec), **extra)


def features_sql(body: str, spec: PanelSpec = PANEL, source: str = PANEL_SQL, **extra) -> str:
    return with_ctes(body, panel=source, **clean_ctes(spec), **feature_ctes(spec), **extra)
