"""Queries for projections, joins, aggregations, windows, sort/dedup,
scalar functions and cleaning (SURVEY 2.3 - 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import features as FE
from ..operators import joins as J
from ..operators import ordinal as OR
from ..operators import profile as P
from ..operators import quality as QL
from ..operators import split as SP
from . import bindings as B
from . import flows as FL
from .registry import query, rounded, rsql
from .sql_twins import clean_sql, features_sql

W = B.with_ctes
PANEL = B.PANEL_SQL
HALF = B.HALF_SQL
PCOLS = ["sown", "harvested", "rainfall", "temperature", "gdp", "inflation", "production"]


def _t(spark, sf, name):
    return B.table(spark, sf, name)


# ---------------------------------------------------------------- derived inputs
@query("bind_panel", rsql(PANEL, PCOLS))
def bind_panel(spark, sf):
    return rounded(B.panel(spark, sf))


@query("bind_half", rsql(HALF, PCOLS))
def bind_half(spark, sf):
    return rounded(B.half(spark, sf))


@query("bind_cells", B.CELLS_SQL)
def bind_cells(spark, sf):
    return B.cells(spark, sf)


# ---------------------------------------------------------------- 2.3 projections
@query("proj_rename_subset", W("SELECT year, season, production AS orders_prod FROM half", half=HALF))
def proj_rename_subset(spark, sf):
    return B.half(spark, sf).select("year", "season", F.col("production").alias("orders_prod"))


_FEAT_OUT = FL.FEATURES + ["target"]


@query("proj_features", rsql(features_sql(f"SELECT series, year, month, {', '.join(_FEAT_OUT)} FROM features"),
                             [c for c in _FEAT_OUT if c not in ("season_binary", "drought_flag")]))
def proj_features(spark, sf):
    f = FL.features(FL.clean(B.panel(spark, sf)))
    return rounded(f.select("series", "year", "month", *_FEAT_OUT))


@query("filter_group_notnull", W("SELECT series, year, month, rainfall FROM panel WHERE season = 'H1' AND rainfall IS NOT NULL", panel=PANEL))
def filter_group_notnull(spark, sf):
    p = B.panel(spark, sf)
    return p.where(F.col("season") == "H1").dropna(subset=["rainfall"]).select("series", "year", "month", "rainfall")


@query("encode_binary", """SELECT o_orderkey, CASE WHEN upper(left(trim(o_orderstatus), 1)) || lower(substr(trim(o_orderstatus), 2)) = 'F' THEN 1 ELSE 0 END AS status_binary FROM orders""")
def encode_binary(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", S.encode_binary("o_orderstatus", "F").alias("status_binary"))


@query("map_order_code", W("""SELECT row_number() OVER (ORDER BY year, CASE season WHEN 'H1' THEN 0 WHEN 'H2' THEN 1 END NULLS LAST, series, month) - 1 AS position,
       series, year, month, season, CASE season WHEN 'H1' THEN 0 WHEN 'H2' THEN 1 END AS season_code FROM panel""", panel=PANEL))
def map_order_code(spark, sf):
    p = B.panel(spark, sf).withColumn("season_code", S.map_order_code("season", FL.PANEL.season_codes))
    out = OR.with_ordinal(p, [F.col("year"), F.col("season_code").asc_nulls_last(), F.col("series"), F.col("month")], name="position")
    return out.select("position", "series", "year", "month", "season", "season_code")


@query("alias_target", rsql(W("SELECT series, year, month, production, production AS target FROM panel", panel=PANEL), ["production", "target"]))
def alias_target(spark, sf):
    p = B.panel(spark, sf)
    return rounded(p.select("series", "year", "month", "production", F.col("production").alias("target")))


@query("bucket_decade", """SELECT o_orderkey, CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS decade,
       CAST(CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS VARCHAR) || 's' AS decade_label FROM orders""")
def bucket_decade(spark, sf):
    o = _t(spark, sf, "orders")
    y = F.year("o_orderdate")
    return o.select("o_orderkey", S.decade(y).alias("decade"), S.decade_label(y).alias("decade_label"))


@query("scatter_feed", rsql(W("SELECT sown AS x, production AS y, season AS grp, harvested AS size, year FROM panel", panel=PANEL), ["x", "y", "size"]))
def scatter_feed(spark, sf):
    p = B.panel(spark, sf)
    return rounded(p.select(F.col("sown").alias("x"), F.col("production").alias("y"), F.col("season").alias("grp"),
                            F.col("harvested").alias("size"), "year"))


# ---------------------------------------------------------------- 2.4 joins
# per nation and day: many days have orders but no shipments, and the other way round
_ORD_NAT = """SELECT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n_orders
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
_SUP_NAT = """SELECT s_nationkey AS nation, CAST(l_shipdate AS DATE) AS day,
              CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS shipped_qty
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"""


def _orders_by_nation(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy(
        F.col("c_nationkey").alias("nation"), F.col("o_orderdate").cast("date").alias("day")
    ).agg(F.count(F.lit(1)).alias("n_orders"))


def _supply_by_nation(spark, sf):
    li, s = _t(spark, sf, "lineitem"), _t(spark, sf, "supplier")
    return li.join(s, li.l_suppkey == s.s_suppkey).groupBy(
        F.col("s_nationkey").alias("nation"), F.col("l_shipdate").cast("date").alias("day")
    ).agg(F.sum(F.col("l_quantity").cast(B.D)).cast("double").alias("shipped_qty"))


@query("join_outer_metrics", W("""SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.day, b.day) AS day, n_orders, shipped_qty
    FROM a FULL OUTER JOIN b ON a.nation IS NOT DISTINCT FROM b.nation AND a.day IS NOT DISTINCT FROM b.day""", a=_ORD_NAT, b=_SUP_NAT))
def join_outer_metrics(spark, sf):
    return J.outer_merge(_orders_by_nation(spark, sf), _supply_by_nation(spark, sf), ["nation", "day"])


@query("join_or_only_side", W("""SELECT nation, day, n_orders, CAST(NULL AS DOUBLE) AS shipped_qty FROM a""", a=_ORD_NAT))
def join_or_only_side(spark, sf):
    empty = _supply_by_nation(spark, sf).where(F.lit(False))
    return J.outer_merge(_orders_by_nation(spark, sf), empty, ["nation", "day"])


_ORD_TOT = """SELECT CAST(year(o_orderdate) AS INT) AS year, CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS season,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS orders_total FROM orders GROUP BY 1, 2"""


def _orders_total(spark, sf):
    o = _t(spark, sf, "orders")
    m = F.month("o_orderdate")
    return o.groupBy(F.year("o_orderdate").cast("int").alias("year"),
                     F.when(m <= 6, "H1").otherwise("H2").alias("season")).agg(
        (F.sum(F.col("o_totalprice").cast(B.D)).cast("double") / 1000).alias("orders_total"))


@query("join_inner_recon", rsql(W("SELECT year, season, orders_total, production AS lines_total FROM a JOIN half USING (year, season)",
                                  a=_ORD_TOT, half=HALF), ["orders_total", "lines_total"]))
def join_inner_recon(spark, sf):
    h = B.half(spark, sf).select("year", "season", F.col("production").alias("lines_total"))
    return rounded(J.inner_merge(_orders_total(spark, sf), h, ["year", "season"]))


# ---------------------------------------------------------------- 2.5 aggregations
_LABELS = ("o_orderstatus", "o_orderpriority")


def _profile_sql():
    cols = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
            ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False), ("o_orderpriority", "string", False)]
    parts = []
    for c, t, num in cols:
        mn = f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        mx = f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, {len(cols)} AS n_columns, "
                     f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, {mn} AS min_value, {mx} AS max_value, "
                     f"{f'COUNT(DISTINCT {c})' if c in _LABELS else 'CAST(NULL AS BIGINT)'} AS n_labels FROM orders")
    return " UNION ALL ".join(parts)


@query("agg_profile", _profile_sql())
def agg_profile(spark, sf):
    return P.profile(_t(spark, sf, "orders"), labels=_LABELS)


_LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols, table):
    parts = [f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
        quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM {table}"""
             for c in cols]
    return rsql(" UNION ALL ".join(parts), ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query("agg_describe", _describe_sql(_LI4, "lineitem"))
def agg_describe(spark, sf):
    return rounded(P.describe(_t(spark, sf, "lineitem"), _LI4))


@query("agg_value_counts", "SELECT event_type, COUNT(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def agg_value_counts(spark, sf):
    return P.value_counts(_t(spark, sf, "events"), "event_type")


_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("agg_missing", W(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM holes" for c in _LI_ALL), holes=B.HOLES_SQL))
def agg_missing(spark, sf):
    return P.missing_counts(B.holes(spark, sf))


@query("agg_dup_exact", """SELECT CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS n_duplicates FROM
    (SELECT event_type, floor(value) AS v, COUNT(*) AS n FROM events GROUP BY ALL)""")
def agg_dup_exact(spark, sf):
    e = _t(spark, sf, "events").select("event_type", F.floor("value").alias("v"))
    return P.duplicate_count(e)


@query("agg_dup_key", """SELECT CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS n_duplicates FROM
    (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL)""")
def agg_dup_key(spark, sf):
    return P.duplicate_count(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _hist_sql(src):
    """Bins by their edges: a value's bin is the number of inner edges at or below it."""
    return rsql(f"""WITH d AS ({src}),
r AS (SELECT g, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM d GROUP BY 1),
e AS (SELECT g, CAST(b AS INT) AS bin, lo + b * ((hi - lo) / 20.0) AS bin_lo,
             CASE WHEN b = 19 THEN hi ELSE lo + (b + 1) * ((hi - lo) / 20.0) END AS bin_hi FROM r, range(0, 20) t(b)),
c AS (SELECT e.g, e.bin, COUNT(*) AS n FROM d JOIN e ON d.g = e.g AND x >= bin_lo AND (x < bin_hi OR bin = 19) GROUP BY 1, 2)
SELECT e.g, e.bin, bin_lo, bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM e LEFT JOIN c ON e.g = c.g AND e.bin = c.bin""", ["bin_lo", "bin_hi"])


@query("agg_histogram", _hist_sql("SELECT l_returnflag AS g, l_extendedprice AS x FROM lineitem WHERE NOT isnan(l_extendedprice)"))
def agg_histogram(spark, sf):
    h = P.histogram(_t(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"], bins=20)
    return rounded(h.withColumnRenamed("l_returnflag", "g"))


@query("agg_histogram_columns", _hist_sql(" UNION ALL ".join(f"SELECT '{c}' AS g, {c} AS x FROM lineitem WHERE NOT isnan({c})" for c in _LI4)))
def agg_histogram_columns(spark, sf):
    """Histograms of several columns in one pass."""
    return rounded(P.histogram(_t(spark, sf, "lineitem"), _LI4, bins=20).withColumnRenamed("column_name", "g"))


def _iqr_sql(cols, table):
    parts = []
    for c in cols:
        q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
        parts.append(f"""SELECT '{c}' AS column_name, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
            (SELECT COUNT(*) FROM {table} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
            FROM (SELECT {q1} AS q1, {q3} AS q3 FROM {table})""")
    return rsql(" UNION ALL ".join(parts), ["q1", "q3", "lower", "upper"])


@query("agg_iqr_outliers", _iqr_sql(_LI4, "lineitem"))
def agg_iqr_outliers(spark, sf):
    return rounded(P.iqr_outliers(_t(spark, sf, "lineitem"), _LI4))


def _box_sql(src, col, by):
    b = ", ".join(by)
    return rsql(f"""WITH d AS (SELECT {b}, CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
q AS (SELECT {b}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM d GROUP BY {b})
SELECT {b}, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
       least(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)), any_value(q1)) AS whisker_lo,
       greatest(max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)), any_value(q3)) AS whisker_hi,
       COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers, COUNT(*) AS n
FROM d JOIN q USING ({b}) GROUP BY {b}""", ["q1", "median", "q3", "whisker_lo", "whisker_hi"])


@query("agg_box_by_group", _box_sql("orders", "o_totalprice", ["o_orderpriority"]))
def agg_box_by_group(spark, sf):
    return rounded(P.box_stats(_t(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"]))


_ORD_DEC = """SELECT *, CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS decade,
              CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS season FROM orders"""


def _orders_decade(spark, sf):
    o = _t(spark, sf, "orders")
    return o.withColumn("decade", S.decade(F.year("o_orderdate"))).withColumn(
        "season", F.when(F.month("o_orderdate") <= 6, "H1").otherwise("H2"))


@query("agg_box_decade", W(_box_sql("od", "o_totalprice", ["decade", "season"]), od=_ORD_DEC))
def agg_box_decade(spark, sf):
    return rounded(P.box_stats(_orders_decade(spark, sf), "o_totalprice", ["decade", "season"]))


@query("agg_box_points", """SELECT event_id, event_type, value FROM events JOIN
    (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) q
    USING (event_type) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def agg_box_points(spark, sf):
    """Events have values far outside the fences (about one in twenty)."""
    return P.box_outlier_points(_t(spark, sf, "events").select("event_id", "event_type", "value"), "value", ["event_type"])


# production carries at most 7 decimals: summing it as DECIMAL(38,7) is exact
# in both engines (a double sum depends on the summation order)
_DEC7 = "decimal(38,7)"


@query("agg_trend", rsql(W("SELECT year, season, CAST(sum(CAST(production AS DECIMAL(38,7))) AS DOUBLE) AS production FROM panel GROUP BY 1, 2", panel=PANEL), ["production"]))
def agg_trend(spark, sf):
    p = B.panel(spark, sf)
    return rounded(p.groupBy("year", "season").agg(F.sum(F.col("production").cast(_DEC7)).cast("double").alias("production"))
                   .orderBy("season", "year"))


@query("agg_group_mean", rsql(W("SELECT season, CAST(sum(CAST(production AS DECIMAL(38,7))) AS DOUBLE) / COUNT(*) AS mean_target FROM half GROUP BY 1", half=HALF), ["mean_target"]))
def agg_group_mean(spark, sf):
    h = B.half(spark, sf)
    return rounded(h.groupBy("season").agg(
        (F.sum(F.col("production").cast(_DEC7)).cast("double") / F.count(F.lit(1))).alias("mean_target")))


@query("agg_group_mean_std", rsql(W("SELECT season, avg(rainfall) AS mean, stddev_samp(rainfall) AS std FROM panel GROUP BY 1", panel=PANEL), ["mean", "std"]))
def agg_group_mean_std(spark, sf):
    return rounded(P.group_mean_std(B.panel(spark, sf), "rainfall", ["season"]))


def _corr_sql(cols, src, digits=8):
    parts = [f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS r FROM {src}" for a in cols for b in cols]
    return rsql(" UNION ALL ".join(parts), ["r"], digits)


@query("agg_corr_matrix", _corr_sql(_LI4, "lineitem"))
def agg_corr_matrix(spark, sf):
    return rounded(P.corr_matrix(_t(spark, sf, "lineitem"), _LI4), 8)


_P7 = ["rainfall", "temperature", "gdp", "inflation", "sown", "harvested", "production"]


@query("agg_corr_matrix_panel", W(_corr_sql(_P7, "panel"), panel=PANEL))
def agg_corr_matrix_panel(spark, sf):
    return rounded(P.corr_matrix(B.panel(spark, sf), _P7), 8)


def _corr_rank_sql(feats, target, src):
    parts = [f"SELECT '{f}' AS feature, corr({f}, {target}) AS r FROM {src}" for f in feats]
    body = f"""SELECT feature, r, CASE WHEN abs(r) > 0.5 THEN 'strong' WHEN abs(r) > 0.3 THEN 'moderate' ELSE 'weak' END AS strength,
        CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction FROM ({' UNION ALL '.join(parts)})"""
    return rsql(body, ["r"], 8)


@query("agg_corr_rank", _corr_rank_sql(["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "lineitem"))
def agg_corr_rank(spark, sf):
    return rounded(P.corr_rank(_t(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"), 8)


_FEATS_NUM = [c for c in FL.FEATURES if c != "season_binary"]


@query("agg_corr_rank_features", features_sql(_corr_rank_sql(_FEATS_NUM, "target", "features")))
def agg_corr_rank_features(spark, sf):
    f = FL.features(FL.clean(B.panel(spark, sf)))
    return rounded(P.corr_rank(f, _FEATS_NUM, "target"), 8)


_SC = [f"{c}_scaled" for c in FL.PANEL.continuous]


@query("agg_scaled_check", clean_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM clean WHERE split = 'train'"
    for c in _SC)))
def agg_scaled_check(spark, sf):
    c = FL.clean(B.panel(spark, sf))
    return P.scaled_check(c, _SC, where=F.col("split") == "train")


# ---------------------------------------------------------------- 2.6 windows
_WP = "(PARTITION BY series ORDER BY year, month)"


@query("win_lag1", rsql(W(f"SELECT series, year, month, production, lag(production, 1) OVER {_WP} AS lag1 FROM panel", panel=PANEL), ["production", "lag1"]))
def win_lag1(spark, sf):
    out = FE.lags_and_rolls(B.panel(spark, sf), ["series"], ["year", "month"], lags={"lag1": ("production", 1)})
    return rounded(out.select("series", "year", "month", "production", "lag1"))


@query("win_lag2", rsql(W(f"SELECT series, year, month, production, lag(production, 2) OVER {_WP} AS lag2 FROM panel", panel=PANEL), ["production", "lag2"]))
def win_lag2(spark, sf):
    out = FE.lags_and_rolls(B.panel(spark, sf), ["series"], ["year", "month"], lags={"lag2": ("production", 2)})
    return rounded(out.select("series", "year", "month", "production", "lag2"))


@query("win_backfill", rsql(W(f"""SELECT series, year, month, coalesce(l, first_value(l IGNORE NULLS) OVER
    (PARTITION BY series ORDER BY year, month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS lag2_filled
    FROM (SELECT *, lag(production, 2) OVER {_WP} AS l FROM panel)""", panel=PANEL), ["lag2_filled"]))
def win_backfill(spark, sf):
    out = FE.lags_and_rolls(B.panel(spark, sf), ["series"], ["year", "month"], lags={"__l": ("production", 2)},
                            backfill={"lag2_filled": "__l"})
    return rounded(out.select("series", "year", "month", "lag2_filled"))


@query("win_roll3", rsql(W("""SELECT series, year, month, avg(rainfall) OVER (PARTITION BY series ORDER BY year, month
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rainfall_roll3 FROM panel""", panel=PANEL), ["rainfall_roll3"]))
def win_roll3(spark, sf):
    out = FE.lags_and_rolls(B.panel(spark, sf), ["series"], ["year", "month"], rolls={"rainfall_roll3": ("rainfall", 3)})
    return rounded(out.select("series", "year", "month", "rainfall_roll3"))


@query("win_roll3_events", rsql("""SELECT event_id, user_id, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value_roll3 FROM events""", ["value_roll3"]))
def win_roll3_events(spark, sf):
    e = _t(spark, sf, "events")
    out = FE.lags_and_rolls(e, ["user_id"], ["ts", "event_id"], rolls={"value_roll3": ("value", 3)})
    return rounded(out.select("event_id", "user_id", "value_roll3"))


@query("flag_anomaly", W("""SELECT series, year, month, CAST(coalesce(rainfall < m - 1.0 * s, false) AS INT) AS drought_flag
    FROM panel JOIN (SELECT series, season, avg(rainfall) AS m, stddev_samp(rainfall) AS s FROM panel GROUP BY 1, 2) USING (series, season)""", panel=PANEL))
def flag_anomaly(spark, sf):
    out = FE.anomaly_flag(B.panel(spark, sf), "rainfall", ["series", "season"])
    return out.select("series", "year", "month", "drought_flag")


_GRP = ["l_returnflag", "l_linestatus"]


@query("join_group_stats", rsql("""SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_extendedprice, grp_mean, grp_std
    FROM lineitem LEFT JOIN (SELECT l_returnflag, l_linestatus, avg(l_extendedprice) AS grp_mean, stddev_samp(l_extendedprice) AS grp_std
    FROM lineitem GROUP BY 1, 2) s USING (l_returnflag, l_linestatus)""", ["l_extendedprice", "grp_mean", "grp_std"]))
def join_group_stats(spark, sf):
    """Per-row lookup of its group's mean / std: grouped statistics (partial
    aggregation, one row per group) joined back, broadcast under the checked
    row bound."""
    li = _t(spark, sf, "lineitem")
    st = li.groupBy(*_GRP).agg(F.avg("l_extendedprice").alias("grp_mean"), F.stddev_samp("l_extendedprice").alias("grp_std"))
    out = J.attach_group_stats(li.select("l_orderkey", "l_linenumber", *_GRP, "l_extendedprice"), st, _GRP)
    return rounded(out.select("l_orderkey", "l_linenumber", *_GRP, "l_extendedprice", "grp_mean", "grp_std"))


# ---------------------------------------------------------------- 2.7 sort / top-k / dedup / union
@query("sort_keys", W("SELECT row_number() OVER (ORDER BY year, season NULLS LAST, series NULLS LAST, month) - 1 AS position, series, year, month, season FROM panel", panel=PANEL))
def sort_keys(spark, sf):
    p = B.panel(spark, sf)
    out = OR.with_ordinal(p, [F.col("year").asc_nulls_last(), F.col("season").asc_nulls_last(),
                              F.col("series").asc_nulls_last(), F.col("month").asc_nulls_last()], name="position")
    return out.select("position", "series", "year", "month", "season")


@query("topk_first", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10")
def topk_first(spark, sf):
    from ..operators.shaping import first_rows
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return first_rows(o, ["o_orderdate", "o_orderkey"], 10)


_LI_REST = [c for c in _LI_ALL if c not in ("l_orderkey", "l_linenumber")]


@query("dedup_keep_first", f"""SELECT {', '.join(_LI_ALL)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate ASC NULLS LAST, {', '.join(c + ' ASC NULLS LAST' for c in _LI_REST)}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_keep_first(spark, sf):
    """One line per (order, line number): the first one shipped."""
    return QL.dedup_keep_first(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order=["l_shipdate"])


@query("union_frames", "SELECT event_id, user_id, event_type, value FROM events")
def union_frames(spark, sf):
    from ..operators.shaping import union_all
    e = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    # split by a rule into parts, then concatenate (duplicates kept)
    parts = [e.where(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(3)) == k) for k in range(3)]
    return union_all(parts, schema_of=e)


# ---------------------------------------------------------------- 2.8 scalar functions
_TITLE = "array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


@query("fn_string_norm", f"""SELECT c_custkey, regexp_replace(c_name, '^\\s+|\\s+$', '', 'g') AS name_stripped,
    {_TITLE.format(x="c_mktsegment")} AS segment_title, upper(c_name) AS name_upper, lower(c_name) AS name_lower,
    split_part(c_name, '#', 2) AS name_suffix, contains(lower(c_mktsegment), 'build') AS is_building,
    regexp_matches(split_part(c_name, '#', 2), '^[0-9]+$') AS suffix_is_digits FROM customer""")
def fn_string_norm(spark, sf):
    c = _t(spark, sf, "customer")
    suffix = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    return c.select("c_custkey", S.strip("c_name").alias("name_stripped"), S.title("c_mktsegment").alias("segment_title"),
                    F.upper("c_name").alias("name_upper"), F.lower("c_name").alias("name_lower"), suffix.alias("name_suffix"),
                    S.lower_contains("c_mktsegment", "build").alias("is_building"), S.is_digits(suffix).alias("suffix_is_digits"))


_ACCT_TXT = """CASE c_custkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN ' ' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || ' '
    WHEN 2 THEN '1,' || CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR) ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END"""


def _acct_txt():
    txt = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    k = F.col("c_custkey") % 5
    return (F.when(k == 0, F.lit("n/a")).when(k == 1, F.concat(F.lit(" "), txt, F.lit(" ")))
            .when(k == 2, F.concat(F.lit("1,"), F.abs(F.col("c_acctbal")).cast("decimal(12,2)").cast("string"))).otherwise(txt))


@query("fn_numeric_coerce", f"""SELECT c_custkey, acct_text, CASE WHEN isnan(TRY_CAST(trim(acct_text) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(acct_text) AS DOUBLE) END AS acct_value
    FROM (SELECT c_custkey, {_ACCT_TXT} AS acct_text FROM customer)""")
def fn_numeric_coerce(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", _acct_txt().alias("acct_text"))
    return c.withColumn("acct_value", S.to_double("acct_text"))


_TS_TXT = "CASE WHEN event_id % 13 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"


@query("fn_timestamp_coerce", f"""SELECT event_id, ts_text, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS ts_parsed
    FROM (SELECT event_id, {_TS_TXT} AS ts_text FROM events)""")
def fn_timestamp_coerce(spark, sf):
    e = _t(spark, sf, "events")
    txt = F.when(F.col("event_id") % 13 == 0, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    e = e.select("event_id", txt.alias("ts_text"))
    return e.withColumn("ts_parsed", S.to_timestamp_lenient("ts_text", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz"))


@query("fn_interaction", rsql(W("SELECT series, year, month, rainfall * temperature AS rain_x_temp, inflation * gdp AS inf_x_gdp FROM panel", panel=PANEL), ["rain_x_temp", "inf_x_gdp"]))
def fn_interaction(spark, sf):
    p = B.panel(spark, sf)
    return rounded(p.select("series", "year", "month", S.interaction("rainfall", "temperature").alias("rain_x_temp"),
                            S.interaction("inflation", "gdp").alias("inf_x_gdp")))


@query("fn_ratio_clip", rsql(W("""SELECT series, year, month, CASE WHEN harvested IS NULL OR sown IS NULL THEN NULL
    WHEN sown = 0 AND harvested > 0 THEN 1.0 WHEN sown = 0 AND harvested < 0 THEN 0.5 WHEN sown = 0 THEN NULL
    ELSE least(greatest(harvested / sown, 0.5), 1.0) END AS harvest_efficiency FROM panel""", panel=PANEL), ["harvest_efficiency"]))
def fn_ratio_clip(spark, sf):
    p = B.panel(spark, sf)
    return rounded(p.select("series", "year", "month", S.ratio_clip("harvested", "sown").alias("harvest_efficiency")))


@query("fn_abs_pct_diff", rsql(W("""SELECT year, season, abs((orders_total - production) / nullif(production, 0) * 100) AS diff_pct
    FROM a JOIN half USING (year, season)""", a=_ORD_TOT, half=HALF), ["diff_pct"]))
def fn_abs_pct_diff(spark, sf):
    j = J.inner_merge(_orders_total(spark, sf), B.half(spark, sf), ["year", "season"])
    return rounded(j.select("year", "season", S.abs_pct_diff("orders_total", "production").alias("diff_pct")))


@query("fn_delta_pct", rsql(W("""SELECT year, season, (production - m) / nullif(m, 0) * 100 AS delta_pct
    FROM half JOIN (SELECT season, avg(production) AS m FROM half GROUP BY 1) USING (season)""", half=HALF), ["delta_pct"]))
def fn_delta_pct(spark, sf):
    h = B.half(spark, sf)
    m = h.groupBy("season").agg(F.avg("production").alias("m"))
    return rounded(J.attach_group_stats(h, m, ["season"]).select("year", "season", S.delta_pct("production", "m").alias("delta_pct")))


@query("fn_unit_density", rsql(W("""SELECT series, year, month, production * 1000.0 AS tonnes,
    (production * 1000.0) / nullif(harvested * 1000.0, 0) * 1000.0 AS kg_per_acre FROM panel""", panel=PANEL), ["tonnes", "kg_per_acre"]))
def fn_unit_density(spark, sf):
    p = B.panel(spark, sf)
    return rounded(p.select("series", "year", "month", S.tonnes("production").alias("tonnes"),
                            S.kg_per_acre("production", "harvested").alias("kg_per_acre")))


# ---------------------------------------------------------------- 2.9 cleaning / quality
@query("clean_impute", rsql(W("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_extendedprice, s.pm) AS l_extendedprice, coalesce(l_quantity, s.qm) AS l_quantity
    FROM holes, (SELECT quantile_cont(l_extendedprice, 0.5) AS pm, avg(l_quantity) AS qm FROM holes) s""", holes=B.HOLES_SQL), ["l_extendedprice", "l_quantity"]))
def clean_impute(spark, sf):
    h = QL.impute(B.holes(spark, sf), {"l_extendedprice": "median", "l_quantity": "mean"})
    return rounded(h.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"))


_WIN3 = ["l_quantity", "l_extendedprice", "l_discount"]


def _winsor_sql():
    b = ", ".join(f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}__lo, "
                  f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}__hi" for c in _WIN3)
    sel = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {c}__lo), {c}__hi) END AS {c}" for c in _WIN3)
    return rsql(f"SELECT l_orderkey, l_linenumber, l_partkey, {sel} FROM lineitem, (SELECT {b} FROM lineitem)", _WIN3)


@query("clean_winsorize", _winsor_sql())
def clean_winsorize(spark, sf):
    w = QL.winsorize(_t(spark, sf, "lineitem"), _WIN3)
    return rounded(w.select("l_orderkey", "l_linenumber", "l_partkey", *_WIN3))


@query("clean_winsor_counts", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} < lo OR {c} > hi) AS n_capped FROM lineitem,
    (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
            quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM lineitem)""" for c in _WIN3))
def clean_winsor_counts(spark, sf):
    return QL.winsor_counts(_t(spark, sf, "lineitem"), _WIN3)


_RECON = W("""SELECT year, season, orders_total, production AS lines_total,
    abs((orders_total - production) / nullif(production, 0) * 100) AS diff_pct FROM a JOIN half USING (year, season)""", a=_ORD_TOT, half=HALF)


def _recon_rows(spark, sf):
    h = B.half(spark, sf).select("year", "season", F.col("production").alias("lines_total"))
    return QL.recon_rows(_orders_total(spark, sf), h, ["year", "season"], "orders_total", "lines_total")


@query("recon_rows", rsql(_RECON, ["orders_total", "lines_total", "diff_pct"]))
def recon_rows(spark, sf):
    return rounded(_recon_rows(spark, sf))


@query("recon_summary", rsql(f"SELECT COUNT(*) AS n_overlap, avg(diff_pct) AS mean_diff_pct, COUNT(*) FILTER (WHERE diff_pct > 5) AS n_exceptions FROM ({_RECON})", ["mean_diff_pct"]))
def recon_summary(spark, sf):
    return rounded(QL.recon_summary(_recon_rows(spark, sf)))


@query("filter_threshold", rsql(f"SELECT * FROM ({_RECON}) WHERE diff_pct > 5", ["orders_total", "lines_total", "diff_pct"]))
def filter_threshold(spark, sf):
    return rounded(_recon_rows(spark, sf).where(F.col("diff_pct") > 5.0))


@query("recon_exceptions", rsql(f"SELECT * FROM ({_RECON}) WHERE diff_pct > 5 ORDER BY year, season LIMIT 10", ["orders_total", "lines_total", "diff_pct"]))
def recon_exceptions(spark, sf):
    return rounded(QL.recon_exceptions(_recon_rows(spark, sf), ["year", "season"]))


_CLEAN_OUT = ["series", "year", "month", "season", *PCOLS, "season_binary", "ordinal", "split", *_SC, "target"]


@query("clean_full", rsql(clean_sql(f"SELECT {', '.join(_CLEAN_OUT)} FROM clean", FL.DIRTY, source=B.DIRTY_SQL), [*PCOLS, *_SC, "target"]))
def clean_full(spark, sf):
    """A panel with repeated keys, NULLs and NaNs."""
    return rounded(FL.clean(B.panel_dirty(spark, sf), FL.DIRTY).select(*_CLEAN_OUT))


_FEAT_ALL = _CLEAN_OUT + [c for c in FL.FEATURES if c not in _CLEAN_OUT]


@query("features_full", rsql(features_sql(f"SELECT {', '.join(_FEAT_ALL)} FROM features", FL.DIRTY, source=B.DIRTY_SQL),
                             [*PCOLS, *_SC, "target", "yield_lag1", "yield_lag2", "rainfall_roll3", "temp_roll3",
                              "rain_x_temp", "inf_x_gdp", "harvest_efficiency"]))
def features_full(spark, sf):
    return rounded(FL.features(FL.clean(B.panel_dirty(spark, sf), FL.DIRTY), FL.DIRTY).select(*_FEAT_ALL))
