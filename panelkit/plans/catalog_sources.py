"""Queries for sources, sinks and report-grid reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import grid as G
from ..sources import readers as R
from . import bindings as B
from .registry import query, rounded, rsql

W = B.with_ctes
STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
TITLE = "array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"
SUMMARY_SQL = ", ".join(f"'{s}'" for s in S.SUMMARY_LABELS)


def _strip(x):
    return STRIP.format(x=x)


def _low(x="value"):
    return f"lower({_strip(x)})"


def _parse_year_sql(x):
    s = _strip(f"CAST({x} AS VARCHAR)")
    head = f"split_part({s}, '/', 1)"
    return (f"CASE WHEN contains({s}, '/') THEN CASE WHEN regexp_full_match({head}, '\\s*[+-]?[0-9]+\\s*') "
            f"THEN TRY_CAST({head} AS INTEGER) END ELSE TRY_CAST(trunc(TRY_CAST({s} AS DOUBLE)) AS INTEGER) END")


def _season_sql(x="file"):
    return (f"CASE WHEN contains(lower({x}), 'maha') THEN 'Maha' WHEN contains(lower({x}), 'yala') THEN 'Yala' "
            f"ELSE 'Unknown' END")


def _double_sql(x):
    d = f"TRY_CAST({_strip(x)} AS DOUBLE)"
    return f"CASE WHEN isnan({d}) THEN NULL ELSE {d} END"


# ---------------------------------------------------------------- 2.1 sources / sinks
_VENDOR_SQL = f"""SELECT CAST(c_custkey AS VARCHAR) AS "Cust Key", '  ' || lower(c_mktsegment) || chr(9) AS "Segment",
    CASE c_custkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN ' ' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || ' '
         WHEN 2 THEN '1,' || CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR) ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS "Balance ($)",
    CAST(c_nationkey AS VARCHAR) AS "Nation" FROM customer"""

VENDOR_HEADERS = {"Cust Key": "custkey", "Segment": "segment", "Balance ($)": "acctbal", "Nation": "nation"}


def _vendor(spark, sf):
    c = B.table(spark, sf, "customer")
    txt = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    k = F.col("c_custkey") % 5
    bal = (F.when(k == 0, F.lit("n/a")).when(k == 1, F.concat(F.lit(" "), txt, F.lit(" ")))
           .when(k == 2, F.concat(F.lit("1,"), F.abs("c_acctbal").cast("decimal(12,2)").cast("string"))).otherwise(txt))
    return c.select(F.col("c_custkey").cast("string").alias("Cust Key"),
                    F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("\t")).alias("Segment"),
                    bal.alias("Balance ($)"), F.col("c_nationkey").cast("string").alias("Nation"))


@query("src_rename_coerce", W(f"""SELECT CAST("Cust Key" AS INTEGER) AS custkey, {TITLE.format(x=_strip('"Segment"'))} AS segment,
    {_double_sql('"Balance ($)"')} AS acctbal, {_double_sql('"Nation"')} AS nation FROM v""", v=_VENDOR_SQL))
def src_rename_coerce(spark, sf):
    return R.rename_coerce(_vendor(spark, sf), VENDOR_HEADERS, strict_int=["custkey"], labels=["segment"],
                           lenient=["acctbal", "nation"])


# the folder names a season and a metric of its own: only the file's stem counts
_PATH_SQL = """'/data/maha/production/p' || page_id || '/' || CASE page_id % 6 WHEN 0 THEN 'paddy_yield_maha' WHEN 1 THEN 'Paddy_Yeild_Yala' WHEN 2 THEN 'production_MAHA'
    WHEN 3 THEN 'sown_extent_yala' WHEN 4 THEN 'harvested_extent' ELSE 'notes' END || '.xlsx'"""


@query("src_route_files", f"""SELECT page_id, path,
    CASE WHEN contains(stem, 'yeild') OR contains(stem, 'yield') THEN 'yield' WHEN contains(stem, 'production') THEN 'production' END AS metric_route,
    CASE WHEN contains(stem, 'sown') THEN 'sown' WHEN contains(stem, 'harvested') THEN 'harvested' END AS extent_route,
    {_season_sql('stem')} AS season
    FROM (SELECT page_id, path, lower(parse_filename(path, true)) AS stem FROM (SELECT page_id, {_PATH_SQL} AS path FROM pages))""")
def src_route_files(spark, sf):
    p = B.table(spark, sf, "pages")
    k = F.col("page_id") % 6
    stem = (F.when(k == 0, "paddy_yield_maha").when(k == 1, "Paddy_Yeild_Yala").when(k == 2, "production_MAHA")
            .when(k == 3, "sown_extent_yala").when(k == 4, "harvested_extent").otherwise("notes"))
    p = p.select("page_id", F.concat(F.lit("/data/maha/production/p"), F.col("page_id"), F.lit("/"), stem, F.lit(".xlsx")).alias("path"))
    return p.withColumns(R.route_path("path"))


@query("src_optional", """SELECT event_id, try_strptime(d, '%Y-%m-%d %H:%M:%S') AS date, value FROM
    (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS d, value FROM events)""")
def src_optional(spark, sf):
    e = R.read_optional(spark, f"{sf}/events.parquet")
    if e is None:  # absent input: typed empty result
        return spark.createDataFrame([], "event_id bigint, date timestamp_ntz, value double")
    txt = F.when(F.col("event_id") % 11 == 0, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    e = e.select("event_id", txt.alias("date"), "value")
    return e.withColumn("date", S.to_timestamp_lenient("date", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz"))


_LOAD_ALL = ["orders", "lineitem", "customer", "events"]


@query("src_load_all", " UNION ALL ".join(f"SELECT '{t}' AS name, COUNT(*) AS n_rows FROM {t}" for t in _LOAD_ALL))
def src_load_all(spark, sf):
    frames = R.load_all(spark, {t: (lambda s, t=t: B.table(s, sf, t)) for t in _LOAD_ALL})
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "n_rows") for n, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("src_passthrough", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_passthrough(spark, sf):
    """A side table read as is (no parsing); a missing required input raises
    FileNotFoundError instead of yielding an empty frame."""
    return R.read_passthrough(spark, f"{sf}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


_PCOLS = ["sown", "harvested", "rainfall", "temperature", "gdp", "inflation", "production"]


def _roundtrip(spark, sf, fmt):
    p = rounded(B.panel(spark, sf))
    path = R.scratch_path(spark, f"panel-{fmt}")
    if fmt == "csv":
        R.write_table(p, path, fmt=fmt)
        return R.read_csv(spark, path, infer=True)
    # parquet is laid out per season: a season filter prunes whole folders
    R.write_table(p, path, fmt=fmt, partition_by=["season"])
    return spark.read.parquet(path).select(*p.columns)


@query("sink_roundtrip", rsql(B.PANEL_SQL, _PCOLS))
def sink_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "parquet")


@query("src_csv_inferred", rsql(B.PANEL_SQL, _PCOLS))
def src_csv_inferred(spark, sf):
    return _roundtrip(spark, sf, "csv")


# ---------------------------------------------------------------- 2.2 report grids
_HDR_SQL = f"SELECT file, min(row_idx) AS header_row FROM cells WHERE row_idx < 10 AND {_low()} = 'district' GROUP BY file"
_KEY_SQL = f"""SELECT h.file, coalesce(k.key_col, 1) AS key_col FROM hdr h LEFT JOIN
    (SELECT c.file, {{agg}}(c.col_idx) AS key_col FROM cells c JOIN hdr USING (file) WHERE c.row_idx = header_row AND {_low('c.value')} = 'district' GROUP BY c.file) k
    USING (file)"""
_FILL_SQL = f"""SELECT s.file, s.col_idx, arg_max(t.lab, t.col_idx) AS period_label FROM
    (SELECT c.file, c.col_idx FROM cells c JOIN hdr USING (file) WHERE c.row_idx = header_row + 1 AND {_low('c.value')} = 'total') s
    LEFT JOIN (SELECT c.file, c.col_idx, {_strip('c.value')} AS lab FROM cells c JOIN hdr USING (file)
               WHERE c.row_idx = header_row AND c.value IS NOT NULL AND {_low('c.value')} NOT IN ('nan', 'district')) t
    ON t.file = s.file AND t.col_idx <= s.col_idx GROUP BY s.file, s.col_idx"""


def _body_ctes(start_off):
    return {
        "body": f"""SELECT c.file, c.row_idx, upper({_strip('c.value')}) AS district FROM cells c JOIN hdr USING (file) JOIN keys USING (file)
                 WHERE c.row_idx >= header_row + {start_off} AND c.col_idx = key_col""",
        "bodyk": f"SELECT * FROM body WHERE district IS NOT NULL AND district <> '' AND district NOT IN ({SUMMARY_SQL})",
    }


_EMIT = f"""SELECT district, year, {_season_sql('b.file')} AS season, {_double_sql('c.value')} AS value
    FROM bodyk b JOIN ycols y ON b.file = y.file LEFT JOIN cells c ON c.file = b.file AND c.row_idx = b.row_idx AND c.col_idx = y.col_idx"""


@query("grid_header_row", W(_HDR_SQL.replace("FROM cells", "FROM cells", 1), cells=B.CELLS_SQL))
def grid_header_row(spark, sf):
    return G.header_rows(B.cells(spark, sf))


@query("grid_key_column", W("SELECT * FROM keys", cells=B.CELLS_SQL, hdr=_HDR_SQL, keys=_KEY_SQL.format(agg="min")))
def grid_key_column(spark, sf):
    return G.key_columns(B.cells(spark, sf))


@query("grid_header_fill", W("SELECT * FROM fill", cells=B.CELLS_SQL, hdr=_HDR_SQL, fill=_FILL_SQL))
def grid_header_fill(spark, sf):
    return G.header_fill(B.cells(spark, sf))


_BANDED = W(_EMIT, cells=B.CELLS_SQL, hdr=_HDR_SQL, keys=_KEY_SQL.format(agg="min"), fill=_FILL_SQL,
            ycols=f"SELECT file, col_idx, {_parse_year_sql('period_label')} AS year FROM fill WHERE {_parse_year_sql('period_label')} IS NOT NULL",
            **_body_ctes(2))


@query("grid_unpivot_banded", _BANDED)
def grid_unpivot_banded(spark, sf):
    return G.unpivot_banded(B.cells(spark, sf))


_SIMPLE = W(_EMIT, cells=B.CELLS_SIMPLE_SQL, hdr=_HDR_SQL, keys=_KEY_SQL.format(agg="max"), **_body_ctes(1),
            ycols=f"""SELECT * FROM (SELECT c.file, c.col_idx, {_parse_year_sql('c.value')} AS year FROM cells c JOIN hdr USING (file)
                      WHERE c.row_idx = header_row AND c.value IS NOT NULL AND {_low('c.value')} <> 'district') WHERE year > 1900 AND year < 2100""")


@query("grid_unpivot_simple", _SIMPLE)
def grid_unpivot_simple(spark, sf):
    return G.unpivot_simple(B.cells_simple(spark, sf))


_KINDS = {"yield": ("banded", "orders_total"), "production": ("simple", "orders_simple")}


def _report_files(spark, sf):
    """Both kinds of report files, written as one folder per file and read again with the file's name."""
    both = [c.withColumn("file", F.concat(F.lit(f"{kind}_"), "file")) for kind, c in (("yield", B.cells(spark, sf)), ("production", B.cells_simple(spark, sf)))]
    stray = both[1].select(F.lit("notes.xlsx").alias("file"), "row_idx", "col_idx", "value").where("row_idx = 0")
    path = R.scratch_path(spark, "reports")
    R.write_table(both[0].unionByName(both[1]).unionByName(stray), path, partition_by=["file"])
    return R.read_files(spark, path).drop("file").withColumn("file", F.url_decode(F.regexp_replace(F.regexp_extract("file_path", "/file=([^/]+)/", 1), r"\+", "%2B"))).drop("file_name", "file_path")


@query("src_load_reports", f"""SELECT district, year, season, a.value AS orders_total, b.value AS orders_simple
    FROM ({_BANDED}) a FULL JOIN ({_SIMPLE}) b USING (district, year, season)""")
def src_load_reports(spark, sf):
    """The loader as one flow: a folder of files of two layouts, routed by file name, parsed, merged and sorted."""
    return G.load_reports(_report_files(spark, sf), _KINDS)


_STATUS_SQL = "SELECT 'yield_' || file AS file, header_row FROM ({a}) UNION ALL SELECT 'production_' || file, header_row FROM ({b})"


@query("src_load_status", f"""SELECT file, split_part(file, '_', 1) AS kind, CASE WHEN file LIKE 'yield%' THEN 'banded' ELSE 'simple' END AS layout,
    header_row, CAST(NULL AS VARCHAR) AS problem FROM ({_STATUS_SQL.format(a=W(_HDR_SQL, cells=B.CELLS_SQL), b=W(_HDR_SQL, cells=B.CELLS_SIMPLE_SQL))})
    UNION ALL SELECT 'notes.xlsx', NULL, NULL, NULL, 'No layout for notes.xlsx'""")
def src_load_status(spark, sf):
    """One row per file of that folder: its kind, layout, header row, and what is wrong with it."""
    return G.load_status(_report_files(spark, sf), _KINDS)


_POS_COLS = ", ".join(f"max(value) FILTER (WHERE col_idx = {i}) AS {n}" for n, i in G.POSITIONAL.items())
_POS = W(f"""SELECT {_parse_year_sql('year')} AS year, {_season_sql('file')} AS season,
    {', '.join(f'{_double_sql(n)} AS {n}' for n in G.POSITIONAL if n != 'year')}
    FROM (SELECT c.file, c.row_idx, {_POS_COLS} FROM cells c JOIN st USING (file) WHERE c.row_idx >= data_start GROUP BY c.file, c.row_idx)
    WHERE {_parse_year_sql('year')} IS NOT NULL""",
         cells=B.CELLS_POS_SQL,
         st=f"""SELECT file, min(row_idx) AS data_start FROM cells WHERE col_idx = 1 AND (contains({_strip('value')}, '/')
                OR (regexp_full_match({_strip('value')}, '[0-9]+') AND TRY_CAST({_strip('value')} AS BIGINT) > 1900)) GROUP BY file""")


@query("grid_positional", _POS)
def grid_positional(spark, sf):
    return G.positional(B.cells_positional(spark, sf))


@query("bind_cells_positional", B.CELLS_POS_SQL)
def bind_cells_positional(spark, sf):
    return B.cells_positional(spark, sf)


_LABELS_SQL = """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(y AS VARCHAR) || '/' || CAST(y + 1 AS VARCHAR)
    WHEN 1 THEN CAST(y AS VARCHAR) WHEN 2 THEN CAST(y AS VARCHAR) || '.0' WHEN 3 THEN 'FY ' || CAST(y AS VARCHAR)
    WHEN 4 THEN ' ' || CAST(y AS VARCHAR) || '.7 ' ELSE CAST(y AS VARCHAR) || '.0/' || CAST(y + 1 AS VARCHAR) END AS label
    FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y FROM orders)"""


@query("parse_period_label", f"SELECT o_orderkey, label, {_parse_year_sql('label')} AS year FROM ({_LABELS_SQL})")
def parse_period_label(spark, sf):
    o = B.table(spark, sf, "orders")
    y = F.year("o_orderdate").cast("string")
    y1 = (F.year("o_orderdate") + 1).cast("string")
    k = F.col("o_orderkey") % 6
    lab = (F.when(k == 0, F.concat(y, F.lit("/"), y1)).when(k == 1, y).when(k == 2, F.concat(y, F.lit(".0")))
           .when(k == 3, F.concat(F.lit("FY "), y)).when(k == 4, F.concat(F.lit(" "), y, F.lit(".7 ")))
           .otherwise(F.concat(y, F.lit(".0/"), y1)))
    return o.select("o_orderkey", lab.alias("label")).withColumn("year", S.parse_period_label("label"))


_KEYS_SQL = """SELECT n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE ' ' || lower(n_name) || ' ' END AS label FROM nation
    UNION ALL SELECT 100 + n_nationkey, CASE n_nationkey WHEN 0 THEN ' total ' WHEN 1 THEN 'Sri Lanka' WHEN 2 THEN 'note'
    WHEN 3 THEN '' WHEN 4 THEN NULL ELSE 'All Districts' END FROM nation WHERE n_nationkey < 6"""


@query("drop_summary_rows", f"""SELECT id, label, upper({_strip('label')}) AS district FROM ({_KEYS_SQL})
    WHERE label IS NOT NULL AND upper({_strip('label')}) <> '' AND upper({_strip('label')}) NOT IN ({SUMMARY_SQL})""")
def drop_summary_rows(spark, sf):
    n = B.table(spark, sf, "nation")
    a = n.select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))
                 .otherwise(F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).alias("label"))
    k = F.col("n_nationkey")
    inj = n.where(k < 6).select((k + 100).alias("id"), F.when(k == 0, " total ").when(k == 1, "Sri Lanka").when(k == 2, "note")
                                 .when(k == 3, "").when(k == 4, F.lit(None).cast("string")).otherwise("All Districts").alias("label"))
    return G.drop_summary_rows(a.unionByName(inj), "label").withColumn("district", S.norm_key("label"))
