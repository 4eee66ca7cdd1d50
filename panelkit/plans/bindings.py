"""Derived inputs built from the driver tables, each with an SQL twin.

* ``panel``  - seasonal panel keyed by (series = customer nation, year, month),
  season 'H1'/'H2', seven measures aggregated from lineitem.
* ``half``   - the same measures at national grain (year, season).
* ``holes``  - lineitem with NULLs injected by rule (for imputation/missing ops).
* ``cells``  - orders counted by nation x year laid out as a report grid, as a
  long cell table ``(file, row_idx, col_idx, value)``.

Scale notes for ``panel``/``half``: lineitem is pre-aggregated per order key
before the join (map-side partial aggregation, one shuffle keyed on the order
key), so the order join moves one row per order instead of ~4 lines.  The
aggregate output is hash-partitioned by the order key, so the sort-merge join
with orders only shuffles orders.  The customer join is left to the planner:
broadcast when its statistics are under the threshold, sort-merge otherwise,
with AQE splitting a skewed customer key.  All sums go through DECIMAL so the
result is exact and independent of partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

D = "decimal(18,2)"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(c: str) -> F.Column:
    """The value rounded to 2 decimals as DECIMAL(18,2) (half-up), as an
    exact count of hundredths in a long."""
    return (F.col(c).cast(D) * 100).cast("long")


def _lines_per_order(lineitem: DataFrame) -> DataFrame:
    """Exact per-order sums in fixed-point longs: q, hq, tx, px, dc in
    hundredths, rv = price x (1 - discount) in ten-thousandths.  Summing longs
    keeps this lineitem-sized pass on the fast primitive path; a DECIMAL sum
    would widen past 18 digits and aggregate through BigDecimal."""
    q, px, dc = _cents("l_quantity"), _cents("l_extendedprice"), _cents("l_discount")
    return lineitem.groupBy(F.col("l_orderkey").alias("o_key")).agg(
        F.sum(q).alias("q"),
        F.sum(F.when(F.col("l_returnflag") != "R", q).otherwise(F.lit(0).cast("long"))).alias("hq"),
        F.sum(_cents("l_tax")).alias("tx"),
        F.sum(px).alias("px"),
        F.sum(dc).alias("dc"),
        F.sum(px * (F.lit(100) - dc)).alias("rv"),
        F.count(F.lit(1)).alias("n"),
    )


def _exact(c: str, scale: float) -> F.Column:
    """Group sum of a per-order fixed-point column: summed as DECIMAL(38,0)
    (no overflow at any scale), then divided once - the nearest double to the
    exact decimal sum."""
    return F.sum(F.col(c).cast("decimal(38,0)")).cast("double") / F.lit(scale)


def _measures(grouped) -> DataFrame:
    n = F.sum("n")
    return grouped.agg(
        _exact("q", 100.0).alias("sown"),
        _exact("hq", 100.0).alias("harvested"),
        (_exact("tx", 100.0) * 100).alias("rainfall"),
        (_exact("q", 100.0) / n).alias("temperature"),
        (_exact("px", 100.0) / n).alias("gdp"),
        (_exact("dc", 100.0) * 100 / n).alias("inflation"),
        (_exact("rv", 10000.0) / 1000).alias("production"),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    per_order = _lines_per_order(li)
    joined = per_order.join(orders, per_order.o_key == orders.o_orderkey)
    return joined.select(
        "o_custkey",
        F.year("o_orderdate").cast("int").alias("year"),
        F.month("o_orderdate").cast("int").alias("month"),
        "q", "hq", "tx", "px", "dc", "rv", "n",
    )


def _season(month_col) -> F.Column:
    return F.when(month_col <= 6, F.lit("H1")).otherwise(F.lit("H2"))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _order_lines(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = lines.join(cust, lines.o_custkey == cust.c_custkey)
    g = j.groupBy(
        F.col("c_nationkey").alias("series"), "year", "month", _season(F.col("month")).alias("season")
    )
    return _measures(g)


def half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National grain: no customer join needed."""
    lines = _order_lines(spark, sf_dir)
    return _measures(lines.groupBy("year", _season(F.col("month")).alias("season")))


def holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn(
        "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")),
    ).withColumn(
        "l_quantity",
        F.when(F.col("l_orderkey") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")),
    )


# Measures that panel_dirty blanks: column -> (modulus, what it becomes).
_DIRT = {"rainfall": (6, None), "temperature": (9, "nan"), "gdp": (8, None), "inflation": (7, "nan"), "sown": (10, None)}


def panel_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``panel`` as it might be delivered: every fifth key comes twice (the
    later row, seq 1, with other values), and by rule measures are NULL or NaN."""
    p = panel(spark, sf_dir)
    again = p.where((F.col("series") + F.col("year") + F.col("month")) % 5 == 0)
    again = again.withColumns({"production": F.col("production") - 1, "harvested": F.col("harvested") / 2})
    both = p.withColumn("seq", F.lit(0)).unionByName(again.withColumn("seq", F.lit(1)))
    k = F.col("series") * 7 + F.col("year") + F.col("month")
    return both.withColumns({
        c: F.when(k % m == 0, F.lit(v).cast("double")).otherwise(F.col(c)) for c, (m, v) in _DIRT.items()})


# Report grid layout (fixed values of the banded layout): header row index 2,
# sub-header row 3, body from row 4; key column 1; four sub-columns per year.
GRID_HEADER_ROW = 2
GRID_KEY_COL = 1
GRID_SUBS = ("Major", "Minor", "Rainfed", "Total")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted by (region, nation, year) laid out as banded report grids.

    One "file" per region (``region_<name>_maha.xlsx`` for even region keys,
    ``..._yala.xlsx`` for odd ones).  Sub-columns Major/Minor/Rainfed count
    orders with priority 1-URGENT/2-HIGH/other; Total is all orders.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    counts = (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .groupBy("c_nationkey", F.year("o_orderdate").cast("int").alias("yr"))
        .agg(
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("c0"),
            F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("c1"),
            F.count_if(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("c2"),
            F.count(F.lit(1)).alias("c3"),
        )
    )
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(
            F.lit("region_"), F.lower(F.col("r_name")),
            F.when(F.col("r_regionkey") % 2 == 0, F.lit("_maha")).otherwise(F.lit("_yala")), F.lit(".xlsx"),
        ).alias("file"),
        "n_nationkey", "n_name", "r_regionkey",
    )
    body = counts.join(geo, counts.c_nationkey == geo.n_nationkey)
    # position of the year within its file: dense rank of years per file
    years = body.select("file", "yr").distinct()
    yidx = years.withColumn(
        "ypos", F.expr("dense_rank() OVER (PARTITION BY file ORDER BY yr)").cast("int") - 1
    )
    # row position of the nation within its file
    nrow = body.select("file", "n_name").distinct().withColumn(
        "npos", F.expr("dense_rank() OVER (PARTITION BY file ORDER BY n_name)").cast("int") - 1
    )
    files = body.select("file").distinct()
    body_rows = body.join(yidx, ["file", "yr"]).join(nrow, ["file", "n_name"])
    vals = body_rows.select(
        "file", (F.col("npos") + GRID_HEADER_ROW + 2).alias("row_idx"), "ypos",
        F.posexplode(F.array("c0", "c1", "c2", "c3")).alias("sub", "v"),
    ).select(
        "file", "row_idx", (F.col("ypos") * 4 + F.col("sub") + 2).alias("col_idx"), F.col("v").cast("string").alias("value")
    )
    keys = nrow.select("file", (F.col("npos") + GRID_HEADER_ROW + 2).alias("row_idx"),
                       F.lit(GRID_KEY_COL).alias("col_idx"), F.col("n_name").alias("value"))
    year_hdr = yidx.select(
        "file", F.lit(GRID_HEADER_ROW).alias("row_idx"), (F.col("ypos") * 4 + 2).alias("col_idx"),
        F.concat(F.col("yr").cast("string"), F.lit("/"), (F.col("yr") + 1).cast("string")).alias("value"),
    )
    key_hdr = files.select("file", F.lit(GRID_HEADER_ROW).alias("row_idx"), F.lit(GRID_KEY_COL).alias("col_idx"),
                           F.lit("District").alias("value"))
    subs = F.array(*[F.lit(s) for s in GRID_SUBS])
    sub_hdr = yidx.select("file", F.lit(GRID_HEADER_ROW + 1).alias("row_idx"), "ypos",
                          F.posexplode(subs).alias("sub", "value")).select(
        "file", "row_idx", (F.col("ypos") * 4 + F.col("sub") + 2).alias("col_idx"), "value")
    # one injected TOTAL row per file after the body (sum over the file's nations)
    last = nrow.groupBy("file").agg(F.max("npos").alias("mx"))
    tot = (
        body_rows.groupBy("file", "ypos")
        .agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"), F.sum("c2").alias("c2"), F.sum("c3").alias("c3"))
        .join(last, "file")
    )
    tot_vals = tot.select(
        "file", (F.col("mx") + GRID_HEADER_ROW + 3).alias("row_idx"), "ypos",
        F.posexplode(F.array("c0", "c1", "c2", "c3")).alias("sub", "v"),
    ).select("file", "row_idx", (F.col("ypos") * 4 + F.col("sub") + 2).alias("col_idx"),
             F.col("v").cast("string").alias("value"))
    tot_key = last.select("file", (F.col("mx") + GRID_HEADER_ROW + 3).alias("row_idx"),
                          F.lit(GRID_KEY_COL).alias("col_idx"), F.lit("TOTAL").alias("value"))
    parts = [vals, keys, year_hdr, key_hdr, sub_hdr, tot_vals, tot_key]
    out = reduce(lambda a, b: a.unionByName(b), [p.select("file", "row_idx", "col_idx", "value") for p in parts])
    return out.select("file", F.col("row_idx").cast("int"), F.col("col_idx").cast("int"), "value")


def cells_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by (region, nation, year) as simple report grids: a title, a
    header row 'District' + one plain year per column (and two columns that
    hold no year), one row per nation, a TOTAL row of blanks.  Nations without orders in a year have no cell."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    counts = orders.join(cust, orders.o_custkey == cust.c_custkey).groupBy(
        "c_nationkey", F.year("o_orderdate").cast("int").alias("yr")).agg(F.count(F.lit(1)).cast("string").alias("n"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", F.concat(F.lit("simple_"), F.lower("r_name"),
                                          F.when(F.col("r_regionkey") % 2 == 0, "_yala").otherwise("_maha"), F.lit(".xlsx")).alias("file"))
    body = counts.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))

    def cell(r, c, v):
        return F.struct(F.lit(r).cast("int").alias("row_idx") if isinstance(r, int) else r.cast("int").alias("row_idx"),
                        F.lit(c).cast("int").alias("col_idx") if isinstance(c, int) else c.cast("int").alias("col_idx"),
                        F.lit(v).alias("value") if isinstance(v, str) else v.cast("string").alias("value"))

    row = F.col("n_nationkey") + 2
    per_value = body.select("file", cell(row, F.col("yr") - 1980, F.col("n")).alias("c"))
    per_year = body.select("file", "yr").distinct().select("file", cell(1, F.col("yr") - 1980, F.col("yr")).alias("c"))
    per_nation = geo.select("file", cell(row, 1, F.col("n_name")).alias("c"))
    per_file = geo.select("file").distinct().select("file", F.explode(F.array(
        cell(0, 0, "Orders"), cell(1, 1, "District"), cell(1, 500, "Total"), cell(1, 501, "1850"), cell(90, 1, "TOTAL"))).alias("c"))
    return reduce(lambda a, b: a.unionByName(b), [per_value, per_year, per_nation, per_file]).select("file", "c.*")


CELLS_SIMPLE_SQL = """
WITH geo AS (SELECT n_nationkey, n_name, 'simple_' || lower(r_name) || CASE WHEN r_regionkey % 2 = 0 THEN '_yala' ELSE '_maha' END || '.xlsx' AS file
             FROM nation JOIN region ON n_regionkey = r_regionkey),
body AS (SELECT file, n_nationkey, CAST(year(o_orderdate) AS INT) AS yr, COUNT(*) AS n
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)
SELECT file, CAST(n_nationkey + 2 AS INT) AS row_idx, CAST(yr - 1980 AS INT) AS col_idx, CAST(n AS VARCHAR) AS value FROM body
UNION ALL SELECT DISTINCT file, 1, CAST(yr - 1980 AS INT), CAST(yr AS VARCHAR) FROM body
UNION ALL SELECT file, CAST(n_nationkey + 2 AS INT), 1, n_name FROM geo
UNION ALL SELECT DISTINCT file, 0, 0, 'Orders' FROM geo
UNION ALL SELECT DISTINCT file, 1, 1, 'District' FROM geo
UNION ALL SELECT DISTINCT file, 1, 500, 'Total' FROM geo
UNION ALL SELECT DISTINCT file, 1, 501, '1850' FROM geo
UNION ALL SELECT DISTINCT file, 90, 1, 'TOTAL' FROM geo"""


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect; the driver pre-registers the tables as views)
# ---------------------------------------------------------------------------

_MEASURES_SQL = """
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sown,
       CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS harvested,
       CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) * 100 AS rainfall,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS temperature,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS gdp,
       CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 100 / COUNT(*) AS inflation,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) / 1000 AS production"""

PANEL_SQL = f"""
SELECT c_nationkey AS series, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS season,{_MEASURES_SQL}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2, 3, 4"""

DIRTY_SQL = f"""WITH p AS ({PANEL_SQL}),
b AS (SELECT *, 0 AS seq FROM p UNION ALL
      SELECT * REPLACE (production - 1 AS production, harvested / 2 AS harvested), 1 FROM p WHERE (series + year + month) % 5 = 0)
SELECT * REPLACE ({", ".join(
    f"CASE WHEN (series * 7 + year + month) % {m} = 0 THEN CAST({'NULL' if v is None else repr(v)} AS DOUBLE) ELSE {c} END AS {c}"
    for c, (m, v) in _DIRT.items())}) FROM b"""

HALF_SQL = f"""
SELECT CAST(year(o_orderdate) AS INT) AS year,
       CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS season,{_MEASURES_SQL}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2"""

HOLES_SQL = """
SELECT * REPLACE (
         CASE WHEN l_orderkey % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice END AS l_extendedprice,
         CASE WHEN l_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE l_quantity END AS l_quantity)
FROM lineitem"""

CELLS_SQL = """
WITH counts AS (
  SELECT c_nationkey, CAST(year(o_orderdate) AS INT) AS yr,
         COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS c0,
         COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS c1,
         COUNT(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS c2,
         COUNT(*) AS c3
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
geo AS (
  SELECT 'region_' || lower(r_name) || CASE WHEN r_regionkey % 2 = 0 THEN '_maha' ELSE '_yala' END || '.xlsx' AS file,
         n_nationkey, n_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
body AS (SELECT * FROM counts JOIN geo ON c_nationkey = n_nationkey),
yidx AS (SELECT file, yr, CAST(dense_rank() OVER (PARTITION BY file ORDER BY yr) AS INT) - 1 AS ypos
         FROM (SELECT DISTINCT file, yr FROM body)),
nrow AS (SELECT file, n_name, CAST(dense_rank() OVER (PARTITION BY file ORDER BY n_name) AS INT) - 1 AS npos
         FROM (SELECT DISTINCT file, n_name FROM body)),
br AS (SELECT b.*, ypos, npos FROM body b JOIN yidx USING (file, yr) JOIN nrow USING (file, n_name)),
last AS (SELECT file, max(npos) AS mx FROM nrow GROUP BY file),
tot AS (SELECT file, ypos, sum(c0) AS c0, sum(c1) AS c1, sum(c2) AS c2, sum(c3) AS c3 FROM br GROUP BY file, ypos),
subs AS (SELECT * FROM (VALUES (0, 'Major'), (1, 'Minor'), (2, 'Rainfed'), (3, 'Total')) t(sub, label)),
cells AS (
  SELECT file, npos + 4 AS row_idx, ypos * 4 + sub + 2 AS col_idx,
         CAST(CASE sub WHEN 0 THEN c0 WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE c3 END AS VARCHAR) AS value
  FROM br, subs
  UNION ALL SELECT file, npos + 4, 1, n_name FROM nrow
  UNION ALL SELECT file, 2, ypos * 4 + 2, CAST(yr AS VARCHAR) || '/' || CAST(yr + 1 AS VARCHAR) FROM yidx
  UNION ALL SELECT DISTINCT file, 2, 1, 'District' FROM body
  UNION ALL SELECT file, 3, ypos * 4 + sub + 2, label FROM yidx, subs
  UNION ALL SELECT t.file, mx + 5, ypos * 4 + sub + 2,
         CAST(CASE sub WHEN 0 THEN c0 WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE c3 END AS VARCHAR)
  FROM tot t JOIN last l ON t.file = l.file, subs
  UNION ALL SELECT file, mx + 5, 1, 'TOTAL' FROM last)
SELECT file, CAST(row_idx AS INT) AS row_idx, CAST(col_idx AS INT) AS col_idx, value FROM cells"""


def with_ctes(body_sql: str, **ctes: str) -> str:
    """Prefix ``body_sql`` with named CTEs (panel=..., half=..., ...)."""
    parts = [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body_sql


def cells_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by (region, year) laid out positionally: a title row, a header
    row, one row per year with the label ``'<y>/<y+1>'`` in column 1 and four
    counts in columns 3, 5, 7, 9, and a footer note row."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    file = F.concat(F.lit("national_"), F.lower(F.col("r_name")),
                    F.when(F.col("r_regionkey") % 2 == 0, F.lit("_maha")).otherwise(F.lit("_yala")), F.lit(".xlsx"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", file.alias("file"))
    counts = (
        orders.join(cust, orders.o_custkey == cust.c_custkey).join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("file", F.year("o_orderdate").cast("int").alias("yr"))
        .agg(
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("c0"),
            F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("c1"),
            F.count_if(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("c2"),
            F.count(F.lit(1)).alias("c3"),
        )
    )
    files = counts.select("file").distinct()
    first = counts.groupBy("file").agg(F.min("yr").alias("y0"), F.max("yr").alias("y1"))
    body = counts.join(first, "file").select(
        "file", (F.col("yr") - F.col("y0") + 2).alias("row_idx"),
        F.explode(F.array(
            F.struct(F.lit(1).alias("col_idx"), F.concat(F.col("yr").cast("string"), F.lit("/"), (F.col("yr") + 1).cast("string")).alias("value")),
            F.struct(F.lit(3).alias("col_idx"), F.col("c0").cast("string").alias("value")),
            F.struct(F.lit(5).alias("col_idx"), F.col("c1").cast("string").alias("value")),
            F.struct(F.lit(7).alias("col_idx"), F.col("c2").cast("string").alias("value")),
            F.struct(F.lit(9).alias("col_idx"), F.col("c3").cast("string").alias("value")),
        )).alias("c"),
    ).select("file", "row_idx", "c.col_idx", "c.value")
    title = files.select("file", F.lit(0).alias("row_idx"), F.lit(1).alias("col_idx"), F.lit("Orders by season").alias("value"))
    head = files.select("file", F.lit(1).alias("row_idx"), F.explode(F.array(
        F.struct(F.lit(1).alias("col_idx"), F.lit("Year").alias("value")),
        F.struct(F.lit(3).alias("col_idx"), F.lit("Sown").alias("value")),
        F.struct(F.lit(9).alias("col_idx"), F.lit("Production").alias("value")),
    )).alias("c")).select("file", "row_idx", "c.col_idx", "c.value")
    foot = first.select("file", (F.col("y1") - F.col("y0") + 3).alias("row_idx"), F.lit(1).alias("col_idx"),
                        F.lit("Source: orders").alias("value"))
    out = body.unionByName(title).unionByName(head).unionByName(foot)
    return out.select("file", F.col("row_idx").cast("int"), F.col("col_idx").cast("int"), "value")


CELLS_POS_SQL = """
WITH geo AS (
  SELECT n_nationkey, 'national_' || lower(r_name) || CASE WHEN r_regionkey % 2 = 0 THEN '_maha' ELSE '_yala' END || '.xlsx' AS file
  FROM nation JOIN region ON n_regionkey = r_regionkey),
counts AS (
  SELECT file, CAST(year(o_orderdate) AS INT) AS yr,
         COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS c0,
         COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS c1,
         COUNT(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS c2,
         COUNT(*) AS c3
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey GROUP BY 1, 2),
first AS (SELECT file, min(yr) AS y0, max(yr) AS y1 FROM counts GROUP BY file),
b AS (SELECT c.*, yr - y0 + 2 AS row_idx FROM counts c JOIN first USING (file)),
cells AS (
  SELECT file, row_idx, 1 AS col_idx, CAST(yr AS VARCHAR) || '/' || CAST(yr + 1 AS VARCHAR) AS value FROM b
  UNION ALL SELECT file, row_idx, 3, CAST(c0 AS VARCHAR) FROM b
  UNION ALL SELECT file, row_idx, 5, CAST(c1 AS VARCHAR) FROM b
  UNION ALL SELECT file, row_idx, 7, CAST(c2 AS VARCHAR) FROM b
  UNION ALL SELECT file, row_idx, 9, CAST(c3 AS VARCHAR) FROM b
  UNION ALL SELECT file, 0, 1, 'Orders by season' FROM first
  UNION ALL SELECT file, 1, 1, 'Year' FROM first
  UNION ALL SELECT file, 1, 3, 'Sown' FROM first
  UNION ALL SELECT file, 1, 9, 'Production' FROM first
  UNION ALL SELECT file, y1 - y0 + 3, 1, 'Source: orders' FROM first)
SELECT file, CAST(row_idx AS INT) AS row_idx, CAST(col_idx AS INT) AS col_idx, value FROM cells"""
