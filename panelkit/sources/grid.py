"""Relational reshaping of report-style grids given as long cell tables
``(file, row_idx, col_idx, value string)`` - many files at once, keyed by
``file``.

Scale notes: one aggregate over each file's first rows gives its layout - header row, header cells and sub-header cells as sorted
arrays, one row per file, bounded by the width of a sheet.  Body cells are grouped once by (file, row), which spreads a file that
holds a large share of them, and meet the layouts in one join on the file, whose strategy is the planner's choice.  Nothing
is persisted, hinted or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.joins import outer_merge
from ..sources.readers import route_path

KEY_LABEL = "district"
SUB_TOTAL = "total"


def _low(c="value"):
    return F.lower(S.strip(F.col(c) if isinstance(c, str) else c))


SCAN_ROWS = 10


def layouts(cells: DataFrame, label: str = KEY_LABEL, scan_rows: int = SCAN_ROWS) -> DataFrame:
    """(file, header_row, header, sub), one row per file: the first row among the first ``scan_rows`` with a cell equal to ``label``
    (trimmed, case-insensitive; NULL where there is none), its cells and those of the row below as arrays of (col_idx, value)
    in column order."""
    top = (F.col("row_idx") < scan_rows + 2) & F.col("value").isNotNull()
    g = cells.groupBy("file").agg(
        F.min(F.when((F.col("row_idx") < scan_rows) & (_low() == label), F.col("row_idx"))).alias("header_row"),
        F.sort_array(F.collect_list(F.when(top, F.struct("col_idx", "row_idx", "value")))).alias("region"))

    def row(offset):
        return F.transform(F.filter("region", lambda c: c.row_idx == F.col("header_row") + offset),
                           lambda c: F.struct(c.col_idx.alias("col_idx"), c.value.alias("value")))

    return g.select("file", "header_row", row(0).alias("header"), row(1).alias("sub"))


def _problem(label: str):
    return F.concat(F.lit(f"Cannot find '{label}' header row in "), F.col("file"))


def file_status(cells: DataFrame, label: str = KEY_LABEL, scan_rows: int = SCAN_ROWS) -> DataFrame:
    """(file, header_row, problem) for every file; ``problem`` names a file without a header row."""
    return layouts(cells, label, scan_rows).select("file", "header_row", F.when(F.col("header_row").isNull(), _problem(label)).alias("problem"))


def _found(lay: DataFrame, strict: bool, label: str = KEY_LABEL) -> DataFrame:
    """Layouts with a header row.  With ``strict`` a file without one fails the action that reads its row, naming the file."""
    if not strict:
        return lay.where(F.col("header_row").isNotNull())
    return lay.withColumn("header_row", F.coalesce("header_row", F.raise_error(_problem(label)).cast("int")))


def header_rows(cells: DataFrame, label: str = KEY_LABEL, scan_rows: int = SCAN_ROWS, strict: bool = True) -> DataFrame:
    """(file, header_row); see :func:`layouts` and :func:`_found`."""
    return _found(layouts(cells, label, scan_rows), strict, label).select("file", "header_row")


def _key_col(label: str = KEY_LABEL, last: bool = False, default: int = 1):
    cols = F.transform(F.filter("header", lambda c: _low(c.value) == label), lambda c: c.col_idx)
    return F.coalesce(F.array_max(cols) if last else F.array_min(cols), F.lit(default))


def key_columns(cells: DataFrame, label: str = KEY_LABEL, last: bool = False, default: int = 1, strict: bool = True) -> DataFrame:
    """(file, key_col): first (or last) header-row column whose cell equals ``label``; ``default`` when there is none."""
    return _found(layouts(cells, label), strict, label).select("file", _key_col(label, last, default).alias("key_col"))


def _filled(sub_label: str = SUB_TOTAL, label: str = KEY_LABEL):
    """Array of (col_idx, period_label): sub-header cells equal to ``sub_label`` with the nearest usable header cell at or left of them
    (empty, 'nan' and the key label are skipped)."""
    usable = F.filter("header", lambda c: ~_low(c.value).isin("nan", label))

    def fill(c):
        left = F.filter(F.col("usable"), lambda h: h.col_idx <= c.col_idx)
        return F.struct(c.col_idx.alias("col_idx"), S.strip(F.get(left, F.size(left) - 1).value).alias("period_label"))

    return usable, F.transform(F.filter("sub", lambda c: _low(c.value) == sub_label), fill)


def header_fill(cells: DataFrame, sub_label: str = SUB_TOTAL, label: str = KEY_LABEL, strict: bool = True) -> DataFrame:
    """(file, col_idx, period_label) for every sub-header cell equal to ``sub_label``."""
    usable, filled = _filled(sub_label, label)
    lay = _found(layouts(cells, label), strict, label).withColumn("usable", usable)
    return lay.select("file", F.explode(filled).alias("c")).select("file", "c.*")


def _file_season(file_col="file"):
    return route_path(file_col)["season"]


def _value_at(col):
    return F.get(F.filter("cells", lambda c: c.col_idx == col), 0).value


def _emit(cells: DataFrame, lay: DataFrame, value_label: str) -> DataFrame:
    """(district, year, season, value) for every body row with a usable key and every year column of its file (``lay``: file, data_start,
    key_col, years); a missing cell gives NULL, as an empty spreadsheet cell would."""
    rows = cells.groupBy("file", "row_idx").agg(F.collect_list(F.struct("col_idx", "value")).alias("cells"))  # at most a sheet's width
    body = rows.join(lay, "file").where(F.col("row_idx") >= F.col("data_start")).withColumn("district", S.norm_key(_value_at(F.col("key_col"))))
    body = body.where(F.col("district").isNotNull() & (F.col("district") != "") & ~F.col("district").isin(*S.SUMMARY_LABELS))
    picks = F.transform("years", lambda y: F.struct(y.year.alias("year"), _value_at(y.col_idx).alias("v")))
    return body.select("district", "file", F.explode(picks).alias("p")).select(
        "district", "p.year", _file_season().alias("season"), S.to_double("p.v").alias(value_label))


def unpivot_banded(cells: DataFrame, value_label: str = "value", strict: bool = True) -> DataFrame:
    """Banded layout: header row with period labels over groups of
    sub-columns, sub-header row naming them; only the ``total`` sub-columns
    are kept.  Emits (district, year, season, value)."""
    usable, filled = _filled()
    lay = _found(layouts(cells), strict).withColumn("usable", usable)
    years = F.filter(F.transform(filled, lambda c: F.struct(c.col_idx.alias("col_idx"), S.parse_period_label(c.period_label).alias("year"))),
                     lambda c: c.year.isNotNull())
    lay = lay.select("file", (F.col("header_row") + 2).alias("data_start"), _key_col().alias("key_col"), years.alias("years"))
    return _emit(cells, lay, value_label)


def unpivot_simple(cells: DataFrame, value_label: str = "value", lo: int = 1900, hi: int = 2100, strict: bool = True) -> DataFrame:
    """Simple layout: one column per period in the header row, kept when
    lo < year < hi; key column = the last header cell equal to ``district``."""
    years = F.transform(F.filter("header", lambda c: _low(c.value) != KEY_LABEL),
                        lambda c: F.struct(c.col_idx.alias("col_idx"), S.parse_period_label(c.value).alias("year")))
    years = F.filter(years, lambda c: (c.year > lo) & (c.year < hi))
    lay = _found(layouts(cells), strict).select(
        "file", (F.col("header_row") + 1).alias("data_start"), _key_col(last=True).alias("key_col"), years.alias("years"))
    return _emit(cells, lay, value_label)


#: Layouts by name, for :func:`load_reports`.
PARSERS = {"banded": unpivot_banded, "simple": unpivot_simple}


def load_reports(cells: DataFrame, kinds: dict, route: str = "metric_route", strict: bool = True) -> DataFrame:
    """A folder of report files as one sorted table (year, season, district order): every file goes by its name to a kind, every kind
    ``{route value: (layout, measure)}`` is parsed by its layout, and the measures are merged on (district, year, season), keeping
    rows that only one kind has.  Files of no kind are left out (``load_status`` lists them)."""
    routed = cells.withColumn("__route", route_path("file")[route])
    out = None
    for value, (layout, measure) in kinds.items():
        part = PARSERS[layout](routed.where(F.col("__route") == value).drop("__route"), measure, strict=strict)
        out = part if out is None else outer_merge(out, part, ["district", "year", "season"])
    return out.orderBy("year", "season", "district")


def load_status(cells: DataFrame, kinds: dict, route: str = "metric_route") -> DataFrame:
    """(file, kind, layout, header_row, problem) for every file of a folder: a file without a kind or a header row has a problem."""
    status = file_status(cells).withColumn("kind", route_path("file")[route])
    layout = F.coalesce(*[F.when(F.col("kind") == k, F.lit(name)) for k, (name, _) in kinds.items()])
    none = F.when(layout.isNull(), F.concat(F.lit("No layout for "), F.col("file")))
    return status.select("file", "kind", layout.alias("layout"), "header_row", F.coalesce(none, "problem").alias("problem"))


# Positional layout columns (year label, then four measures).
POSITIONAL = {"year": 1, "sown_000_ha": 3, "harvested_000_ha": 5, "avg_yield_kg_per_ha": 7, "production_000_mt": 9}


def positional(cells: DataFrame, columns: dict = POSITIONAL, min_year: int = 1900) -> DataFrame:
    """Fixed-position layout: data starts at the first row whose year cell
    contains '/' or is all digits > ``min_year``; rows whose year label does
    not parse are skipped.  Emits (year, season, measures...)."""
    g = cells.where(F.col("col_idx").isin(*columns.values())).groupBy("file", "row_idx").agg(
        *[F.max(F.when(F.col("col_idx") == idx, F.col("value"))).alias(name) for name, idx in columns.items()])
    sv = S.strip("year")
    is_start = sv.contains("/") | (S.is_digits(sv) & (sv.try_cast("long") > min_year))
    starts = g.groupBy("file").agg(F.min(F.when(is_start, F.col("row_idx"))).alias("data_start"))
    g = g.join(starts, "file").where(F.col("row_idx") >= F.col("data_start"))
    out = g.select(
        S.parse_period_label(F.col("year")).alias("year"), _file_season().alias("season"),
        *[S.to_double(F.col(n)).alias(n) for n in columns if n != "year"])
    return out.where(F.col("year").isNotNull())


def drop_summary_rows(df: DataFrame, key: str) -> DataFrame:
    """Drop blank / missing keys and summary labels (after trim + upper)."""
    k = S.norm_key(key)
    return df.where(F.col(key).isNotNull() & (k != "") & ~k.isin(*S.SUMMARY_LABELS))
