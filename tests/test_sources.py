"""Sources and report-grid parsing on hand-made cell tables (the layouts of
the reference's spreadsheets)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from panelkit.sources import grid as G
from panelkit.sources import readers as R


def _cells(spark, file, grid):
    rows = [(file, r, c, v) for r, line in enumerate(grid) for c, v in enumerate(line) if v is not None]
    return spark.createDataFrame(rows, "file string, row_idx int, col_idx int, value string")


BANDED = [
    [None], [None],
    [None, "District", "1978/1979", None, None, None, "1979/1980", None, None, None],
    [None, None, "Major", "Minor", "Rainfed", "Total", "Major", "Minor", "Rainfed", "Total"],
    [None, "Alpha", "1", "2", "3", "6", "10", "20", "30", "60"],
    [None, "TOTAL", "1", "2", "3", "6", "10", "20", "30", "60"],
    [None, " beta ", "x", None, None, None, None, None, None, "7.5"],
]


def test_banded_like_reference(spark):
    out = sorted(tuple(r) for r in G.unpivot_banded(_cells(spark, "yield_maha_2020.xlsx", BANDED)).collect())
    assert out == [("ALPHA", 1978, "Maha", 6.0), ("ALPHA", 1979, "Maha", 60.0),
                   ("BETA", 1978, "Maha", None), ("BETA", 1979, "Maha", 7.5)]


def test_simple_layout_year_gate(spark):
    grid = [[None, "District", "1995", "1890", "2000/2001", "note"], [None, "Gamma", "1", "2", "3", "4"]]
    out = sorted(tuple(r) for r in G.unpivot_simple(_cells(spark, "sown_yala.xlsx", grid)).collect())
    assert out == [("GAMMA", 1995, "Yala", 1.0), ("GAMMA", 2000, "Yala", 3.0)]


def test_positional_layout(spark):
    grid = [["t"], [None, "Year"], [None, "1951/52", None, "1", None, "2", None, "3", None, "4"],
            [None, "1952", None, "5", None, "6", None, "7", None, "8"], [None, "Source"]]
    out = sorted(tuple(r) for r in G.positional(_cells(spark, "national_maha.xlsx", grid)).collect())
    assert out == [(1951, "Maha", 1.0, 2.0, 3.0, 4.0), (1952, "Maha", 5.0, 6.0, 7.0, 8.0)]


def test_missing_header_raises_with_file(spark):
    cells = _cells(spark, "nohdr.xlsx", [["a", "b"]]).unionByName(_cells(spark, "some_yield_maha.xlsx", [["District", "2001"], ["x", "4"]]))
    rows = G.header_rows(cells)  # nothing runs while the plan is built
    with pytest.raises(Exception, match="Cannot find 'district' header row in nohdr.xlsx"):
        rows.collect()
    assert [r.file for r in G.header_rows(cells, strict=False).collect()] == ["some_yield_maha.xlsx"]
    kinds = {"yield": ("simple", "t")}
    status = {r.file: (r.kind, r.layout, r.header_row, r.problem) for r in G.load_status(cells, kinds).collect()}
    assert status == {"nohdr.xlsx": (None, None, None, "No layout for nohdr.xlsx"), "some_yield_maha.xlsx": ("yield", "simple", 0, None)}
    assert [tuple(r) for r in G.load_reports(cells, kinds).collect()] == [("X", 2001, "Maha", 4.0)]


def test_banded_labels_fill_to_the_right(spark):
    grid = [["title"], [None, " District ", "2001/02", None, "nan", "2003"], [None, None, "Major", "Total", "total", " TOTAL "],
            [None, "kandy", "1", "2", "3", "x"], [None, "total", "1", "2", "3", "4"], [None, " galle ", None, None, "7", "8"]]
    c = _cells(spark, "yield_yala.xlsx", grid)
    assert sorted(map(tuple, G.header_fill(c).collect())) == [("yield_yala.xlsx", 3, "2001/02"), ("yield_yala.xlsx", 4, "2001/02"), ("yield_yala.xlsx", 5, "2003")]
    got = sorted(map(tuple, G.unpivot_banded(c).collect()), key=str)
    assert got == sorted([("KANDY", 2001, "Yala", 2.0), ("KANDY", 2001, "Yala", 3.0), ("KANDY", 2003, "Yala", None),
                          ("GALLE", 2001, "Yala", None), ("GALLE", 2001, "Yala", 7.0), ("GALLE", 2003, "Yala", 8.0)], key=str)


def test_missing_inputs(spark, tmp_path):
    assert R.read_optional(spark, str(tmp_path / "absent.parquet")) is None
    with pytest.raises(FileNotFoundError):
        R.read_passthrough(spark, str(tmp_path / "absent.parquet"))
    assert R.read_passthrough(spark, str(tmp_path / "absent.parquet"), required=False) is None


def test_rename_coerce(spark):
    df = spark.createDataFrame([("1950", " maha\\t", "1,2", "3.5")], "`Year_New` string, `Season` string, `GDP B$` string, `Rainfall(mm)` string")
    out = R.rename_coerce(df, R.PRIMARY_HEADERS, strict_int=["year"], labels=["season"],
                          lenient=["gdp_billion_usd", "rainfall_mm"]).first()
    assert (out.year, out.gdp_billion_usd, out.rainfall_mm) == (1950, None, 3.5)


def test_season_partitioned_sink_prunes(spark):
    from panelkit.plans import bindings as B
    from panelkit.plans.registry import rounded

    p = rounded(B.panel(spark, SF_SMALL))
    path = R.scratch_path(spark, "pruning-test")
    R.write_table(p, path, partition_by=["season"])
    back = spark.read.parquet(path)
    h1 = back.where(F.col("season") == "H1")
    plan = h1._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "(season#" in plan
    assert h1.count() == p.where(F.col("season") == "H1").count()
    assert back.count() == p.count()
