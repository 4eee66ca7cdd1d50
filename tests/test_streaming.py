"""Streaming scenario scoring over files derived from the driver tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_stream_scores_every_scenario(spark, tmp_path):
    from panelkit.operators import ml as M
    from panelkit.operators import split as SP
    from panelkit.plans import bindings as B
    from panelkit.plans import flows as FL
    from panelkit.plans.catalog_model import _CUTS, _SCEN_COLS
    from panelkit.streaming.scenario_stream import start_scoring

    f = FL.features(FL.clean(B.panel(spark, SF_SMALL))).cache()
    params = SP.scale_fit(f, FL.PANEL.continuous, where=F.col("split") == "train").cache()
    model = M.ols(FL.FEATURES, "target").fit(f.where("split = 'train'"))
    scen = f.select("series", "year", "month", "season", *sorted(set(_SCEN_COLS.values())))
    src = tmp_path / "in"
    scen.where("month <= 6").write.parquet(str(src / "part1"))
    scen.where("month > 6").write.parquet(str(src / "part2"))
    q = start_scoring(spark, str(src / "*"), scen.schema, params, model, str(tmp_path / "out"),
                      str(tmp_path / "ckpt"), _SCEN_COLS, "season", "H1", _CUTS, keep=["series", "year", "month"])
    q.awaitTermination(300)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == scen.count()
    assert out.where(F.col("prediction").isNull()).count() == 0
