"""Quantiles along the digits of doubles, carries of several columns, and wide frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import quantiles as QT
from panelkit.operators import sequence as SQ

ODD = [0.0, -0.0, 1.0, 2.0, 4.0, 0.1, 1e-9, -1e-9, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.0**52, 2.0**52 + 1,
       1 - 2.0**-53, 1 + 2.0**-52, 3.0, float("inf"), float("-inf"), 2.2250738585072014e-308, 1e300, -7.5]


def test_digits_follow_the_order_of_values(spark):
    df = spark.createDataFrame([(v,) for v in ODD], "value double")
    first, second = QT._digits(F.col("value"))
    rows = df.select("value", first.alias("a"), second.alias("b")).collect()
    for p in rows:
        for q in rows:
            if p.value < q.value:
                assert (p.a, p.b) <= (q.a, q.b), (p, q)
    exact = {r.value: r for r in rows}
    assert exact[1.0].a - exact[1 - 2.0**-53].a == 1 and abs(exact[-7.5].a) == (2 + 1075) * 512 + int(0.875 * 512)


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.9, 1.0]])
def test_small_magnitudes_beside_a_large_one(spark, probs):
    """Values around 1e-9 with one 5e-3: no bucket of a pass holds them all."""
    rng = np.random.default_rng(0)
    x = np.append(rng.normal(1e-9, 1e-10, 20_000), 5e-3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    got = {r.p: r.value for r in QT.quantiles(df, ["x"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p), rel=1e-14)
    first, _ = QT._digits(F.col("x"))
    most = df.groupBy(first.alias("a")).count().agg(F.max("count")).first()[0]
    assert most < 200


def test_quantiles_of_ties_groups_and_signs(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v)) for g in "ab" for v in np.round(rng.normal(0, 3, 400), 1)] + [("c", 4.0)] * 3 + [("d", None), ("d", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.p): r.value for r in QT.quantiles(df, ["x"], [0.1, 0.5, 0.77], by=["g"]).collect()}
    assert len(got) == 9
    for (g, p), v in got.items():
        assert v == pytest.approx(np.quantile([x for h, x in rows if h == g], p), rel=1e-14)


@pytest.mark.parametrize("block", [3, 7, 1 << 20])
def test_carries_of_several_columns_and_wide_frames(spark, block):
    rng = np.random.default_rng(2)
    rows = []
    for s in ("a", "b", None):
        for i in range(23):
            rows.append((s, i, *[None if rng.random() < 0.6 else float(rng.integers(0, 9)) for _ in range(2)]))
    df = spark.createDataFrame(rows, "s string, i int, u double, v double").repartition(3)
    seq = SQ.sequenced(df, ["s"], ["i"], block_rows=block)
    out = SQ.add_lookback(seq, ["s"], lags={"u1": ("u", 1)}, rolls={"r9": ("u", 9), "r2": ("v", 2)}, block_rows=block)
    out = SQ.finish(SQ.add_backfill(out, ["s"], {"bu": "u", "bv": "v"}))
    got = {(r.s, r.i): r for r in out.collect()}
    assert len(got) == len(rows)
    mean = lambda x: sum(x) / len(x) if x else None
    for s in ("a", "b", None):
        mine = sorted(r[1:] for r in rows if r[0] == s)
        for i, u, v in mine:
            r = got[s, i]
            assert r.u1 == (mine[i - 1][1] if i else None)
            assert r.bu == next((x[1] for x in mine[i:] if x[1] is not None), None)
            assert r.bv == next((x[2] for x in mine[i:] if x[2] is not None), None)
            for value, at, w in ((r.r9, 1, 9), (r.r2, 2, 2)):
                want = mean([x[at] for x in mine[max(0, i - w + 1):i + 1] if x[at] is not None])
                assert (value is None) == (want is None) and (want is None or value == pytest.approx(want))
