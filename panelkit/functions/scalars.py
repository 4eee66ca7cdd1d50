"""Scalar column expressions (all JVM-side, codegen-friendly).

Spark 4 runs with ANSI mode on, so every lenient conversion uses ``try_*``
functions and every division that may see a zero uses ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels that mark summary / note rows in report grids
# (compared after trim + upper-case).
SUMMARY_LABELS = (
    "SRI LANKA", "TOTAL", "ALL ISLAND", "ISLAND", "ISLAND TOTAL",
    "ALL DISTRICTS", "SOURCE", "NOTE", "NAN",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading/trailing whitespace of any kind (Spark ``trim`` removes spaces only)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def title(c) -> Column:
    """Capitalise each whitespace-separated word, lower-case the rest."""
    return F.initcap(_c(c))


def norm_label(c) -> Column:
    """strip + title, e.g. ``'  maha '`` -> ``'Maha'``."""
    return title(strip(c))


def norm_key(c) -> Column:
    """strip + upper, used for grid row keys."""
    return F.upper(strip(c))


def lower_contains(c, needle: str) -> Column:
    return F.lower(_c(c)).contains(needle.lower())


def is_digits(c) -> Column:
    """True when non-empty and every character is a decimal digit."""
    return _c(c).rlike(r"^[0-9]+$")


def to_double(c) -> Column:
    """Lenient text/number -> double; unparseable and NaN become NULL."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def no_nan(c) -> Column:
    """A float or double column with NaN as NULL (both mean missing)."""
    x = _c(c)
    return F.when(~F.isnan(x), x)


def nan_as_null(df: DataFrame, cols=None) -> DataFrame:
    """``df`` with NaN as NULL in its float and double columns (those among ``cols``)."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double") and (cols is None or f.name in cols)]
    return df.withColumns({c: no_nan(c) for c in names}) if names else df


def to_int_strict(c) -> Column:
    """Strict cast: raises on bad input under ANSI mode."""
    return _c(c).cast("int")


def to_timestamp_lenient(c, fmt: str | None = None) -> Column:
    """Lenient text -> timestamp; bad values become NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))


def parse_period_label(c) -> Column:
    """``'1978/1979'`` -> 1978 (strict integer before the slash);
    ``'1979'`` / ``'1979.0'`` -> 1979 (via double, truncated); else NULL."""
    s = strip(_c(c).cast("string"))
    head = F.split_part(s, F.lit("/"), F.lit(1))
    slash = head.try_cast("int")
    plain = s.try_cast("double").try_cast("int")
    return F.when(s.contains("/"), slash).otherwise(plain)


def encode_binary(c, positive: str = "Maha") -> Column:
    """1 when strip+title(label) equals ``positive``; missing or other -> 0."""
    return F.when(norm_label(c) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


def map_order_code(c, mapping: dict) -> Column:
    """Literal map label -> sort code; unknown labels -> NULL (sort last)."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(_c(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(_c(c) == F.lit(k), F.lit(v))
    return expr


def decade(year) -> Column:
    return (F.floor(_c(year) / 10) * 10).cast("int")


def decade_label(year) -> Column:
    return F.concat(decade(year).cast("string"), F.lit("s"))


def interaction(a, b) -> Column:
    return _c(a) * _c(b)


def ratio_clip(num, den, lo: float = 0.5, hi: float = 1.0) -> Column:
    """num/den clipped to [lo, hi]; x/0 -> hi for x>0, lo for x<0, NULL for 0/0;
    NULL inputs stay NULL (no clip of a missing value)."""
    n, d = _c(num), _c(den)
    r = F.try_divide(n, d)
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when((d == 0) & (n > 0), F.lit(hi))
        .when((d == 0) & (n < 0), F.lit(lo))
        .when(d == 0, F.lit(None).cast("double"))
        .otherwise(F.least(F.greatest(r, F.lit(lo)), F.lit(hi)))
    )


def abs_pct_diff(a, b) -> Column:
    """|a - b| / b * 100 (absolute value of the whole); b = 0 -> NULL."""
    return F.abs(F.try_divide(_c(a) - _c(b), _c(b)) * 100)


def delta_pct(pred, baseline) -> Column:
    return F.try_divide(_c(pred) - _c(baseline), _c(baseline)) * 100


def tonnes(pred_thousands) -> Column:
    return _c(pred_thousands) * 1000.0


def kg_per_acre(pred_thousands, harvested_thousands) -> Column:
    """(pred * 1000) / (harvested * 1000) * 1000."""
    return F.try_divide(_c(pred_thousands) * 1000.0, _c(harvested_thousands) * 1000.0) * 1000.0
