"""Sources and sinks: header renaming + coercion, file routing by name,
optional inputs, pass-through sheets, named collections, write/read round
trips.  Spreadsheet decoding itself is out of scope: inputs arrive as tables
(or as long cell tables, see :mod:`.grid`)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions import scalars as S

# Vendor header -> canonical column of the primary seasonal
# table (note the double spaces inside three headers).
PRIMARY_HEADERS = {
    "Year_New": "year",
    "Season": "season",
    "Sown (*000  Acres)": "sown_000_acres",
    "Harvested (*000  Acres)": "harvested_000_acres",
    "GDP B$": "gdp_billion_usd",
    "Inflation(%)": "inflation_pct",
    "Rainfall(mm)": "rainfall_mm",
    "Temperature(°C)": "temperature_c",
    "Production (*000  Mt.)": "production_000_mt",
}


def rename_coerce(df: DataFrame, headers: dict, strict_int=(), labels=(), lenient=()) -> DataFrame:
    """Rename vendor headers, then: strict integer cast (raises on bad input
    under ANSI), strip + title for label columns, lenient numeric (bad ->
    NULL) for metric columns.  Headers missing from ``df`` are ignored."""
    present = {k: v for k, v in headers.items() if k in df.columns}
    out = df.withColumnsRenamed(present)
    conv = {}
    for c in strict_int:
        conv[c] = S.to_int_strict(F.col(c))
    for c in labels:
        conv[c] = S.norm_label(F.col(c).cast("string"))
    for c in lenient:
        conv[c] = S.to_double(F.col(c))
    return out.withColumns(conv)


def file_stem(path_col):
    """File name without its folders and its last suffix."""
    name = F.regexp_extract(F.col(path_col) if isinstance(path_col, str) else path_col, r"([^/\\\\]*)$", 1)
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def route_path(path_col) -> dict:
    """Routing columns derived from a file's stem (its name without folders and
    without the last suffix): metric family, extent family and season, by
    substring of the lower-cased stem (first rule that matches wins)."""
    p = F.lower(file_stem(path_col))
    metric = F.when(p.contains("yeild") | p.contains("yield"), "yield").when(p.contains("production"), "production")
    extent = F.when(p.contains("sown"), "sown").when(p.contains("harvested"), "harvested")
    season = F.when(p.contains("maha"), "Maha").when(p.contains("yala"), "Yala").otherwise("Unknown")
    return {"metric_route": metric, "extent_route": extent, "season": season}


def read_files(spark: SparkSession, pattern: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Load every file matching ``pattern`` at once, tagged with its file
    name and path (``_metadata``), so routing happens per row, not per driver loop."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(pattern)
    return df.withColumns({"file_name": F.col("_metadata.file_name"), "file_path": F.col("_metadata.file_path")})


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", date_col: str | None = None,
                  date_format: str | None = None, **options) -> DataFrame | None:
    """Return ``None`` when the input is absent; otherwise the table with
    ``date_col`` leniently coerced to a timestamp (bad values -> NULL)."""
    df = _load_or_none(spark, path, fmt, **options)
    if df is None:
        return None
    if date_col:
        df = df.withColumn(date_col, S.to_timestamp_lenient(F.col(date_col).cast("string"), date_format))
    return df


def read_passthrough(spark: SparkSession, path: str, fmt: str = "parquet", required: bool = True, **options) -> DataFrame | None:
    """Read a sheet as is; a missing required input raises FileNotFoundError,
    a missing optional one gives ``None``."""
    df = _load_or_none(spark, path, fmt, **options)
    if df is None and required:
        raise FileNotFoundError(f"no input files at {path}")
    return df


def _load_or_none(spark: SparkSession, path: str, fmt: str, **options) -> DataFrame | None:
    """Plan a read; ``None`` when the path does not exist."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as e:
        msg = str(e)
        if "PATH_NOT_FOUND" in msg or "Path does not exist" in msg:
            return None
        raise


def load_all(spark: SparkSession, sources: dict) -> dict:
    """name -> lazily planned DataFrame (optionally registered as temp views)."""
    return {name: loader(spark) for name, loader in sources.items()}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", header: bool = True,
                partition_by=()) -> str:
    """Write ``df``; ``partition_by`` lays it out as one folder per value (e.g.
    per season), so a later filter on those columns reads only the matching
    folders (partition pruning) instead of routing files by name."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    w.save(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", str(infer).lower())
    return r.csv(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never a
    machine-local temp dir on a cluster)."""
    import uuid

    from ..session import checkpoint_dir

    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
