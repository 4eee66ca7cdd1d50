"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CKPT = "spark.checkpoint.dir"
_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="panelkit-zip-"), "panelkit_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder for an intermediate table, below the shared folder that
    ``spark.checkpoint.dir`` names.  Only where that setting is unset and the
    master is local (tests) a folder of this machine is taken.  All folders of
    the application are deleted when the driver's process ends."""
    sc = spark.sparkContext
    base = _SCRATCH.get(sc.applicationId)
    if base is None:
        shared = sc.getConf().get(_CKPT, None) or spark.conf.get(_CKPT, None)
        if not shared:
            if not sc.master.startswith("local"):
                raise RuntimeError(f"{_CKPT} is not set: name a shared folder for intermediate tables")
            shared = os.environ.get("PANELKIT_SCRATCH") or tempfile.mkdtemp(prefix="panelkit-llm-")
        base = f"{shared.rstrip('/')}/panelkit-llm-{uuid.uuid4().hex[:12]}"
        _SCRATCH[sc.applicationId] = base
        atexit.register(drop_folder, spark, base)
    return f"{base}/{label}-{uuid.uuid4().hex[:8]}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through Spark's own file system layer."""
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is already closing; nothing else depends on the folder
        return


def saved(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a scratch table and return a scan of it: cuts lineage and
    survives the loss of executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    w = df.write
    (w.partitionBy(*by) if by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete scratch tables that ``saved`` returned and no later plan reads."""
    for t in tables:
        drop_folder(t.sparkSession, t.scratch_path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def payloads(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column (null: empty)."""
    return [b or b"" for b in batch.column(name).cast(pa.large_binary()).to_pylist()]


def batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names (so that other
    columns of ``df`` cannot clash with the operator's own)."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
