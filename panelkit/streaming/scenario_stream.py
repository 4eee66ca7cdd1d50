"""Incremental scenario scoring with Structured Streaming.

The reference re-scores a scenario each time an input changes in its web
form.  Here scenario tables land as files in a folder; a streaming query
turns every micro-batch into feature vectors (stored scaler parameters,
fixed rules) and scores it with a fitted Spark ML pipeline.  Each batch is
written to its own ``epoch=<id>`` folder with overwrite, so a batch replayed
after a failure replaces its own output (exactly-once at the sink); the
stream's progress lives in the checkpoint location (a shared folder on a
cluster).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.scenario import scenario_features


def start_scoring(spark: SparkSession, source_dir: str, schema: T.StructType, params: DataFrame,
                  model: PipelineModel, sink_dir: str, checkpoint: str, cols: dict, season: str,
                  positive: str, cutoffs: dict, keep=(), available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Score scenario files as they arrive.  ``params`` is the scaler table
    (column_name, mean, std) - a few rows, broadcast into every batch."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        feats = scenario_features(batch, params, cols, season, positive, cutoffs)
        out = model.transform(feats).select(*keep, season, "prediction")
        out.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    w = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
