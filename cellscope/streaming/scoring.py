"""Structured Streaming entry points.

The reference has no stream processing; scoring is stateless, so the batch
scorer (V6) applies unchanged to a streaming DataFrame: new feature rows
arriving as Parquet files are scored per micro-batch and appended to a sink.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ml import batch_score


def score_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema: str,
                 features: list[str], sink: str = "memory", query_name: str = "scored",
                 checkpoint: str | None = None, path: str | None = None) -> StreamingQuery:
    """Score feature files as they land in ``source_dir``.

    ``sink='memory'`` keeps results in a table named ``query_name`` (tests);
    ``sink='parquet'`` appends to ``path`` with a checkpoint for
    exactly-once output after restarts.
    """
    stream: DataFrame = spark.readStream.schema(schema).parquet(source_dir)
    scored = batch_score(model, stream, features)
    w = scored.writeStream.outputMode("append")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if sink == "memory":
        return w.format("memory").queryName(query_name).start()
    return w.format(sink).option("path", path).start()
