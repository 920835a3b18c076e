"""Recommendations for requests that arrive over time.

The original answers one request per console prompt. Here requests are files
landing in a folder; Structured Streaming picks up new files, and each
micro-batch is answered by the same batch plan (``recommend``) against the
song table and the similar-artist cache. Output goes to one folder per batch
id, written with ``overwrite``, so a retried batch replaces its own output
(exactly once per batch); progress lives in the checkpoint folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from songgraph.operators.recommend import recommend
from songgraph.schema import REQUEST
from songgraph.session import scratch


def serve(spark: SparkSession, requests_dir: str, songs: DataFrame, paths: DataFrame,
          out_dir: str, checkpoint_dir: str, artists: DataFrame | None = None,
          available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(REQUEST)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(requests_dir)

    def answer(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):        # the batch's tables go with the batch
            recs = recommend(batch, songs, paths, artists=artists)
            recs.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    writer = (stream.writeStream.foreachBatch(answer)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_answers(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(out_dir).drop("batch")
