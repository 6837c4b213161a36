"""Optional ingestion mode: the landing folder as a file-source stream.

Each micro-batch of new ``*.jl`` lines is folded into the warehouse by the
same load as the batch job (``foreachBatch``).  The stream's checkpoint
tracks which files were consumed.  A micro-batch's run id is made of the
stream's own id, which is new with every checkpoint folder, and the batch id: a
micro-batch replayed after a failure is not applied twice, and the batches
of a new checkpoint, whose ids start at 0 again, are not taken for old ones.  ``trigger(availableNow=True)`` turns a daily schedule
into "process everything new, then stop".

The file source never reads a path twice.  A crawler must therefore land each
day under new names (``2026-04-29/x_output.jl``); a file rewritten under its old
name is not seen, and its postings would close as stale.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.load import load_lines
from ..schemas import SKILL_KEYWORDS


def landing_stream(spark: SparkSession, landing_path: str, pattern: str = "*.jl",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(landing_path)
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id that Spark gave the stream when it made the checkpoint folder."""
    text = spark.read.text(checkpoint_location.rstrip("/") + "/metadata").first()["value"]
    return json.loads(text)["id"]


def fold_batch(root: str, checkpoint_location: str, keywords: Sequence[str] = SKILL_KEYWORDS, days: int = 3):
    """``foreachBatch`` function: one load per micro-batch, run time = now (UTC)."""
    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        as_of = spark.sql("SELECT date_format(localtimestamp(), 'yyyy-MM-dd HH:mm:ss') AS t").first()["t"]
        # line positions are assigned per micro-batch (a static DataFrame here)
        lines = batch.withColumn("pos", F.monotonically_increasing_id())
        run_id = f"{stream_id(spark, checkpoint_location)}-b{batch_id:09d}"
        load_lines(spark, lines, root, as_of, run_id, keywords, days=days, batch_id=batch_id)
    return fold


def start(spark: SparkSession, landing_path: str, root: str, checkpoint_location: str,
          available_now: bool = True, keywords: Sequence[str] = SKILL_KEYWORDS):
    """Start the ingestion query; returns the ``StreamingQuery``."""
    writer = (landing_stream(spark, landing_path).writeStream
              .foreachBatch(fold_batch(root, checkpoint_location, keywords))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
