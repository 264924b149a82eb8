"""Score request files as they arrive.

readStream (request files as text, parsed with an explicit schema) -> request
defaults -> foreachBatch(flatten, score, respond). A request is one JSON record, so all its
rows land in the same micro-batch, and every window of the scoring plan is
keyed by request_id: batch boundaries cannot change a result. Each batch
overwrites its own output partition (epoch), so a replayed batch after a
failure rewrites instead of duplicating; progress lives in the checkpoint
location (use the cluster's shared checkpoint folder).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.models import ModelBundle
from ..plans.scoring import response_json, score_customers
from ..sources.requests import flatten_requests, parse_requests, request_defaults, source_lines, with_source_key


def request_stream(spark: SparkSession, request_dir: str, max_files: int = 1000) -> DataFrame:
    """Lines of the request files and the file each comes from."""
    return source_lines(spark.readStream.option("maxFilesPerTrigger", max_files).option("lineSep", "\n").text(request_dir))


def start_scoring_stream(spark: SparkSession, request_dir: str, out_dir: str, checkpoint: str,
                         models: ModelBundle | None = None, available_now: bool = True,
                         lenient: bool = False, max_files: int = 1000):
    """Start the stream; returns the StreamingQuery. Output: parquet
    predictions by micro-batch id, and below ``_responses`` one response body
    per request, unreadable and empty ones included."""
    models = models or ModelBundle()
    lines = request_stream(spark, request_dir, max_files)

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        # a file is in one batch only, so the byte offset of a line is the same however files are dealt into batches
        batch = request_defaults(parse_requests(with_source_key(batch), "value", "source_key"), config=models.config).persist()
        cached: list = [batch]
        try:
            preds = score_customers(flatten_requests(batch), models, lenient=lenient, cached=cached).persist()
            cached.append(preds)
            preds.withColumn("batch_id", F.lit(epoch_id)).write.mode("overwrite").parquet(
                os.path.join(out_dir, f"batch_id={epoch_id}"))
            response_json(preds, batch).write.mode("overwrite").json(os.path.join(out_dir, "_responses", f"batch_id={epoch_id}"))
        finally:
            for df in cached:
                df.unpersist()

    w = lines.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
