"""The scan on a stream of texts.  It keeps no state, so no watermark is needed: a row is scored as it would be in a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import score
from ..session import written
from ..sources.sinks import report_rows

TEXTS = "relative_path string, extension string, size_bytes bigint, text string"


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files of texts as they come into a folder."""
    return spark.readStream.schema(TEXTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def score_stream(texts: DataFrame, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Score a stream; report items are written once a batch, under the batch's number, so a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        # Written first: a filter right above the scoring would be rewritten into all of it.
        report_rows(written(score(batch), "batch").where("include_in_report"), output).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = texts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()
