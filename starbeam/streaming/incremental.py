"""Incremental sales load with Structured Streaming.

New raw sales files that land in a folder are read as a file stream, and every
micro-batch goes through the same silver cleaning as the batch layer
(``cleaning.clean_sales_details``) inside ``foreachBatch``. Each batch is written
to its own ``batch_id=N`` folder with overwrite, so a batch replayed after a
failure replaces its own output instead of duplicating it; the checkpoint folder
(on shared storage in a cluster) records which files were consumed.

A row equal to one of an earlier batch is dropped too: every stored row keeps the
hash of its raw fields (``ROW_HASH``), and a batch is anti-joined with the hashes of
the other batches, so the table holds the rows that one batch run would give.

A file's header must hold the expected names in their order: a file with other or reordered columns fails the batch
(nothing of it is written; it is read again when the stream restarts). A row with too few or too many fields keeps its text
in ``BAD_ROW``, as in the batch reader, and goes with that text to the batch's folder under ``<target>_bad_rows``; the
fields that could be read are cleaned as usual.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starbeam.operators import cleaning
from starbeam.sources.csv_source import BAD_ROW, CSV_OPTIONS, na_tokens_to_null
from starbeam.sources.schemas import RAW_SCHEMAS


def sales_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw sales CSV files as a stream (explicit text schema, checked headers, malformed rows marked, null markers -> NULL)."""
    schema = StructType([*RAW_SCHEMAS["raw_sales_details"].fields, StructField(BAD_ROW, StringType())])
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS, multiLine="true", enforceSchema="false", columnNameOfCorruptRecord=BAD_ROW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return na_tokens_to_null(reader.csv(landing_dir))


ROW_HASH = "row_hash"


def bad_rows_dir(target_dir: str) -> str:
    return target_dir.rstrip("/") + "_bad_rows"


def spark_files(spark: SparkSession, target_dir: str, batch_id: int) -> DataFrame | None:
    """The rows of the other batches, if there are any."""
    try:
        stored = spark.read.parquet(target_dir)
    except AnalysisException:  # nothing written yet
        return None
    return stored.where(F.col("batch_id") != batch_id)


def _writer(target_dir: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # written anew with a replayed batch, and before its rows, so that no row is there without its mark
        batch.where(F.col(BAD_ROW).isNotNull()).select(BAD_ROW).write.mode("overwrite").parquet(os.path.join(bad_rows_dir(target_dir), f"batch_id={batch_id}"))
        fields = [c for c in batch.columns if c != BAD_ROW]
        marked = batch.withColumn(ROW_HASH, F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))
        cleaned = cleaning.clean_sales_details(marked)
        others = spark_files(batch.sparkSession, target_dir, batch_id)
        if others is not None:
            cleaned = cleaned.join(others.select(ROW_HASH), ROW_HASH, "left_anti")
        cleaned.write.mode("overwrite").parquet(os.path.join(target_dir, f"batch_id={batch_id}"))
    return write_batch


def start(spark: SparkSession, landing_dir: str, target_dir: str, checkpoint_dir: str,
          available_now: bool = False, processing_time: str = "1 minute"):
    """Start the incremental load; returns the StreamingQuery."""
    writer = (sales_stream(spark, landing_dir).writeStream
              .foreachBatch(_writer(target_dir))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(spark: SparkSession, landing_dir: str, target_dir: str, checkpoint_dir: str) -> None:
    """Process every file present now, then stop (scheduled incremental runs)."""
    q = start(spark, landing_dir, target_dir, checkpoint_dir, available_now=True)
    q.awaitTermination()
