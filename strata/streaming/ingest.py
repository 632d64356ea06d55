"""Incremental per-period ingest with Structured Streaming (S6/S7/S8 as a stream).

New period files (one folder or file per period, as the election sheets
arrive year by year) are picked up by a file stream with a declared
schema, tagged with the period parsed from the file path, and appended to
a Parquet table partitioned by period.  The checkpoint records which
files were processed, so a restarted or re-triggered job ingests only new
files, exactly once; with ``availableNow`` it processes what is there and
stops.  The panel operators then run as batch jobs on the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.csv import charset
from strata.sources.panel_files import period_from_path


def period_file_stream(spark: SparkSession, folder: str, schema: StructType | str,
                       period_pattern: str = r"(\d{4})", period_col: str = "period",
                       sep: str = ",", encoding: str = "UTF-8",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over CSV files below ``folder``."""
    r = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
         .option("encoding", charset(encoding)).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(folder)
    period = period_from_path(F.col("_metadata.file_path"), period_pattern)
    return df.select(period.alias(period_col), *[F.col(c) for c in df.columns])


def ingest_available(stream: DataFrame, sink: str, checkpoint: str, period_col: str = "period",
                     timeout_s: float | None = None) -> None:
    """Append everything currently available to a period-partitioned Parquet
    table (file sink: exactly once with the checkpoint) and wait for it."""
    q = (stream.writeStream.format("parquet").outputMode("append").partitionBy(period_col)
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if not (q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)) and q.isActive:
        q.stop()
        raise TimeoutError(f"the table is incomplete after {timeout_s} s; run again to go on from the checkpoint")
    if q.exception():
        raise q.exception()
