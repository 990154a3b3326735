"""Daily drop folder -> staging table, as a Structured Streaming file source.

The stream's checkpoint remembers which files were consumed (S9), so a file is loaded
exactly once however often the job runs, and ``cleanSource=archive`` moves consumed files
into an archive folder (K6). Run with ``trigger(availableNow=True)`` it behaves like a
batch job over whatever has arrived. Spark archives a file when a later batch starts, so after the run the files
that are staged but still in the drop folder (those of the last batches) are moved by name. A file is never read
twice either way: the checkpoint has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import business_date_from_name
from ..schemas import TRANSACTIONS_FILE
from ..sources.files import archive_files


def drop_stream(spark: SparkSession, drop_dir: str, archive_dir: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of the ``;``-separated transactions files under ``drop_dir``, with
    the business date from each file's path and the file itself."""
    r = (spark.readStream.schema(TRANSACTIONS_FILE)
         .option("sep", ";").option("header", "true").option("enforceSchema", "true").option("mode", "FAILFAST"))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = r.csv(drop_dir)
    return rows.select(*TRANSACTIONS_FILE.names,
                       business_date_from_name(F.col("_metadata.file_path")).alias("business_date"),
                       F.col("_metadata.file_path").alias("source_file"))


def ingest_drops(spark: SparkSession, drop_dir: str, staging_dir: str, checkpoint_dir: str,
                 archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Append every not-yet-consumed drop file to ``staging_dir`` (Parquet, partitioned by business date), wait
    until the backlog is done, and archive the staged files that the stream has left in place."""
    q = (drop_stream(spark, drop_dir, archive_dir, max_files_per_trigger)
         .writeStream.format("parquet")
         .option("path", staging_dir)
         .option("checkpointLocation", checkpoint_dir)
         .partitionBy("business_date")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if archive_dir:
        staged = spark.read.parquet(staging_dir).select("source_file").distinct()
        archive_files(spark, [r.source_file for r in staged.toLocalIterator()], archive_dir, base=drop_dir)  # file names, one at a time
