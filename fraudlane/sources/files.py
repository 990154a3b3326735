"""Daily drop files: the ``;``-separated transactions file and the terminals and blacklist
sheets (exported as CSV or Parquet; workbooks have no distributed reader).

Every column is read as text with an explicit schema, bound by position; nothing is
inferred (``00123`` stays ``00123``). The business date comes from the file name
(``name_DDMMYYYY.ext``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import business_date_from_name, parse_iso_date
from ..schemas import BLACKLIST_FILE, TERMINALS_FILE, TRANSACTIONS_FILE


def _reader(spark: SparkSession, schema, fmt: str, sep: str):
    r = spark.read.schema(schema)
    if fmt == "csv":
        # a line with too few or too many fields stops the load: cut or padded rows would pass unseen
        r = r.option("sep", sep).option("header", "true").option("enforceSchema", "true").option("mode", "FAILFAST")
    return r.format(fmt)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions text files; adds ``file_name`` (the path) for the business date."""
    return (_reader(spark, TRANSACTIONS_FILE, "csv", ";").load(path)
            .withColumn("file_name", F.col("_metadata.file_path")))


def read_terminals(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";") -> DataFrame:
    """S3 (raw): terminals sheet rows plus their file name."""
    return (_reader(spark, TERMINALS_FILE, fmt, sep).load(path)
            .withColumn("file_name", F.col("_metadata.file_path")))


def read_blacklist(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";") -> DataFrame:
    """S4 (raw): passport blacklist sheet rows."""
    return (_reader(spark, BLACKLIST_FILE, fmt, sep).load(path)
            .withColumn("file_name", F.col("_metadata.file_path")))


def read_terminal_keys(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";") -> DataFrame:
    """The key column alone (the other columns are pruned from the scan)."""
    return _reader(spark, TERMINALS_FILE, fmt, sep).load(path).select(F.trim("terminal_id").alias("terminal_id"))


def _file_date(df: DataFrame, file_date) -> Column:
    if file_date is not None:
        return parse_iso_date(F.lit(str(file_date)))
    return business_date_from_name(F.col("file_name"))


def stage_terminals(raw: DataFrame, file_date=None) -> DataFrame:
    """S3/F1: trim every field and stamp ``update_dt`` with the file's business date.

    Keys are trimmed here once, so later joins on ``terminal_id`` need no trim (Q11 fix).
    """
    return raw.select(*[F.trim(c).alias(c) for c in TERMINALS_FILE.names],
                      _file_date(raw, file_date).cast("timestamp_ntz").alias("update_dt"))


def stage_blacklist(raw: DataFrame) -> DataFrame:
    """Blacklist rows as staged (text)."""
    return raw.select(*BLACKLIST_FILE.names)


def archive_files(spark: SparkSession, paths, archive_dir: str | None, base: str | None = None) -> list[str]:
    """K6: move consumed drop files into ``archive_dir``, under their names (or paths below ``base``) with ``.backup``
    added; files that are gone already (an earlier run moved them) are passed over. A file whose name the archive has from
    another folder gets its own folder's name before it. Returns the new paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    moved = []
    for path in paths if archive_dir else ():
        source = hadoop(path)
        name = source.toUri().getPath().split(hadoop(base).toUri().getPath() + "/", 1)[-1] if base else source.getName()
        target = hadoop(f"{archive_dir}/{name}.backup")
        fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(source):
            if fs.exists(target):
                target = hadoop(f"{archive_dir}/{source.getParent().getName()}-{name}.backup")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"{path} could not be moved to {target}")
            moved.append(target.toString())
    return moved
