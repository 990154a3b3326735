"""High-water marks of the incremental loads (a small control table, not event-time
watermarks): ``meta(schema_name, table_name, max_update_dt)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FIRST_MARK, META, TERMINALS_FIRST_MARK

DEFAULT_SCHEMA = "mart"
# ---------------------------------------------------------------------------
# The mark each table starts from.
# ---------------------------------------------------------------------------
SEED_MARKS = {
    "stg_terminals": TERMINALS_FIRST_MARK,
    "stg_cards": FIRST_MARK,
    "stg_accounts": FIRST_MARK,
    "stg_clients": FIRST_MARK,
}


def empty_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], META)


def seed_marks(meta: DataFrame, seeds: dict | None = None, schema: str = DEFAULT_SCHEMA, stages: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add a mark for every table that has none yet (existing marks are kept):
    ``coalesce(max(update_dt), default)`` of its staging table in ``stages``. A table that isn't given there
    counts as empty, as the staging tables always are at this point of a run (Q24).
    """
    spark = meta.sparkSession
    rows = [(schema, t, v) for t, v in (seeds or SEED_MARKS).items()]
    seed = spark.createDataFrame(rows, "schema_name string, table_name string, mark string") \
        .select("schema_name", "table_name", F.col("mark").cast("timestamp_ntz").alias("max_update_dt"))
    for table, stage in (stages or {}).items():
        newest = stage.agg(F.max("update_dt").cast("timestamp_ntz").alias("_newest")).withColumn("table_name", F.lit(table))
        seed = seed.join(newest, "table_name", "left").select("schema_name", "table_name", F.coalesce("_newest", "max_update_dt").alias("max_update_dt"))
    missing = seed.join(meta, ["schema_name", "table_name"], "left_anti")
    return meta.unionByName(missing)


def read_mark(meta: DataFrame, table: str, schema: str = DEFAULT_SCHEMA):
    """The mark of one table as a driver-side scalar (one row), or None."""
    row = meta.where((F.col("schema_name") == schema) & (F.col("table_name") == table)) \
              .select("max_update_dt").first()
    return None if row is None else row[0]


def _advance(meta: DataFrame, table: str, newest: DataFrame, schema: str) -> DataFrame:
    # newest is one aggregated row; join it to meta on the table name (both tiny)
    hit = (F.col("schema_name") == schema) & (F.col("table_name") == table)
    newest = newest.withColumn("table_name", F.lit(table)).withColumn("schema_name", F.lit(schema))
    joined = meta.join(newest, ["schema_name", "table_name"], "left")
    value = F.when(hit, F.coalesce(F.col("_newest"), F.col("max_update_dt"))).otherwise(F.col("max_update_dt"))
    return joined.select("schema_name", "table_name", value.alias("max_update_dt"))


def advance_mark(meta: DataFrame, table: str, stage: DataFrame, schema: str = DEFAULT_SCHEMA) -> DataFrame:
    """``coalesce(max(update_dt), max(create_dt))`` of the stage, or the old mark when
    the stage is empty (Q7: a later ``create_dt`` does not win over any ``update_dt``)."""
    newest = stage.agg(F.coalesce(F.max("update_dt"), F.max("create_dt")).cast("timestamp_ntz").alias("_newest"))
    return _advance(meta, table, newest, schema)


def advance_terminals_mark(meta: DataFrame, stage: DataFrame, file_date,
                           table: str = "stg_terminals", schema: str = DEFAULT_SCHEMA) -> DataFrame:
    """W4d/A3: ``max(update_dt)``, else the file date when the sheet had rows, else the old
    mark (Q21: this mark is never used to filter)."""
    fd = F.lit(str(file_date)).cast("date").cast("timestamp_ntz")
    newest = stage.agg(F.coalesce(F.max(F.col("update_dt").cast("timestamp_ntz")), F.max(fd)).alias("_newest"))
    return _advance(meta, table, newest, schema)


def next_mark(stage: DataFrame, old):
    """The advanced mark as a driver-side scalar (feeds the next day's extract literal)."""
    row = stage.agg(F.coalesce(F.max("update_dt"), F.max("create_dt")).alias("m")).first()
    return old if row is None or row["m"] is None else row["m"]
