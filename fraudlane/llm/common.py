"""Helpers the operators share: the shared folder, written tables, source tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The code points that separate words in most contracts, as a Java / RE2 class.
BLANKS = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``, which every executor sees."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, tag: str, codec: str = "zstd", level: int = 3, path: str | None = None) -> DataFrame:
    """Write ``df`` to shared Parquet (in a new folder, or in ``path``) and read it back: cuts the lineage, so what follows neither
    recomputes it nor depends on the executors that made it. ``level`` is that of zstd."""
    spark = df.sparkSession
    path = path or shared_folder(spark, tag)
    df.write.option("compression", codec).option("parquet.compression.codec.zstd.level", str(level)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Give back the disk of a table that materialise has written and nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns under names that no operator uses itself, and these names by the columns' own."""
    names = {c: f"_given_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def named_back(result: DataFrame, names: dict[str, str], replaced: tuple[str, ...], added: tuple[str, ...] = ()) -> DataFrame:
    """The columns that set_apart renamed, under their own names, without the ``replaced`` ones (in any case, as Spark
    resolves names), then the ``added`` ones. A projection of its own: a name given back is never read beside it."""
    gone = {c.lower() for c in replaced}
    return result.select(*[F.col(given).alias(c) for c, given in names.items() if c.lower() not in gone], *added)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
