"""Writers: content-addressed append, versioned overwrite, manifests, reports, event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or no rows of the same schema where there is none yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], like.schema)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table lacks, one a key: content that is there is never written again."""
    known = read_or_empty(df.sparkSession, path, df)
    df.dropDuplicates([key]).join(known.select(key), key, "left_anti").select(*df.columns).write.mode("append").parquet(path)


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Replace the partitions of the versions in ``df`` and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(version).parquet(path)


def save_manifest(done: DataFrame, path: str, key: str = "sha256") -> None:
    append_new(done.select(key).filter(F.col(key).isNotNull()), path, key)


def write_report(df: DataFrame, path: str) -> None:
    """A small aggregate as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_events(df: DataFrame, path: str) -> None:
    """Events as JSON lines, appended."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(path)


def compact_journal(spark: SparkSession, path: str, out: str, fold) -> None:
    """The journal's folded standing as a table of its own; the journal stays as it is."""
    fold(spark.read.parquet(path)).write.mode("overwrite").parquet(out)
