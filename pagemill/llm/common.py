"""What the operators share: scratch tables on storage that every executor sees, and checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contracts' word: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_own: list[str] = []


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset, a local session gets a folder of its own that is
    deleted at its end; a cluster, whose executors could not see one another's folders, gets an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="pagemill-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pagemill-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/pagemill-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted), else as it is: then Spark shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_of(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and ``more``) alone, whatever else the table carries; a null text is the empty text."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever it has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def null_key(column: Column) -> Column:
    """A string that is equal just where ``column`` is, nulls included."""
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), column.cast("string")))
