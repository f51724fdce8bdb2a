"""Shared-folder tables and small helpers that every operator here uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder name of this process's tables.
RUN = uuid.uuid4().hex
#: A word is a run of anything but space and the five control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset and all runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="waymeld-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/waymeld-{RUN}/{uuid.uuid4().hex}"


def cleaned(spark: SparkSession) -> None:
    """Removes every table that this process has written to the shared folder; results that read them must be stored first."""
    run = scratch(spark).rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(run)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark)
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._waymeld_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() made and that no later plan reads."""
    for t in tables:
        path = getattr(t, "_waymeld_path", None)
        if path:
            jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


#: Most rows of keys that are broadcast, counted before; with keys of 100 bytes some 50 MB.
MAX_KEYS = 300_000


def matching(rows: DataFrame, keys: DataFrame, on: str, how: str, counted: DataFrame | None = None) -> DataFrame:
    """Semi or anti join with a written table of keys: broadcast when their count allows, so that rows are not shuffled, else by shuffle."""
    few = (keys if counted is None else counted).count() <= MAX_KEYS
    return rows.join(F.broadcast(keys) if few else keys.hint("merge"), on, how)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches small enough that a batch of very long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def fold(column: str, modulus: int) -> Column:
    """Remainder of crc32 of the id written as text."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def freed(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of steps whose plans nobody holds any more."""
    import gc

    gc.collect()
    spark._jvm.System.gc()
