"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Every timestamp rule in this package assumes the UTC session zone.  Join and
# aggregate sizing is left to adaptive execution; the initial partition count is
# a deployment setting, not hard-coded here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset
    (tests, one machine) a temporary folder is used instead.
    """
    named = spark.sparkContext.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(
        CHECKPOINT_SETTING, None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="gaugemill-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and lets several
    consumers (or a rewrite of the source itself) share one evaluation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder; one that is gone already is no error."""
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below a folder, but for hidden ones; none where it does not exist."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    found = [s.getPath() for s in system.listStatus(folder) if s.isDirectory()]
    return sorted(p.toString() for p in found if p.getName()[0] not in "._")


def discard(df: DataFrame) -> None:
    """Remove a table that ``materialize`` wrote, once nothing reads it any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)
