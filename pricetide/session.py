"""Session settings and the one place where intermediate tables are staged."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Recommended for a cluster job; every operator also gives the same result without them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Pages are large: few per Arrow batch, so that a batch fits in a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def local_session(cpus: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pricetide")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; taken from the session.

    Only a local session without a configured folder gets a temporary one.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pricetide-"))
    return sc.getCheckpointDir().rstrip("/")


def _stage_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/pricetide-{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    """New, unused path below the shared folder."""
    return f"{_stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder; none if it is not there."""
    root, system = _folder(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(root)) if system.exists(root) else []


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file."""
    target, system = _folder(spark, path)
    out = system.create(target, True)
    try:
        out.write(content)
    finally:
        out.close()


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders with all they hold."""
    for path in paths:
        root, system = _folder(spark, path)
        system.delete(root, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove the staged tables of this application, once its results are written."""
    remove(spark, [_stage_root(spark)])


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a columnar table in the shared folder and read it back.

    Cuts the lineage, so values that depend on the physical layout (partition
    numbers) are fixed even if an executor is lost later on.
    """
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
