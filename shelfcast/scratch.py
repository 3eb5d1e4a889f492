"""Written tables that cut lineage, kept in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder, because there driver
    and executors are one process on one machine.
    """
    context = spark.sparkContext
    app = context.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/shelfcast/{app}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="shelfcast-")
    return f"{_local_roots[app]}/{app}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that no earlier run has used."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet and read it back.

    Later branches prune columns and push filters into the written table, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
