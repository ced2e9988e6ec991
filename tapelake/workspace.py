"""Shared folder for intermediate tables.

A cluster names a folder that all its executors can reach in
``spark.checkpoint.dir``. Where it is unset, tables go below the session's
warehouse, which Spark itself expects to be shared. The user's settings are
never changed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    return f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/tapelake-work"


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder under the shared root."""
    return f"{shared_root(spark)}/tapelake/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the session's own Hadoop file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches of a plan need the same expensive input. The
    written table cuts lineage, outlives executors and stays columnar, so each
    branch reads only its own columns.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
