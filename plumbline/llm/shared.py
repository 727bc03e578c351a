"""What the operators share on the Spark side: the shared folder and stage tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a folder below the warehouse, which the cluster shares as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to a table of its own in the shared folder and read it back: cuts the lineage and survives a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
