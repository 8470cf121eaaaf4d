"""Session settings the library relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: what the cluster names in ``spark.checkpoint.dir``, else the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/melodex/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, short lineage, survives lost executors.

    ``options`` are the writer's, like ``compression``.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what ``materialise`` stored for ``df``, once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
