"""Cut lineage with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.  Only a session of one machine gets a folder of its own where it is unset; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        master = spark.sparkContext.master
        if set_dir.isDefined():
            folder = set_dir.get()
        elif master.startswith("local") and not master.startswith("local-cluster"):
            folder = "file://" + tempfile.mkdtemp(prefix="assayer-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table of the shared folder: a lost executor costs no recomputation of what lies before.

    It is deleted by discard(), or as the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/assayer/{uuid.uuid4().hex}"
    df.write.parquet(path)
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(to)
    out = spark.read.schema(df.schema).parquet(path)
    out._assayer_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df._assayer_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
