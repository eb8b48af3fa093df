"""Cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder: spark.checkpoint.dir; one of our own only in local mode, where that is unset.

    On a cluster a folder of the driver's machine could not be read by the executors, so there it must be set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="dirlens-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and read it from there.

    A written table is worked out once, where checkpoint() runs its last stage a second time to write
    it; and it is read by columns, with sizes that the next joins can be planned by.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
