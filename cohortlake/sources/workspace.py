"""Where intermediate files may go: the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Unset, a one-machine session gets a temporary one and a cluster an error."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"{SETTING} must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="cohortlake-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so concurrent runs do not collide."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where two consumers need the same expensive result: it survives the loss of executors
    and cuts the lineage, which a cached DataFrame does not. ``rows_per_file`` (0: no bound) makes files that other tasks read.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
