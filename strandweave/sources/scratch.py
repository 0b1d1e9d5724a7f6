"""The folder for intermediate tables that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one that is set, else the one that ``spark.checkpoint.dir`` names.

    Where none is named, a session on one machine gets a temporary folder. On a cluster that would be a
    folder of each machine's own, so it is an error there."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        if not named and sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandweave-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
