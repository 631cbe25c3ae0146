"""Sessions and the folder that executors share."""

from __future__ import annotations

import logging
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "capstrata", **conf: str) -> SparkSession:
    """A session with what the plans rely on; settings of the cluster are left alone."""
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setup_logging(level: str = "INFO") -> None:
    logging.basicConfig(level=getattr(logging, level.upper(), logging.INFO), format="%(asctime)s %(levelname)s %(name)s: %(message)s")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its scan has fewer partitions than there are, as of a file with few row groups; a scan of
    many files stays as it is. For work that costs more than moving the rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """df checkpointed to the shared folder: it survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = "file://" + os.path.join(tempfile.gettempdir(), "capstrata-checkpoints")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
