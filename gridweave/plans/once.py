"""Rows that are made once, however often a plan reads them."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def once(df: DataFrame) -> DataFrame:
    """df, written to the folder in spark.checkpoint.dir, which all executors see. Where that is unset, a temporary folder serves on a single machine; on a cluster that is an error."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="gridweave-"))
    return df.checkpoint(eager=True)
