"""Tables between the steps of an operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and read from the folder that the driver and all executors share: the
    cluster names it in spark.checkpoint.dir. Only a local session may do without, as tests do."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="tidemark-checkpoints-"))
    return df.checkpoint(eager=True)
