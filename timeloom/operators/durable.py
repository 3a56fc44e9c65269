"""Lineage cut by reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """The rows behind a reliable checkpoint, so that lost executors cost no more than what follows it.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, a session on one
    machine, as in tests, gets a temporary one; on a cluster this is an error, as a folder of one machine is lost
    with it.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir names no folder that the executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
