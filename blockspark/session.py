"""Session helpers shared by the library."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library when only the driver's sys.path has it.

    On a cluster the library is installed on every node or handed over with
    ``--py-files``; this adds the checkout to the workers' path besides.
    """
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is absent and all runs on this machine (tests, a local
    session) a folder of this machine is made and set; a cluster must name one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        held = sc._jsc.sc().getCheckpointDir()
        if not held.isDefined() and not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = held.get() if held.isDefined() else "file://" + tempfile.mkdtemp(prefix="blockspark-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate results that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
