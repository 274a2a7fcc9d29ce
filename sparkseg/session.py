"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that every query relies on; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(master: str = "local[*]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A session for tests and local runs."""
    builder = SparkSession.builder.master(master).config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share, so that losing one loses nothing.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session that names none gets a temporary one.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(named)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """The session, whose Python workers can import this package: Spark sends it to them once, as a file of the driver."""
    context = spark.sparkContext
    here = Path(__file__).resolve().parent
    if context.applicationId not in _SHIPPED and here.is_dir():
        path = Path(tempfile.mkdtemp(prefix="package-")) / f"{here.name}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(here.rglob("*.py")):
                z.write(f, f.relative_to(here.parent))
        context.addPyFile(str(path))
        _SHIPPED.add(context.applicationId)
    return spark
