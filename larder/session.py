"""Session settings and the shared folder for written intermediates."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# settings the plans rely on; all can be changed at run time
PLAN_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs the next operator its own shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in PLAN_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read and write, as the cluster names it.

    Only a local session that names none gets a temporary one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="larder-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one written intermediate, under the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
