"""Session helpers: recommended settings and lineage cuts.

Lineage is cut by writing Parquet into the shared folder the cluster names in
``spark.checkpoint.dir`` and reading it back: a lost executor does not lose the cut,
and later scans keep column pruning and pushed filters.  A folder of our own is set
only where the session has none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "filingfold") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder; set ``spark.checkpoint.dir`` from the
    conf if the context has none; only in local mode fall back to a fresh folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="filingfold-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and return a scan of it.  The
    scan carries no partitioning, so a join on it gets an exchange of its own and AQE
    can split a hot key there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
