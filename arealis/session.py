"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "arealis", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session with adaptive execution on and UTC dates.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a cluster leave both to spark-submit.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point reliable checkpoints at the cluster's shared folder and return it.

    The folder comes from ``spark.checkpoint.dir``.  Only a local master without that setting gets a
    temporary folder; on a cluster the setting is required, because a machine-local folder would be
    lost with its machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder to hold checkpoints")
            folder = tempfile.mkdtemp(prefix="arealis-ckpt-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Compute a stage once and cut its lineage with a reliable checkpoint.

    For aggregated tables that several later jobs read (areas, groups, cells), not for microdata.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
