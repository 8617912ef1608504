"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable checkpoints once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "corpusmill",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading it from the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; only a
    local-mode session without one (tests) gets a fresh temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Set session options for the duration of a block, then restore them."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_partitioned(df: DataFrame, num_partitions: int, *keys: str,
                           sort: bool = False) -> DataFrame:
    """Reliable checkpoint hash-partitioned by ``keys`` that later joins can reuse.

    An adaptive plan reports an unknown partitioning to the checkpoint, so the
    checkpoint job runs with AQE paused (and with ``num_partitions`` as the
    shuffle partition count, so the job's own exchanges line up); joins and
    aggregations on ``keys``
    with ``num_partitions`` partitions then need no shuffle of this side, and a
    union of such checkpoints keeps the partitioning too. The pause is a
    session setting: do not run other queries on the same session from other
    driver threads meanwhile.
    """
    out = df.repartition(num_partitions, *keys)
    if sort:   # also keeps the order within partitions: merge joins skip their sort
        out = out.sortWithinPartitions(*keys)
    with session_conf(df.sparkSession, {"spark.sql.adaptive.enabled": "false",
                                        "spark.sql.shuffle.partitions": str(num_partitions)}):
        return cut_lineage(out)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
