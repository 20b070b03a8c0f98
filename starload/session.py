"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "starload", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the toolkit relies on; ``conf`` keys use ``__`` for dots.

    Shuffle partitions are left to the caller: AQE coalesces them, so a cluster sets them high.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="starload-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/starload/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str, scratch: str | None = None) -> DataFrame:
    """Write ``rows`` to a new folder, under ``scratch`` when given, and read them back.

    Cuts the lineage in a way that survives lost executors. It also gives the optimizer the true
    size: a small derived side is then broadcast from the start, where AQE alone would find out
    only after it had shuffled the large side too.
    """
    path = f"{scratch}/{label}-{uuid.uuid4().hex}" if scratch else fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def broadcastable(rows: DataFrame) -> bool:
    """Whether Spark itself would broadcast ``rows``: its size statistic against the session's threshold."""
    session = rows.sparkSession._jsparkSession
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= session.sessionState().conf().autoBroadcastJoinThreshold()
