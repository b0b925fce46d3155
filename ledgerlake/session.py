"""SparkSession settings and lineage cutting shared by every job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


# Recording the Python call site of every column costs more than planning these queries.
# Static: it has to be set when the session is made.
CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"


def build_session(app: str = "ledgerlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans rely on; cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Files of cut_lineage go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        CALL_SITES: "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the session; a private one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise reliably: a lost executor re-reads files instead of recomputing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
