"""Session construction and the shared scratch area for written intermediates."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that decide results or plan quality and may be changed at run time.
RUNTIME_CONF = {
    # ingest_date is a UTC date and hours are taken from UTC instants
    "spark.sql.session.timeZone": "UTC",
    # a malformed counter must fail the job, not become NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # popular entities and tags: split their join partitions even if the
    # split costs a later exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "chartloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with our settings.

    Leave ``master`` unset under spark-submit.  On a cluster set
    ``shuffle_partitions`` high (AQE merges the small ones); the default
    suits neither a laptop nor 100 TB.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_scratch_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's written intermediates.

    It lies under ``spark.checkpoint.dir``, which every executor can reach, so
    a lost executor costs a re-read and nothing else.  Where that is unset, a
    session of one process takes the warehouse folder, and any other one is
    refused: the warehouse folder may be the driver's own.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch_roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
            shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        _scratch_roots[app] = f"{shared.rstrip('/')}/chartloom-{app}-{uuid.uuid4().hex[:8]}"
    return _scratch_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch area that has not been used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# Files of shuffles are dropped when the write that needed them ends, not when the
# driver happens to collect garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the scratch area and read it back.

    Cuts lineage for plans whose parts must see the very same rows.  ``options``
    are those of the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
