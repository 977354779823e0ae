"""Batches that announce themselves.

Each arriving manifest is one event.  The stream reads the manifests only;
the files they name are read by the batch jobs it triggers.  A checkpoint
keeps one manifest file from firing twice, the ledger of loaded dates keeps a
second manifest for the same date from loading it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartloom.operators.scd import OutOfOrderBatch
from chartloom.plans.warehouse import Warehouse, unprocessed_batches
from chartloom.schemas import MANIFEST
from chartloom.sources.files import replace_partition
from chartloom.sources.manifests import merge_batch, scan_batches


def stream_manifest_batches(
    spark: SparkSession,
    control: str,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Call ``on_batch`` with the manifests that arrived, then stop at the end."""
    manifests = spark.readStream.schema(MANIFEST).option("mode", "FAILFAST").json(control)
    return (
        manifests.select("date", "regions")
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedup_delivery(manifests: DataFrame, ledger: DataFrame) -> DataFrame:
    """One manifest per date that has not been processed yet."""
    dated = manifests.withColumn("ingest_date", F.col("date").cast("date"))
    # a repeated notification names the same run; keep one, always the same
    single = dated.groupBy("ingest_date").agg(
        F.min(F.struct("date", "regions")).alias("_one")
    )
    return unprocessed_batches_of(single, ledger).select("_one.date", "_one.regions", "ingest_date")


def unprocessed_batches_of(manifests: DataFrame, ledger: DataFrame) -> DataFrame:
    fresh = unprocessed_batches(manifests, ledger)
    return manifests.join(fresh, "ingest_date", "left_semi")


def merge_to_chart(
    raw_root: str, chart_root: str, lookups: Callable[[], DataFrame],
    ledger: Callable[[], DataFrame], claim: Callable[[DataFrame], None],
) -> Callable[[DataFrame, int], None]:
    """A batch function that merges new manifests into the dated chart table.

    ``lookups`` gives the lookup versions known when a batch arrives.  The
    dates are claimed after the chart is written: a failure in between
    repeats the write, which replaces the same folders.
    """

    def on_batch(manifests: DataFrame, _batch: int) -> None:
        fresh = stream_dedup_delivery(manifests, ledger())
        if fresh.isEmpty():
            return
        raw = scan_batches(manifests.sparkSession, fresh, raw_root)
        replace_partition(merge_batch(raw, lookups()), chart_root)
        claim(fresh.select("ingest_date"))

    return on_batch


def stream_daily_load(
    spark: SparkSession,
    control: str,
    raw_root: str,
    lookups: Callable[[], DataFrame],
    warehouse: Warehouse,
    checkpoint: str,
    on_late: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Load the days of each micro-batch into the warehouse, in date order.

    Each day is named by the lookup of its date, out of the versions that
    ``lookups`` gives when its manifest arrives.  The warehouse's ledger decides
    what is new.  Days older than the newest
    loaded one are handed to ``on_late`` for a rebuild, or refused without it.
    """

    def on_batch(manifests: DataFrame, _batch: int) -> None:
        fresh = stream_dedup_delivery(manifests, warehouse.ledger())
        newest = warehouse.store.head().newest_date()
        if newest is not None:
            in_order = F.col("ingest_date") > F.lit(newest).cast("date")
            late = fresh.filter(~in_order)
            if not late.isEmpty():
                if on_late is None:
                    raise OutOfOrderBatch(f"manifests older than {newest} arrived: rebuild")
                on_late(late)
            fresh = fresh.filter(in_order)
        if fresh.isEmpty():
            return
        raw = scan_batches(spark, fresh, raw_root)
        warehouse.backfill(merge_batch(raw, lookups()))

    return stream_manifest_batches(spark, control, on_batch, checkpoint)
