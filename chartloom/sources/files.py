"""NDJSON and dated tables in and out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.operators.lookups import AbsentLookup, lookup_union_last, lookup_versions
from chartloom.schemas import CATEGORY_LOOKUP, FLAT_TABLE, RAW_VIDEO


def scan_ndjson(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """One JSON object per line; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def path_value(name: str, path: Column) -> Column:
    """The value of a ``name=value`` folder in a file path, URL-decoded."""
    return F.url_decode(F.regexp_extract(path, f"{name}=([^/]+)", 1))


def path_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add columns that exist only in the file path, such as region and date.

    ``types`` maps folder name to (output type); apply it directly on a scan.
    """
    path = F.col("_metadata.file_path")
    return df.select(
        "*", *[path_value(name, path).cast(kind).alias(name) for name, kind in types.items()]
    )


def scan_regions(spark: SparkSession, root: str, regions: tuple[str, ...]) -> DataFrame:
    """Raw objects of some regions' folders in one read, with ``region`` and ``ingest_date``."""
    schema = T.StructType([*RAW_VIDEO.fields, *T.StructType.fromDDL("region string, ingest_date date").fields])
    folders = [f"{root}/region={region}" for region in regions]
    return spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", root).json(folders)


def scan_flat_partitioned(
    spark: SparkSession, root: str, fmt: str = "parquet", schema: T.StructType = FLAT_TABLE
) -> DataFrame:
    """A chart table kept in ``ingest_date=`` folders.

    New folders are seen at the next call; a filter on ``ingest_date`` prunes
    folders, and only the selected columns are read.
    """
    return spark.read.schema(schema).format(fmt).load(root)


def scan_lookup_entries(spark: SparkSession, root: str) -> DataFrame:
    """Entries of all category lookups with their ``fetched_date`` and place in the file."""
    dated = T.StructType([*CATEGORY_LOOKUP.fields, T.StructField("fetched_date", T.DateType())])
    entries = scan_ndjson(spark, root, dated)
    # rows of a split are read in their order
    place = F.struct(
        "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")
    )
    return entries.select("*", place.alias("place"))


def fetch_dates(spark: SparkSession, root: str) -> DataFrame:
    """The ``fetched_date`` of each lookup, from a listing of the files; those of zero bytes do not count."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return listing.select(path_value("fetched_date", F.col("_metadata.file_path")).cast("date").alias("fetched_date")).distinct()


def scan_lookup_versions(spark: SparkSession, root: str) -> DataFrame:
    """Entries of all category lookups with the period in which they hold.

    Lookups lie in ``fetched_date=`` folders, one file of one JSON object per
    line for each fetch.
    """
    return lookup_versions(scan_lookup_entries(spark, root), fetch_dates(spark, root))


def scan_category_lookup(
    spark: SparkSession, root: str, day: str | dt.date | None = None
) -> DataFrame:
    """The newest category lookup fetched on or before ``day``, one entry per id.

    The date is chosen from folder names.  Raises if there is none.
    """
    fetches = fetch_dates(spark, root)
    if day is not None:
        fetches = fetches.filter(F.col("fetched_date") <= F.lit(str(day)).cast("date"))
    newest = fetches.agg(F.max("fetched_date")).first()[0]
    if newest is None:
        raise AbsentLookup(f"no lookup under {root} on {day}")
    entries = scan_lookup_entries(spark, root).filter(F.col("fetched_date") == F.lit(newest))
    return lookup_union_last(entries.drop("fetched_date"), "id", ["place"]).drop("place")


def land_raw(spark: SparkSession, path: str, day: str | dt.date | None = None) -> DataFrame:
    """Lines untouched, with their ingest date and source file.

    The date is ``day``, or the one in each file's path.
    """
    lines = spark.read.text(path, recursiveFileLookup=True)
    file = F.col("_metadata.file_path")
    date = path_value("ingest_date", file) if day is None else F.lit(str(day))
    return lines.select(
        F.col("value").alias("data"),
        date.cast("date").alias("ingest_date"),
        file.alias("source_file"),
    )


def _by_date(df: DataFrame) -> DataFrame:
    # even write tasks: small dates share one, a large date is split over many
    return df.hint("rebalance", F.col("ingest_date"))


def write_ndjson(df: DataFrame, root: str) -> None:
    """Write rows as NDJSON, replacing the folders of the dates present in ``df``."""
    (
        _by_date(df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("ingest_date")
        .json(root)
    )


def replace_partition(df: DataFrame, root: str) -> None:
    """Replace the dates present in ``df``, leave all others: safe to rerun.

    ``df`` must not read from ``root``.
    """
    (
        _by_date(df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date")
        .parquet(root)
    )
