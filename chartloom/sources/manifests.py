"""Completion records: which batches are whole, and which files they consist of.

Manifests lie under ``control/ingest_date=D/``.  Not ``_SUCCESS`` or
``_control``: Spark skips such names without a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.clean import flatten_nested
from chartloom.operators.lookups import lookup_as_of
from chartloom.schemas import FLAT_COLUMNS, MANIFEST, RAW_VIDEO
from chartloom.session import materialize
from chartloom.sources.files import scan_ndjson

# A raw file's place in its zone, and what a line of it holds.
FILE = "region=[^/]+/ingest_date=[^/]+/.+$"
RAW_LINE = "value string, region string, ingest_date date"
# Files a batch may name for the names to be broadcast: some 20 MB of paths.
BROADCAST_FILES = 50_000


def completeness_gate(files: DataFrame, expected: list[str]) -> DataFrame:
    """Dates for which every expected region delivered.

    ``files`` has one row per delivered file: ``ingest_date``, ``region``.  The
    set per date holds expected regions only.
    """
    return (
        files.filter(F.col("region").isin(*expected))
        .groupBy("ingest_date")
        .agg(F.collect_set("region").alias("got"))
        .filter(F.size(F.array_except(F.array(*map(F.lit, expected)), "got")) == 0)
        .select("ingest_date")
    )


def read_manifests(spark: SparkSession, control: str) -> DataFrame:
    return scan_ndjson(spark, control, MANIFEST).select("date", "regions")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """(region, ingest_date, file) of every key that some manifests name.

    ``file`` is the key from its ``region=`` folder on.  A key whose folder is
    not of its manifest's date fails the job, as does one that is no such path.
    """
    keys = manifests.select("date", F.explode("regions").alias("key"))
    file = F.regexp_extract("key", FILE, 0)
    dated = F.regexp_extract("key", "ingest_date=([^/]+)", 1)
    wrong = F.concat_ws(" ", F.lit("manifest of"), "date", F.lit("names"), "key")
    right = (file != "") & dated.eqNullSafe(F.col("date"))
    return keys.select(
        F.regexp_extract("key", "region=([^/]+)", 1).alias("region"),
        dated.try_cast("date").alias("ingest_date"),
        F.when(F.coalesce(right, F.lit(False)), file).otherwise(F.raise_error(wrong)).alias("file"),
    ).distinct()


def _file_of(path: Column) -> Column:
    """The same of a path as Spark gives it, URL-encoded; a plus sign stands for itself."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, FILE, 0)


def refuse_missing(spark: SparkSession, files: DataFrame, folder: str) -> None:
    """Raise if a named file is not there: it would be read as no rows.

    Compares with a listing; nothing is opened, and no more than one name
    reaches the driver.  A file of zero bytes is one whose writing failed, and
    counts as missing: a region without rows leaves a file with a line break.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    there = listing.select(_file_of(F.col("_metadata.file_path")).alias("file"))
    missing = files.join(there, "file", "left_anti").select("file").take(1)
    if missing:
        raise FileNotFoundError(f"a manifest names {missing[0].file}, which is not under {folder}")


def scan_batches(
    spark: SparkSession, manifests: DataFrame, raw_root: str, zone: str = "raw"
) -> DataFrame:
    """Raw objects of exactly the files some manifests name.

    Region and date come from the folders, as the body does not hold them.  The
    names are written once and meet the zone's lines in a semi-join on folder
    and file: folders that no manifest names are pruned at run time, and lines
    of other files in a named folder are dropped before they are parsed.
    """
    folder = f"{raw_root.rstrip('/')}/{zone}"
    files = materialize(manifest_files(manifests), "manifest-files")
    refuse_missing(spark, files, folder)
    # the count comes from file footers; more files than this join by shuffle
    few = files.count() <= BROADCAST_FILES
    named = files.filter("file <> ''").select(*[F.col(c).alias(f"_{c}") for c in files.columns])
    lines = spark.read.schema(RAW_LINE).text(folder).select("*", _file_of(F.col("_metadata.file_path")).alias("file"))
    same = [F.col(c) == F.col(f"_{c}") for c in files.columns]
    wanted = lines.join(F.broadcast(named) if few else named, same, "left_semi")
    parsed = F.from_json("value", RAW_VIDEO, {"mode": "FAILFAST"})
    return (
        wanted.filter(F.trim("value") != "")
        .select(parsed.alias("_object"), "region", "ingest_date")
        .select("_object.*", "region", "ingest_date")
    )


def scan_manifest_batch(spark: SparkSession, manifest: str, raw_root: str) -> DataFrame:
    """Raw objects named by the manifest(s) at a path."""
    return scan_batches(spark, read_manifests(spark, manifest), raw_root)


def merge_batch(raw: DataFrame, lookups: DataFrame) -> DataFrame:
    """Raw objects of complete batches as flat chart rows with category names.

    ``lookups`` are the versions of ``scan_lookup_versions``: each batch is
    named by the lookup of its own date.
    """
    flat = flatten_nested(raw, region="region")
    named = lookup_as_of(flat, lookups, "category_id", "ingest_date", "title")
    return named.select(*FLAT_COLUMNS, "ingest_date")
