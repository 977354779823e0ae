"""A warehouse folder whose tables change together.

Parquet knows no MERGE and no transactions.  So a load writes new folders and
then one small commit record naming the folders of every table.  Readers
follow the newest record: they see all of a load or nothing of it.  The record
also lists the dates loaded, so a date is claimed exactly when its data is
published.  One writer at a time; a second one fails on the commit record.

    <root>/<table>/v=<n>-<attempt>/...   data, never written twice
    <root>/commits/n=<n>/record.json     the commit record, one JSON line

Every attempt writes folders of its own, so one that loses or dies leaves those
of others alone.  The record is created in one step that fails if it is there.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

COMMIT = (
    "version int, dates array<string>, tables map<string,array<string>>,"
    " facts map<string,string>, high map<string,bigint>, ledger array<string>,"
    " rows map<string,bigint>"
)


class CommitConflict(RuntimeError):
    """The version to publish is already taken."""


@dataclass
class Commit:
    """One published state.

    ``tables`` maps a table to its folders, the oldest first, and ``rows`` a
    folder to its number of rows; ``facts`` maps a date to its fact folder,
    ``high`` a dimension to its largest key, ``ledger`` is every date loaded so
    far and ``dates`` those of this commit.  Folders are relative to the
    warehouse, so a copy of it stands on its own.
    """

    version: int = 0
    dates: list[str] = field(default_factory=list)
    tables: dict[str, list[str]] = field(default_factory=dict)
    facts: dict[str, str] = field(default_factory=dict)
    high: dict[str, int] = field(default_factory=dict)
    ledger: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)

    def newest_date(self) -> str | None:
        return max(self.ledger, default=None)


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and the optimizer knows it: joins and unions with it vanish."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)]
    return spark.range(1).select(*nulls).filter(F.lit(False))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def head(self) -> Commit:
        """The newest commit: its number from a listing, then one record of one row."""
        try:
            listing = self.spark.read.format("binaryFile").load(self.at("commits"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return Commit()
            raise
        if "n" not in listing.columns:
            return Commit()
        # the files are listed, not read
        newest = listing.agg(F.max("n")).first()[0]
        if newest is None:
            return Commit()
        records = self.spark.read.schema(COMMIT).json(self.at(f"commits/n={newest}")).take(2)
        if len(records) != 1:
            raise CommitConflict(f"commit {newest} has {len(records)} records or more, not one")
        row = records[0]
        # a record written before a field existed leaves it at its default
        return Commit(**{name: row[name] for name in Commit.__dataclass_fields__ if row[name] is not None})

    def at(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def write(self, df: DataFrame, table: str, version: int, by: str | None = None) -> str:
        """Write a table's folder of a version that is not committed yet.

        No two writes share a folder, whoever makes them.
        """
        folder = f"{table}/v={version}-{uuid.uuid4().hex[:12]}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(by) if by else writer).parquet(self.at(folder))
        return folder

    def read(self, folder: str, schema: str | T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.at(folder))

    def layers(self, commit: Commit, table: str, schema: str) -> list[DataFrame]:
        """The folders of a table in a commit, the oldest first; one without rows if it has none yet."""
        folders = commit.tables.get(table, [])
        return [self.read(folder, schema) for folder in folders] or [empty_table(self.spark, schema)]

    def fact(self, commit: Commit, schema: str) -> DataFrame:
        """The dated folders of a commit as one table, partitioned by ``ingest_date``."""
        paths = [self.at(commit.facts[d]) for d in sorted(commit.facts)]
        if not paths:
            return empty_table(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", self.at("fact"))
        return reader.parquet(*paths).drop("v")

    def publish(self, commit: Commit) -> Commit:
        """Make a version visible; fails if somebody else took its number."""
        path = self.at(f"commits/n={commit.version}/record.json")
        if not self._create_once(path, json.dumps(asdict(commit)) + "\n"):
            raise CommitConflict(f"{path} exists: another load took this version")
        return commit

    def _create_once(self, path: str, text: str) -> bool:
        """Create a file with all its text, or return False if it is there.

        The text goes to a hidden file first.  A local file system then links
        it, any other renames it without overwriting; both are one step.
        """
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        fs = target.getFileSystem(conf)
        if fs.getScheme() == "file":
            name = target.toUri().getPath()
            os.makedirs(os.path.dirname(name), exist_ok=True)
            hidden = os.path.join(os.path.dirname(name), f".{uuid.uuid4().hex}")
            with open(hidden, "x", encoding="utf-8") as file:
                file.write(text)
            try:
                os.link(hidden, name)
            except FileExistsError:
                return False
            finally:
                os.unlink(hidden)
            return True
        hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
        out = fs.create(hidden, False)
        out.write(text.encode())
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark._sc._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(hidden, target, options)
        except Py4JJavaError as error:
            fs.delete(hidden, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True
