"""The daily load and its backlog form.

A load takes one or many staged days and carries every table through them in
one set of jobs, however many days: a backlog costs one pass, not one rewrite
of the dimensions per day.  ``run_day`` is that with one day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions import iso_instant
from chartloom.operators import checks
from chartloom.operators.bridge import bridge_links, bridge_rows
from chartloom.operators.calendar import absent_tags, calendar_dim, insert_absent
from chartloom.operators.fact import fact_rows, rejected_rows, resolve_keys, with_fact_keys
from chartloom.operators.keys import highest_key, number_rows
from chartloom.operators.scd import OutOfOrderBatch, scd1_changes, scd2_advance
from chartloom.plans.layers import all_rows, merge_from, newest_rows, rows_of_keys
from chartloom.plans.store import Commit, Store

CATEGORY = "category_key bigint, category_id string, category_name string"
REGION = "region_key bigint, region_code string, region_name string"
TAG = "tag_key bigint, tag_name string"
BRIDGE = "video_id string, video_key bigint, tag_keys array<bigint>"
_PERIOD = "valid_from date, valid_to date, is_current boolean"
CHANNEL = f"channel_key bigint, channel_id string, channel_title string, {_PERIOD}"
VIDEO = (
    "video_key bigint, video_id string, video_title string,"
    f" published_at timestamp, {_PERIOD}"
)

SCHEMAS = {
    "dim_category": CATEGORY,
    "dim_region": REGION,
    "dim_tag": TAG,
    "bridge": BRIDGE,
    "dim_channel_open": CHANNEL,
    "dim_channel_closed": CHANNEL,
    "dim_video_open": VIDEO,
    "dim_video_closed": VIDEO,
}
# Tables in which a newer row of a key replaces an older one; the others only grow.
KEYS = {
    "dim_category": ["category_id"],
    "dim_channel_open": ["channel_id"],
    "dim_video_open": ["video_id"],
    "bridge": ["video_id"],
}
# Ids of a load that may be broadcast, some 10 MB; more of them join by shuffle.
BROADCAST_IDS = 200_000
FACT = (
    "fact_key bigint, video_key bigint, channel_key bigint, category_key bigint,"
    " region_key bigint, date_key int, video_id string, region_code string,"
    " view_count bigint, like_count bigint, comment_count bigint, regional_rank int,"
    " pulled_at timestamp, ingest_date date"
)

# The seeded regions and the calendar's span.
SEED_REGIONS = [
    ("SA", "Saudi Arabia"),
    ("AE", "United Arab Emirates"),
    ("KW", "Kuwait"),
    ("QA", "Qatar"),
    ("BH", "Bahrain"),
    ("OM", "Oman"),
]
CALENDAR = ("2026-01-01", "2030-12-31")


class EmptyBatch(ValueError):
    """A day to load has no staged rows; it stays unclaimed."""


class Warehouse:
    """The star schema kept in a ``Store``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        regions: list[tuple[str, str]] | None = None,
        calendar: tuple[str, str] = CALENDAR,
    ):
        self.spark = spark
        self.store = Store(spark, root)
        self.regions = SEED_REGIONS if regions is None else regions
        self.calendar = calendar

    # -- reading ---------------------------------------------------------

    def table(self, name: str, commit: Commit | None = None) -> DataFrame:
        """A dimension or the bridge; type-2 dimensions with all versions.

        Open and closed versions lie apart: a load meets open ones only.
        """
        if name == "dim_date":
            return calendar_dim(self.spark, *self.calendar)
        commit = commit or self.store.head()
        if name in ("dim_channel", "dim_video"):
            return self._part(commit, f"{name}_open").unionByName(
                self._part(commit, f"{name}_closed")
            )
        rows = self._part(commit, name)
        return bridge_links(rows) if name == "bridge" else rows

    def fact(self) -> DataFrame:
        """The fact over all loaded dates; a filter on ``ingest_date`` prunes."""
        return self.store.fact(self.store.head(), FACT)

    def ledger(self) -> DataFrame:
        """The dates loaded so far."""
        days = [(d,) for d in self.store.head().ledger]
        return self.spark.createDataFrame(days, "ingest_date string").select(
            F.col("ingest_date").cast("date")
        )

    def _layers(self, commit: Commit, name: str) -> list[DataFrame]:
        return self.store.layers(commit, name, SCHEMAS[name])

    def _part(self, commit: Commit, name: str) -> DataFrame:
        layers = self._layers(commit, name)
        return newest_rows(layers, KEYS[name]) if name in KEYS else all_rows(layers)

    # -- loading ---------------------------------------------------------

    def run_day(
        self, staging: DataFrame, day: str | dt.date, reprocess: bool = False
    ) -> Commit | None:
        """Load one day of ``staging``; None if the ledger already has it.

        ``reprocess`` loads the newest day again.  An older day raises
        ``OutOfOrderBatch``: rebuild from history instead.
        """
        head = self.store.head()
        if str(day) in head.ledger and not reprocess:
            return None
        on_day = staging.filter(F.col("ingest_date") == F.lit(str(day)).cast("date"))
        return self._load(head, on_day, [str(day)])

    def backfill(self, staging: DataFrame) -> Commit | None:
        """Load every staged day that the ledger lacks; None if there is none."""
        head = self.store.head()
        days = unprocessed_batches(staging.select("ingest_date").distinct(), self.ledger())
        # one row per day
        wanted = sorted(str(r[0]) for r in days.collect())
        if not wanted:
            return None
        fresh = staging.filter(
            F.col("ingest_date").isin(*[F.lit(d).cast("date") for d in wanted])
        )
        return self._load(head, fresh, wanted)

    def rebuild(self, staging: DataFrame) -> Commit | None:
        """Load all of ``staging`` into an empty state: places late days right.

        Surrogate keys are handed out anew, and the facts with them.
        """
        days = sorted(str(r[0]) for r in staging.select("ingest_date").distinct().collect())
        return self._load(Commit(version=self.store.head().version), staging, days)

    def _load(self, head: Commit, staging: DataFrame, days: list[str]) -> Commit:
        if not days:
            raise EmptyBatch("no staged days to load")
        newest = head.newest_date()
        if newest is not None and days[0] < newest:
            raise OutOfOrderBatch(f"{days[0]} is older than the loaded {newest}: rebuild")
        version = head.version + 1
        store = self.store

        # Everything below reads the staged days several times: write them once.
        staged = store.read(store.write(staging, "staging", version), staging.schema)
        # one row per day
        present = {str(r[0]) for r in staged.select("ingest_date").distinct().collect()}
        if absent := [day for day in days if day not in present]:
            raise EmptyBatch(f"no staged rows on {', '.join(absent)}")
        dated = staged.select(
            "ingest_date",
            "video_id",
            "video_title",
            iso_instant("published_at").alias("published_at"),
            "channel_id",
            "channel_title",
            "category_id",
            "category_name",
        )
        checks.enforce(self._gates(staged, dated))

        new = replace(
            head,
            version=version,
            dates=days,
            tables=dict(head.tables),
            facts=dict(head.facts),
            high=dict(head.high),
            ledger=sorted({*head.ledger, *days}),
            rows=dict(head.rows),
        )
        _, channel, video = self._together(
            lambda: self._load_type1(head, new, staged, dated),
            lambda: self._load_type2(head, new, dated, "channel", ["channel_title"]),
            lambda: self._load_type2(
                head, new, dated, "video", ["video_title", "published_at"]
            ),
        )
        # The bridge needs both the versions and the tags of these days.
        last = self._last_rows(staged) if len(days) > 1 else staged
        # of the tags, those of these days
        named = staged.select(F.explode("video_tags").alias("tag_name")).distinct()
        tag = self._part(new, "dim_tag").join(named, "tag_name", "left_semi")
        bridge, fact = self._together(
            lambda: self._load_bridge(new, last, video, tag),
            lambda: self._load_fact(head, new, staged, video, channel),
        )
        checks.enforce(self._quality(new, staged, last, fact, video, channel, bridge, tag))
        self._compact(new)
        return store.publish(new)

    def _together(self, *steps: Callable[[], object]) -> list:
        """Run steps that do not need each other at the same time.

        Small tables would leave a cluster idle one after another.
        """
        with ThreadPoolExecutor(len(steps)) as pool:
            # each thread gets a copy of its own of the job properties
            running = [pool.submit(inheritable_thread_target(self.spark)(s)) for s in steps]
            return [step.result() for step in running]

    @staticmethod
    def _last_rows(staged: DataFrame) -> DataFrame:
        """Each video's rows of the last staged day it was seen."""
        last = staged.groupBy("video_id").agg(F.max("ingest_date").alias("ingest_date"))
        return staged.join(last, ["video_id", "ingest_date"], "left_semi")

    def _add(self, new: Commit, name: str, folder: str, rows: int) -> None:
        """Lay a folder over a table; an empty one is left out."""
        if rows:
            new.tables[name] = [*new.tables.get(name, []), folder]
            new.rows[folder] = rows

    def _put(self, new: Commit, name: str, df: DataFrame) -> DataFrame:
        """Write rows of these days as a layer, and return them as written."""
        folder = self.store.write(df, name, new.version)
        written = self.store.read(folder, SCHEMAS[name])
        self._add(new, name, folder, written.count())  # from file footers
        return written

    def _compact(self, new: Commit) -> None:
        """Merge layers whose rows are outweighed by newer ones."""
        for name, folders in list(new.tables.items()):
            first = merge_from([new.rows.get(folder, 0) for folder in folders])
            if first is None:
                continue
            kept = folders[:first]
            layers = self._layers(replace(new, tables={name: folders[first:]}), name)
            new.tables[name] = kept
            self._put(new, name, newest_rows(layers, KEYS[name]) if name in KEYS else all_rows(layers))
        named = {folder for folders in new.tables.values() for folder in folders}
        new.rows = {folder: n for folder, n in new.rows.items() if folder in named}

    def _ids(self, dated: DataFrame, name: str, version: int) -> DataFrame:
        """The ids of these days, written, and marked for broadcast if they are few."""
        ids = dated.select(name).distinct()
        written = self.store.read(self.store.write(ids, f"{name}s", version), ids.schema)
        return F.broadcast(written) if written.count() <= BROADCAST_IDS else written

    def _load_type1(
        self, head: Commit, new: Commit, staged: DataFrame, dated: DataFrame
    ) -> None:
        # distinct first: hashed, while the newest text per id has to be sorted for
        seen = dated.select("category_id", "category_name", "ingest_date").distinct()
        names = seen.groupBy("category_id").agg(
            F.max_by("category_name", "ingest_date").alias("category_name")
        )
        known = rows_of_keys(
            self._layers(head, "dim_category"), ["category_id"], names.select("category_id")
        )
        changes = scd1_changes(
            known, names, ["category_id"], ["category_name"], "category_key", head.high.get("dim_category", 0)
        )
        # tags are never changed, so only the new ones are written
        fresh = absent_tags(
            self._part(head, "dim_tag"), staged, head.high.get("dim_tag", 0)
        )
        for name, key, rows in (("dim_category", "category_key", changes), ("dim_tag", "tag_key", fresh)):
            written = self._put(new, name, rows)
            new.high[name] = max(head.high.get(name, 0), highest_key(written, key))
        if "dim_region" not in head.tables:
            seeds = [(i, c, n) for i, (c, n) in enumerate(self.regions, start=1)]
            rows = self.spark.createDataFrame(seeds, REGION)
            self._put(
                new,
                "dim_region",
                insert_absent(self._part(head, "dim_region"), rows, ["region_code"]),
            )

    def _load_type2(
        self, head: Commit, new: Commit, dated: DataFrame, entity: str, attrs: list[str]
    ) -> DataFrame:
        """Advance a versioned dimension; returns the versions of these days' ids.

        Those that are open or were closed in these days, that is: all a load
        ever needs, as versions closed earlier end on or before its first day.
        """
        name, key, natural = f"dim_{entity}", f"{entity}_key", f"{entity}_id"
        open_now = rows_of_keys(
            self._layers(head, f"{name}_open"), [natural], self._ids(dated, natural, new.version)
        )
        moved = scd2_advance(open_now, dated, [natural], attrs, "ingest_date", key)
        # written before numbering, which reads it twice
        unkeyed = self.store.read(
            self.store.write(moved, f"{name}_unkeyed", new.version), moved.schema
        )
        opened = number_rows(
            unkeyed.filter(F.col(key).isNull()).drop(key),
            [natural, "valid_from"],
            key,
            head.high.get(name, 0),
        )
        keyed = unkeyed.filter(F.col(key).isNotNull()).unionByName(
            opened.select(*moved.columns)
        )
        # one write, the open and the closed versions apart by folder
        folder = self.store.write(
            keyed.withColumn("state", F.when(F.col("is_current"), "open").otherwise("closed")),
            name,
            new.version,
            by="state",
        )
        versions = self.store.read(folder, f"{SCHEMAS[f'{name}_open']}, state string")
        is_open = F.when(F.col("is_current"), 1)
        highest, rows, opens = versions.agg(F.max(key), F.count(F.lit(1)), F.count(is_open)).first()
        self._add(new, f"{name}_open", f"{folder}/state=open", opens)
        self._add(new, f"{name}_closed", f"{folder}/state=closed", rows - opens)
        new.high[name] = max(head.high.get(name, 0), highest or 0)
        return versions.drop("state")

    def _load_bridge(
        self, new: Commit, last: DataFrame, video: DataFrame, tag: DataFrame
    ) -> DataFrame:
        return bridge_links(self._put(new, "bridge", bridge_rows(last, video, tag)))

    def _load_fact(
        self, head: Commit, new: Commit, staged: DataFrame, video: DataFrame, channel: DataFrame
    ) -> DataFrame:
        store = self.store
        marked = resolve_keys(
            staged,
            video,
            channel,
            self._part(new, "dim_category"),
            self._part(new, "dim_region"),
            self.table("dim_date", new),
        )
        # written before numbering, which reads it twice
        resolved = store.read(store.write(marked, "resolved", new.version), marked.schema)
        rejected = rejected_rows(resolved)
        lost = rejected.groupBy("missing").count().orderBy("missing").collect()  # a row per dimension
        if lost:
            folder = store.write(rejected, "rejects", new.version)
            counts = ", ".join(f"{row['count']} rows have no {row.missing}" for row in lost)
            raise checks.QualityError(f"row_reconciliation: {counts}; see {store.at(folder)}")
        again = {d: head.facts[d] for d in new.dates if d in head.facts}
        loaded = store.fact(replace(head, facts=again), FACT) if again else None
        numbered = with_fact_keys(fact_rows(resolved), loaded, head.high.get("fact", 0))
        columns = store.fact(Commit(), FACT).columns
        folder = store.write(
            numbered.select(*columns).hint("rebalance", F.col("ingest_date")), "fact", new.version, by="ingest_date"
        )
        new.facts.update({d: f"{folder}/ingest_date={d}" for d in new.dates})
        fact = store.read(folder, FACT)
        new.high["fact"] = max(head.high.get("fact", 0), highest_key(fact, "fact_key"))
        return fact

    # -- gates -----------------------------------------------------------

    def _gates(self, staged: DataFrame, dated: DataFrame) -> list[DataFrame]:
        """What must hold of a batch before any dimension is touched."""
        grain = ["video_id", "region_code", "ingest_date"]
        functional = checks.check_batch_functional
        return [
            checks.check_not_null(
                staged,
                [*grain, "video_title", "published_at", "channel_id", "channel_title",
                 "category_id", "category_name", "regional_rank", "pulled_at"],
                "staging_not_null",
            ),
            checks.check_unique(staged, grain, "staging_grain"),
            functional(dated, ["video_id", "ingest_date"], ["video_title", "published_at"],
                       "one_title_per_video"),
            functional(dated, ["channel_id", "ingest_date"], ["channel_title"],
                       "one_title_per_channel"),
            functional(dated, ["category_id", "ingest_date"], ["category_name"],
                       "one_name_per_category"),
        ]

    def _quality(
        self,
        new: Commit,
        staged: DataFrame,
        last: DataFrame,
        fact: DataFrame,
        video: DataFrame,
        channel: DataFrame,
        bridge: DataFrame,
        tag: DataFrame,
    ) -> list[DataFrame]:
        """What must hold of a load before it is published.

        All tables are those of the loaded days: their ids' versions, links and
        tags.  What else the warehouse holds was checked by the load that wrote it.
        """
        fk = checks.check_foreign_keys
        keys = ["video_key", "channel_key", "category_key", "region_key", "date_key"]
        return [
            checks.check_row_reconciliation(staged, fact),
            checks.check_unique(fact, ["video_id", "region_code", "ingest_date"], "fact_grain"),
            checks.check_not_null(fact, [*keys, "regional_rank", "pulled_at"], "fact_not_null"),
            checks.check_single_current(video, ["video_id"], "video_single_current"),
            checks.check_single_current(channel, ["channel_id"], "channel_single_current"),
            checks.check_unique(video, ["video_key"], "video_key"),
            checks.check_unique(channel, ["channel_key"], "channel_key"),
            checks.check_periods(video, ["video_id"], "video_periods"),
            checks.check_periods(channel, ["channel_id"], "channel_periods"),
            checks.check_unique(self._part(new, "dim_category"), ["category_id"], "category_id"),
            checks.check_unique(tag, ["tag_name"], "tag_name"),
            checks.check_unique(bridge, ["video_key", "tag_key"], "bridge_pair"),
            fk(bridge, "video_key", video.filter("is_current"), "video_key", "bridge_video"),
            fk(bridge, "tag_key", tag, "tag_key", "bridge_tag"),
            checks.check_bridge_complete(bridge, last, video, tag),
        ]


def unprocessed_batches(batches: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct batch dates that the ledger lacks: each date is loaded once."""
    return batches.select("ingest_date").distinct().join(ledger, "ingest_date", "left_anti")
