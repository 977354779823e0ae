"""Which part of the chart a question is about."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.schemas import CHART, ChartColumns


@dataclass(frozen=True)
class Scope:
    """One ingest date (or all of them) and a set of regions (or all of them)."""

    date: str | dt.date | None = None
    regions: tuple[str, ...] | None = None

    def all_days(self) -> Scope:
        return Scope(None, self.regions)

    def region_list(self) -> tuple[str, ...]:
        """The regions in code order, for operators that compare regions."""
        if not self.regions:
            raise ValueError("this operator compares regions: name them in the scope")
        return tuple(sorted(set(self.regions)))


def scope_filter(df: DataFrame, scope: Scope, cols: ChartColumns = CHART) -> DataFrame:
    """Rows inside the scope.  On a dated table the date prunes partitions."""
    if scope.date is not None:
        df = df.filter(F.col(cols.date) == F.lit(str(scope.date)).cast("date"))
    if scope.regions is not None:
        df = df.filter(F.col(cols.region).isin(*scope.regions))
    return df


def available_dates(df: DataFrame, cols: ChartColumns = CHART) -> DataFrame:
    """Collected dates, newest first."""
    return df.select(cols.date).distinct().orderBy(F.desc(cols.date))
