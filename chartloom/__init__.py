"""Chartloom: Spark-native processing of ranked daily charts.

The event everywhere is *one entity, in one region's chart, on one ingest
date*.  Operators take and return DataFrames; nothing runs until the caller
acts on the result, except where a docstring says a step is written first.
"""

from chartloom.schemas import CHART, ChartColumns
from chartloom.operators.scope import Scope
from chartloom.session import build_session, configure

__all__ = ["CHART", "ChartColumns", "Scope", "build_session", "configure"]
