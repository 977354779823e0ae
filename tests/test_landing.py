"""What the derived raw zone builds and writes."""

import glob

import pytest

from chartloom.plans import testbed as tb
from chartloom.plans.oracle import ORACLE
from chartloom.plans.registry import QUERIES
from compare import connect, differences
from test_whole_history import tables  # noqa: F401


def test_lookup_versions_build_no_charts(spark, tables, monkeypatch):  # noqa: F811
    folder = tables({1: ["2024-01-02"], 2: ["2024-01-03"]})
    monkeypatch.setattr(tb, "chart_root", lambda *_: pytest.fail("lookups do not come from the charts"))
    found = QUERIES["lookup_versions"](spark, folder)
    assert found.count() and differences(found, connect(folder), ORACLE["lookup_versions"]) == []


def test_raw_zone_is_compressed_and_read_whole(spark, tables):  # noqa: F811
    folder = tables({1: ["2024-01-02", "2024-01-10"], 2: ["2024-01-10"]})
    raw = f"{tb.landing_root(spark, folder)}/raw/region=view".removeprefix("file:")
    names = glob.glob(f"{raw}/ingest_date=*/part-*")
    assert len(names) == 2 and all(name.endswith(".json.gz") for name in names)
    found = QUERIES["stream_manifest_batches"](spark, folder)
    assert found.count() == 3 and differences(found, connect(folder), ORACLE["stream_manifest_batches"]) == []
