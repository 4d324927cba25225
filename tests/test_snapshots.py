"""Versioned exports read back: newest complete, as of a time, versions with other columns."""
import os

import pytest

from latticeguard.operators.reports import export_versioned
from latticeguard.sources.snapshots import read_snapshot, snapshots


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("exports"))
    old = spark.createDataFrame([(1, "a", "1.1"), (2, None, "1.1")], "id long, x string, schema_version string")
    new = spark.createDataFrame([(3, 7, "1.10")], "id long, y int, schema_version string")
    export_versioned(old, root, "20260101T000000-aa")
    export_versioned(old.where("id = 1"), root, "20260201T000000-bb")
    export_versioned(new, root, "20260201T000000-bb")
    unfinished = export_versioned(new, root, "20260301T000000-cc")
    export_versioned(old, root, "20260301T000000-cc")
    os.remove(os.path.join(unfinished, "_SUCCESS"))
    return root


def test_newest_complete_merges_versions(spark, root):
    got = read_snapshot(spark, root)
    assert sorted(map(tuple, got.select("id", "x", "y", "schema_version").collect())) == [
        (1, "a", None, "1.1"), (3, None, 7, "1.10")]
    assert list(snapshots(spark, root)) == ["20260101T000000-aa", "20260201T000000-bb"]


def test_as_of(spark, root):
    for moment in ("20260101T000000", "20260131T235959"):
        assert sorted(r["id"] for r in read_snapshot(spark, root, moment).collect()) == [1, 2]
    assert sorted(r["id"] for r in read_snapshot(spark, root, "20991231T000000").collect()) == [1, 3]


def test_nothing_there(spark, root):
    for where, moment in ((root, "20251231T000000"), (root + "/none", None)):
        with pytest.raises(FileNotFoundError):
            read_snapshot(spark, where, moment)
