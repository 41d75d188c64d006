"""Files that arrive, and landings clustered by update time."""

import json
from datetime import datetime

import pytest
from conftest import make_order
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderloom.operators import contract
from orderloom.sources import clustered
from orderloom.sources.store import Store
from orderloom.streaming import arrivals


def drop_file(folder, name, *rows):
    """A whole file appears at once."""
    folder.mkdir(exist_ok=True)
    hidden = folder / f".{name}"
    hidden.write_text("".join(json.dumps(row) + "\n" for row in rows))
    hidden.rename(folder / f"{name}.jsonl")


def order(number, **changes):
    return make_order(id=f"o{number}", lines__0__id=f"o{number}/1", **changes)


def counts(store):
    rows = store.manifests().orderBy("snapshot_id").collect()
    return [(r.snapshot_id, r.accepted_count, r.quality_gate) for r in rows]


def test_each_file_is_taken_once(spark, tmp_path):
    store, folder = Store(spark, str(tmp_path / "root")), tmp_path / "in"
    drop_file(folder, "a", order(1), order(2))
    arrivals.follow(store, str(folder), "shop")
    drop_file(folder, "b", order(3))
    arrivals.follow(store, str(folder), "shop")
    arrivals.follow(store, str(folder), "shop")
    assert counts(store) == [("shop-000000", 2, "passed"), ("shop-000001", 1, "passed")]


def test_a_crash_in_mid_batch_ends_in_the_same_snapshot(spark, tmp_path, monkeypatch):
    store, folder = Store(spark, str(tmp_path / "root")), tmp_path / "in"
    drop_file(folder, "a", order(1), order(2))
    judge = contract.judge

    def lost(*_):
        raise OSError("the disk is gone")

    monkeypatch.setattr(contract, "judge", lost)
    with pytest.raises(StreamingQueryException, match="the disk is gone"):
        arrivals.follow(store, str(folder), "shop")
    assert counts(store) == [] and store.is_complete("raw", snapshot_id="shop-000000")
    monkeypatch.setattr(contract, "judge", judge)
    drop_file(folder, "b", order(3))
    arrivals.follow(store, str(folder), "shop")
    assert counts(store) == [("shop-000000", 2, "passed"), ("shop-000001", 1, "passed")]


def test_a_refused_batch_stops_the_stream_or_is_left_behind(spark, tmp_path):
    store, folder = Store(spark, str(tmp_path / "root")), tmp_path / "in"
    drop_file(folder, "a", order(1, status="SOLD"))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="refused"):
            arrivals.follow(store, str(folder), "shop")
    drop_file(folder, "b", order(3))
    arrivals.follow(store, str(folder), "shop", max_files=1, stop_at_refused=False)
    assert counts(store) == [("shop-000000", 0, "failed"), ("shop-000001", 1, "passed")]


def test_clustered_windows_read_their_months(spark, tmp_path):
    times = [datetime(2025, 1 + n % 12, 1 + n % 28, n % 24) for n in range(500)] + [None] * 3
    rows = [(n, at, f"x{n}") for n, at in enumerate(times)]
    source = spark.createDataFrame(rows, "n long, at timestamp_ntz, update_note string")
    path = str(tmp_path / "landed")
    clustered.write_clustered(source, path, "at")
    assert spark.read.parquet(path).count() == 503
    for mode, lower, upper, folders in [
        ("backfill", "2025-03-01T00:00:00+00:00", "2025-04-01T00:00:00+00:00", 1),
        ("incremental", "2025-03-01T00:00:00+00:00", "2025-04-01T00:00:00+00:00", 2),
        ("full", None, "2025-02-10T00:00:00+00:00", 2),
        ("backfill", "2024-03-01T00:00:00+00:00", "2024-04-01T00:00:00+00:00", 0),
    ]:
        window = {"mode": mode, "lower": lower, "upper": upper}
        found = clustered.read_clustered(spark, path, source.schema, window, "at")
        first = datetime.fromisoformat(lower or "2000-01-01T00:00:00+00:00").replace(tzinfo=None)
        last = datetime.fromisoformat(upper).replace(tzinfo=None)
        want = {n for n, at, _ in rows if at and first <= at and (at < last or mode != "backfill" and at == last)}
        assert found.columns == source.columns and {r.n for r in found.collect()} == want
        assert clustered.folders_read(found) == folders
    plan = found.filter(F.col("n") > 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(update_month" in plan
