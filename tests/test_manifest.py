"""All zones of a micro-batch appear together, whatever step a driver is lost at."""

import os
import re

import pytest

from meterlens.sources.catalog import create_database, read_zone, register_zone
from meterlens.sources.events import kafka_records
from meterlens.sources.manifest import drop_unpublished, published
from meterlens.streaming import zones
from meterlens.streaming.zones import ZonePaths, write_epoch
from tests.conftest import SF001

ZONES = (("raw", "raw_readings"), ("processed", "meter_features"), ("alerts", "fraud_alerts"))


def _paths(scratch):
    return ZonePaths(*[os.path.join(scratch, z) for z, _ in ZONES], os.path.join(scratch, "ck"))


def _counts(spark, paths):
    return [read_zone(spark, getattr(paths, z), t).count() for z, t in ZONES]


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["raw", "processed", "alerts", "publish"])
def test_a_lost_driver_leaves_nothing_to_read(spark, scratch, monkeypatch, step):
    paths, batch = _paths(scratch), kafka_records(spark, SF001).filter("offset < 50")
    assert write_epoch(batch, "q-0", paths)
    first = _counts(spark, paths)
    assert first[0] == first[1] == 150 and 0 < first[2] < 150
    if step == "publish":
        def lose(*_):
            raise Lost
        monkeypatch.setattr(zones, "publish", lose)
    else:  # the zone's folder can't be written
        os.rename(getattr(paths, step), getattr(paths, step) + "_aside")
        with open(getattr(paths, step), "w"):
            pass
    more = kafka_records(spark, SF001).filter("offset >= 50")
    with pytest.raises(Exception):
        write_epoch(more, "q-1", paths)
    monkeypatch.undo()
    if step != "publish":
        os.remove(getattr(paths, step))
        os.rename(getattr(paths, step) + "_aside", getattr(paths, step))
    assert _counts(spark, paths) == first  # rows of some zones are there, and no reader follows them
    assert write_epoch(more, "q-1", paths)  # the replay
    full = _counts(spark, paths)
    assert full[0] == full[1] == 1000
    assert not write_epoch(more, "q-1", paths) and _counts(spark, paths) == full
    assert len(published(spark, paths.manifest)) == 2
    create_database(spark, f"manifest_{step}", os.path.join(scratch, "db"))
    for z, t in ZONES:  # a catalog view follows the manifest too, also for later epochs
        register_zone(spark, f"manifest_{step}", t, getattr(paths, z))
    seen = [spark.table(f"manifest_{step}.{t}").count() for _, t in ZONES]
    assert seen == full and write_epoch(more.limit(3), "q-2", paths)
    full = _counts(spark, paths)
    assert [spark.table(f"manifest_{step}.{t}").count() for _, t in ZONES] == full and full[0] == 1003
    for z, _ in ZONES:
        drop_unpublished(spark, getattr(paths, z))
    assert _counts(spark, paths) == full


def test_dates_are_still_pruned(spark, scratch):
    paths = _paths(scratch)
    write_epoch(kafka_records(spark, SF001), "q-0", paths, files_per_partition=2)
    zone = read_zone(spark, paths.processed, "meter_features")
    day = zone.agg({"date": "min"}).first()[0]
    one = zone.filter(zone.date == day)
    assert re.search(r"PartitionFilters: \[[^]]*date#\d+ = ", one._jdf.queryExecution().executedPlan().toString())
    assert 0 < one.count() < zone.count()
    assert "_epoch" not in zone.columns
