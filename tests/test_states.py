"""States of single writes, merged, against a pass over the whole tables."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from checks.queries import Layers, layer_queries
from lodestrata.operators import profiling, quality, states
from lodestrata.plans import attachments as A
from lodestrata.sources.tables import Lake
from tests.conftest import NOW, ROWS, day, feed, money

BRONZE = {"bronze": list(ROWS)}


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def lost(lake, layer, name):
    """From now on the table's data can't be read."""
    for x in lake.history(layer, name):
        lake.spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(f"{lake.root}/{x.folder}")


def test_a_new_file_costs_its_own_scan_only(spark, lake):
    for name in ROWS:
        lake.append_log(feed(spark, name, ROWS[name][:-1]), "bronze", name, "d1")
    assert states.keep_states(lake, BRONZE) == 6 and states.keep_states(lake, BRONZE) == 0
    full = {name: feed(spark, name) for name in ROWS}
    for name in ROWS:
        lost(lake, "bronze", name)
        lake.append_log(feed(spark, name, ROWS[name][-1:]), "bronze", name, "d2")
    assert states.keep_states(lake, BRONZE) == 6
    for name in ROWS:
        lost(lake, "bronze", name)
    got = sorted(tuple(x) for x in states.profile_from_states(lake, list(ROWS), "r", NOW).collect())
    assert got == sorted(tuple(x) for x in profiling.profile_tables(full, "r", NOW).collect())
    chosen = [a for a in A.ATTACHMENTS if a[0] == "bronze" and a[2] in states.MERGED]
    got = sorted(tuple(x) for x in states.metrics_from_states(lake, NOW, chosen).collect())
    assert got == sorted(tuple(x) for x in quality.dq_suite({"bronze": full}, NOW, chosen).collect())


def test_states_follow_the_versions(spark, lake):
    """A replaced table, and a run that is repeated, are measured as they now are."""
    orders = ROWS["orders"]
    lake.append_log(feed(spark, "orders", orders[:3]), "bronze", "orders", "d1")
    states.keep_states(lake, BRONZE)
    lake.append_log(feed(spark, "orders", orders[:2]), "bronze", "orders", "d1")
    states.keep_states(lake, BRONZE)

    def rows():
        return {x.rows for x in states.merged_states(lake, BRONZE).collect()}

    assert rows() == {2}
    lake.publish(feed(spark, "orders", []), "bronze", "orders")
    assert states.keep_states(lake, BRONZE) == 1 and rows() == {0}
    lake.append_log(feed(spark, "orders"), "bronze", "orders", "d1")
    # Kept twice, as by two runs at a time: each folder counts once.
    states.keep_states(lake, BRONZE)
    again = lake.read(states.LAYER, states.TABLE)
    lake.append_log(again, states.LAYER, states.TABLE)
    assert rows() == {4}


def test_sketches_merge_to_that_of_the_whole(spark, lake):
    rng = random.Random(1)
    rows = [(i, rng.randrange(3000), day("2024-06-01") + dt.timedelta(seconds=rng.randrange(10**6)), "a", None,
             money(rng.randrange(-500, 500))) for i in range(6000)]
    for part in range(4):
        lake.append_log(feed(spark, "orders", rows[part::4]), "bronze", "orders", f"d{part}")
    assert states.keep_states(lake, BRONZE) == 4
    got = {x.column_name: x for x in states.merged_states(lake, BRONZE).collect()}
    for spot, name in enumerate(feed(spark, "orders", []).columns):
        values = [x[spot] for x in rows if x[spot] is not None]
        assert abs(got[name].distincts - len(set(values))) <= 0.05 * len(set(values)) + 1
        assert got[name].nulls == len(rows) - len(values) and got[name].rows == 6000
    assert got["total_amount"].negatives == sum(x[5] < 0 for x in rows)
    assert got["order_date"].newest == max(x[2] for x in rows)


def test_the_exact_profile_beside_states_reads_stored_tables(spark, bronze, monkeypatch):
    read, real = [], profiling.profile_tables

    def spy(tables, *rest):
        read.extend(df.inputFiles() for df in tables.values())
        return real(tables, *rest)

    monkeypatch.setattr(profiling, "profile_tables", spy)
    assert not layer_queries()["profile_states"](Layers(spark, "own rows", bronze)).isEmpty()
    assert len(read) == 6 and all(read)
