from __future__ import annotations

import datetime as dt

import pytest

from checks.compare import differences, open_oracle
from checks.sql_models import with_ctes
from checks.oracles import TEXTS
from lodestrata.plans import medallion
from lodestrata.schemas import LAYERS
from lodestrata.sources.sample import AS_OF as SAMPLE_DAY
from lodestrata.sources.sample import sample_bronze
from lodestrata.sources.tables import Lake
from tests.conftest import AS_OF, NOW, ROWS, by, feed


@pytest.fixture()
def lake(spark, tmp_path):
    found = Lake(spark, str(tmp_path / "lake"))
    for name in ROWS:
        found.publish(feed(spark, name), "bronze", name)
    return found


def run(lake, run_id="r1", ts=NOW):
    out = medallion.run_medallion(lake.spark, lake.root, AS_OF, ts, run_id)
    return [(r["step"], r["status"], r["message"]) for r in out.orderBy("step_no").collect()]


ORDER = ["bronze_gate", "bronze_profile", "silver_transform", "anomalies", "silver_gate",
         "gold_transform", "gold_enrichment", "gold_gate"]


def test_whole_run(lake):
    steps = run(lake)
    assert [s[0] for s in steps] == ORDER and {s[1] for s in steps} == {"DONE"}
    assert steps[-1][2] == "GATE 3 PASSED: Gold data certified for analytics consumption"
    for layer in ("silver", "gold"):
        for name in LAYERS[layer]:
            table = lake.read(layer, name)
            assert table.filter("_loaded_at is null").count() == 0
    assert lake.read("gold", "customer_rfm_scores").count() == 2
    summary = by(lake.read("gold", "pipeline_run_summary"), "table_name")
    assert len(summary) == 20 and summary["FACT_SALES"]["row_count"] == 4
    assert lake.read("bronze", "data_profile_log").count() == 141


def test_second_run_replaces_tables_and_adds_to_logs(lake):
    run(lake)
    run(lake, "r2", NOW + dt.timedelta(hours=1))
    assert lake.read("gold", "fact_sales").count() == 4
    assert lake.read("bronze", "data_profile_log").count() == 282
    flags = lake.read("silver", "anomaly_flags")
    assert flags.count() == 2 * flags.filter(f"detected_at = timestamp_ntz'{NOW}'").count() > 0


def test_failed_gate_skips_but_does_not_stop(spark, lake):
    lake.publish(feed(spark, "orders", ROWS["orders"] * 2), "bronze", "orders")
    steps = run(lake)
    assert [s[1] for s in steps] == ["DONE", "DONE", "SKIPPED", "SKIPPED", "SKIPPED", "SKIPPED",
                                     "DONE", "SKIPPED"]
    assert steps[2][2] == (
        "Silver transformation SKIPPED: Gate 1 did not pass. Result: "
        "GATE 1 FAILED (1 checks): FAIL: 4 duplicate order_ids. "
    )
    summary = by(lake.read("gold", "pipeline_run_summary"), "table_name")
    assert summary["STG_ORDERS"]["row_count"] == -1 and summary["ORDERS"]["row_count"] == 8


def test_old_tables_stay_when_a_later_gate_fails(spark, lake):
    run(lake)
    lake.publish(feed(spark, "customers", ROWS["customers"][:1]), "bronze", "customers")
    steps = run(lake, "r2")
    assert steps[2][1] == "DONE" and "1 orphan orders" in steps[4][2]
    assert steps[5][1] == "SKIPPED" and steps[6][1] == "DONE"
    # Gold is the one of the first run, so the last gate sees the difference
    assert "dim_customers rows (3) != stg_customers rows (1)" in steps[7][2]


def test_stored_tables_equal_the_oracle(spark, tmp_path):
    """A whole run over the sample feeds, with the plain counts the gate allows."""
    folder = "/root/testdata/sf0.001"
    lake = Lake(spark, str(tmp_path / "lake"))
    for name, df in sample_bronze(spark, folder).items():
        lake.publish(df, "bronze", name)
    noon = dt.datetime(2001, 8, 15, 12)
    medallion.run_medallion(spark, lake.root, SAMPLE_DAY, noon, "run-2")
    con = open_oracle(folder)
    stored = [("silver", n, n) for n in LAYERS["silver"]] + [("gold", n, n) for n in LAYERS["gold"]]
    stored += [
        ("gold", "customer_rfm_scores", "rfm_scores"),
        ("gold", "pipeline_run_summary", "run_summary"),
        ("silver", "anomaly_flags", "anomaly_flags"),
        ("bronze", "data_profile_log", "profile_table"),
    ]
    for layer, name, key in stored:
        frame = lake.read(layer, name).drop("_loaded_at")
        assert differences(frame, with_ctes(TEXTS[key]), con) == [], name
