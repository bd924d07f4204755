from __future__ import annotations

import datetime as dt

from lodestrata.operators import gold, profiling, quality, reports
from lodestrata.operators import governance as gov
from lodestrata.plans import attachments as A
from lodestrata.plans.contracts import GOLD, SILVER, Column
from tests.conftest import AS_OF, NOW, ROWS, by, day, feed, money


def metrics(df):
    return {
        (r["table_name"], r["column_name"], r["metric"]): r["metric_value"] for r in df.collect()
    }


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id int, txt string")
    got = metrics(profiling.profile_table(df, "t", "r", NOW))
    assert got == {
        ("T", "*", "ROW_COUNT"): "3",
        ("T", "ID", "NULL_COUNT"): "0", ("T", "ID", "NULL_PCT"): "0.0",
        ("T", "ID", "DISTINCT_COUNT"): "3",
        ("T", "TXT", "NULL_COUNT"): "2", ("T", "TXT", "NULL_PCT"): "66.67",
        ("T", "TXT", "DISTINCT_COUNT"): "2",  # NULL is one value
    }
    assert metrics(profiling.profile_table(df, "t", "r", NOW, approx=True)) == got


def test_profile_of_an_empty_table(spark, bronze):
    empty = {"orders": feed(spark, "orders", []), "products": bronze["products"]}
    for approx in (False, True):
        got = metrics(profiling.profile_tables(empty, "r", NOW, approx))
        assert got["ORDERS", "*", "ROW_COUNT"] == "0"
        assert got["ORDERS", "STATUS", "NULL_PCT"] == "0.0"
        assert got["ORDERS", "STATUS", "DISTINCT_COUNT"] == "0"
        assert got["PRODUCTS", "STOCK_QUANTITY", "NULL_PCT"] == "33.33"


def test_profile_covers_every_feed_column(bronze):
    assert profiling.profile_tables(bronze, "r", NOW).count() == 6 + 3 * 45


def test_run_summary_marks_missing_tables(bronze):
    rows = profiling.run_summary(
        {"bronze": {"orders": bronze["orders"]}, "gold": {"fact_sales": None}}, "r", NOW
    ).collect()
    assert {(r["layer"], r["table_name"]): r["row_count"] for r in rows} == {
        ("BRONZE", "ORDERS"): 4, ("GOLD", "FACT_SALES"): -1,
    }


def layers(bronze, staged):
    return {"bronze": bronze, "silver": staged, "gold": gold.build_gold(staged, AS_OF)}


def test_suite_has_every_attachment(bronze, staged):
    out = quality.dq_suite(layers(bronze, staged), NOW)
    got = {(r["table_name"], r["metric_name"], r["argument_names"]): r["value"]
           for r in out.collect()}
    assert len(got) == 37
    assert got["ORDERS", A.ROWS, ""] == 4
    assert got["ORDERS", A.FRESHNESS, ""] == (NOW - day("2024-06-29")).total_seconds()


def test_suite_finds_defects(spark, bronze, staged):
    bronze["orders"] = feed(spark, "orders", [
        *ROWS["orders"],
        (10, 99, day("2024-06-01"), "x", "web", money("-1")),
        (None, None, day("2024-06-01"), "x", "web", None),
    ])
    out = quality.dq_suite(layers(bronze, staged), NOW, [a for a in A.ATTACHMENTS
                                                         if a[1] == "orders"])
    got = {r["metric_name"]: r["value"] for r in out.collect()}
    assert got[A.NULL] == 1 and got[A.DUPLICATE] == 1 and got[A.NEGATIVE] == 1
    assert got[A.CUSTOMER_FK] == 1  # the NULL customer is no foreign key failure


def log(spark, rows):
    return spark.createDataFrame(
        [("BRONZE", t, m, a, v, dt.datetime(2024, 1, d)) for t, m, a, v, d in rows],
        "table_schema string, table_name string, metric_name string, argument_names string, "
        "value string, measurement_time timestamp_ntz",
    )


def test_latest_status_and_scorecard(spark):
    results = log(spark, [
        ("ORDERS", A.NULL, "ID", "5", 1), ("ORDERS", A.NULL, "ID", "0", 2),
        ("ORDERS", A.DUPLICATE, "ID", "3", 1), ("ORDERS", A.ROWS, "", "0", 1),
        ("ITEMS", A.ROWS, "", "9", 1), ("ORDERS", A.FRESHNESS, "", "61", 1),
        ("ORDERS", A.NEGATIVE, "", "n/a", 1), ("ORDERS", "OTHER", "", "7", 1),
    ])
    status = quality.dq_status(quality.dq_latest(results))
    got = {(r["table_name"], r["metric_name"]): r["status"] for r in status.collect()}
    assert got == {
        ("ORDERS", A.NULL): "PASS", ("ORDERS", A.DUPLICATE): "FAIL (3)",
        ("ORDERS", A.ROWS): "EMPTY", ("ITEMS", A.ROWS): "OK", ("ORDERS", A.FRESHNESS): "61s ago",
        ("ORDERS", A.NEGATIVE): None, ("ORDERS", "OTHER"): "7",
    }
    card = quality.dq_scorecard(status, results).first().asDict()
    assert card == {"checks_passing": 2, "checks_failing": 1, "total_results": 8}
    trend = quality.dq_trend(results, A.NULL).collect()
    assert [(r["label"], r["value"]) for r in trend] == [("BRONZE.ORDERS", "5"),
                                                         ("BRONZE.ORDERS", "0")]


def test_contract_sizes():
    def tests(part):
        return (sum(c.unique for c in part), len(part), sum(c.parent is not None for c in part),
                sum(bool(c.accepted) for c in part))

    assert tests(SILVER) == (7, 31, 5, 7) and tests(GOLD) == (8, 31, 3, 5)


def test_contracts_hold_on_clean_tables(staged):
    out = quality.schema_tests({**staged, **gold.build_gold(staged, AS_OF)})
    assert out.count() == 97
    # customer 3 has no last name, hence no full name
    assert {(r["table_name"], r["column_name"]) for r in out.filter("not passed").collect()} == {
        ("stg_customers", "full_name"), ("dim_customers", "full_name"),
    }


def test_each_contract_kind_fires(spark):
    child = spark.createDataFrame([(1, "A"), (1, "Z"), (None, None), (5, "A")], "k int, v string")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    contracts = [Column("c", "k", unique=True, parent=("p", "k")), Column("c", "v", accepted=("A",))]
    out = quality.schema_tests({"c": child, "p": parent}, contracts)
    got = {(r["column_name"], r["test"]): r["failures"] for r in out.collect()}
    assert got == {
        ("k", "not_null"): 1, ("k", "unique"): 1, ("k", "relationships"): 1,
        ("v", "not_null"): 1, ("v", "accepted_values"): 1,
    }


# --------------------------------------------------------------- governance


def test_tag_tables(spark):
    tags = gov.tag_assignments(spark)
    assert tags.filter("domain = 'TABLE'").count() == 76
    assert tags.filter("domain = 'COLUMN'").count() == 11
    definitions = gov.tag_definitions(spark)
    assert gov.tag_validate(tags, definitions).count() == 0
    bad = spark.createDataFrame([("QUALITY_TIER", "SHINY")], "tag_name string, tag_value string")
    assert gov.tag_validate(bad, definitions).count() == 1


def test_coverage_reports_missing_tags(spark, bronze):
    inventory = gov.measured_inventory({"bronze": {**bronze, "extra": bronze["orders"]}})
    references = gov.tag_references(gov.tag_assignments(spark), inventory)
    assert references.count() == 6 * 4 + 4
    rows = gov.tag_coverage(references, inventory).collect()
    assert len(rows) == 28
    missing = [r for r in rows if not r["present"]]
    assert {r["full_name"] for r in missing} == {"BRONZE.EXTRA"}
    assert {r["value"] for r in missing} == {"MISSING"}
    assert gov.tag_references(gov.tag_assignments(spark, "OTHER"), inventory).count() == 0


def test_personal_columns(spark, bronze, staged):
    found = gov.pii_inventory(gov.tag_assignments(spark), layers(bronze, staged))
    held = {(r["schema_name"], r["column_name"]): r["values_held"] for r in found.collect()}
    assert len(held) == 11 and held["BRONZE", "LAST_NAME"] == 2
    marks = by(gov.pii_propagation(found), "pii_column")
    assert marks["PHONE"] == {
        "pii_column": "PHONE", "bronze": "Tagged", "silver": "Tagged", "gold": "-"
    }
    assert by(gov.pii_by_layer(found), "schema_name")["GOLD"]["pii_columns"] == 3


def test_row_count_consistency(spark):
    inventory = spark.createDataFrame(
        [("BRONZE", "ORDERS", 5), ("SILVER", "STG_ORDERS", 5), ("GOLD", "FACT_SALES", 5),
         ("BRONZE", "PRODUCTS", 5), ("SILVER", "STG_PRODUCTS", 4), ("GOLD", "DIM_PRODUCTS", 4),
         ("BRONZE", "CUSTOMERS", 1)],
        "table_schema string, table_name string, row_count bigint",
    )
    out = by(gov.row_count_consistency(inventory), "entity")
    assert out["ORDERS"]["match"] == "Yes" and out["PRODUCTS"]["match"] == "No"
    assert out["CUSTOMERS"]["gold"] == 0 and out["CUSTOMERS"]["match"] == "No"


def flags(spark):
    return spark.createDataFrame(
        [("1", "DORMANT_CUSTOMER", "STG_CUSTOMERS", "d", day("2024-01-01")),
         ("2", "AMOUNT_OUTLIER", "STG_ORDERS", "d", day("2024-01-02")),
         ("3", "AMOUNT_OUTLIER", "STG_ORDERS", "d", day("2024-01-02"))],
        "record_id string, anomaly_type string, table_name string, details string, "
        "detected_at timestamp_ntz",
    )


def test_anomaly_reports(spark):
    log_rows = flags(spark)
    assert gov.anomaly_kpis(log_rows).first().asDict() == {
        "total_anomalies": 3, "dormant_customers": 1, "amount_outliers": 2
    }
    assert [r["record_id"] for r in gov.anomaly_details(log_rows).collect()] == ["2", "3", "1"]
    assert gov.anomaly_details(log_rows, ["DORMANT_CUSTOMER"]).count() == 1
    assert gov.anomaly_timeline(log_rows).count() == 2
    totals = reports.rpt_anomaly_totals(reports.rpt_anomaly_summary(log_rows)).first()
    assert (totals["total_anomalies"], totals["anomaly_types"]) == (3, 2)


def test_profile_reports_skip_what_is_no_number(spark):
    rows = [("r1", "T", "A", "NULL_PCT", "9.5", 1), ("r2", "T", "A", "NULL_PCT", "0.0", 2),
            ("r2", "T", "B", "NULL_PCT", "2.5", 2), ("r2", "T", "*", "ROW_COUNT", "7", 2),
            ("r1", "T", "C", "NULL_PCT", "n/a", 1)]
    profile_log = spark.createDataFrame(
        [(*r[:5], dt.datetime(2024, 1, r[5])) for r in rows],
        "profile_run_id string, table_name string, column_name string, metric string, "
        "metric_value string, profiled_at timestamp_ntz",
    )
    high = gov.null_highlights(profile_log).collect()
    assert [(r["column_name"], r["null_pct"]) for r in high] == [("A", 9.5), ("B", 2.5)]
    latest = reports.rpt_latest_profile(profile_log)
    assert latest.count() == 3
    assert [r["column_name"] for r in reports.rpt_profile_nulls(latest).collect()] == ["B"]
    assert reports.rpt_profile_rows(latest).first()["row_count"] == 7


def test_payment_health_is_weighted(spark):
    payments = spark.createDataFrame(
        [("A", 3, money(1), money(0), money(0), 100.0), ("B", 1, money(1), money(2), money(3), 0.0)],
        "payment_outcome string, order_count bigint, total_completed decimal(12,2), "
        "total_refunded decimal(12,2), total_failed decimal(12,2), avg_success_rate double",
    )
    row = reports.rpt_payment_health(payments).first()
    assert row["success_rate"] == 75.0 and row["total_completed"] == 2


def test_segment_detail_both_ways(spark):
    segments = spark.createDataFrame(
        [("X", "GOLD", 3, 1, money(1), 10.0, 0.0), ("X", "SILVER", 1, 1, money(1), 30.0, 4.0)],
        "segment string, loyalty_tier string, customer_count bigint, total_orders bigint, "
        "total_spend decimal(12,2), avg_aov double, avg_cancel_rate double",
    )
    assert reports.rpt_segment_detail(segments).first()["avg_aov"] == 20.0
    assert reports.rpt_segment_detail(segments, weighted=True).first()["avg_aov"] == 15.0


def test_on_time_without_deliveries(spark):
    shipments = spark.createDataFrame(
        [("UPS", "IN_TRANSIT", "PENDING", 4, None, None, 1, 0)],
        "carrier string, shipment_status string, shipping_speed string, shipment_count bigint, "
        "avg_delivery_days double, avg_days_to_ship double, delayed_count bigint, "
        "delivered_count bigint",
    )
    row = reports.rpt_carrier_on_time(shipments).first()
    assert row["on_time_pct"] == -100.0 and row["avg_delivery_days"] is None
