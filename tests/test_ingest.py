from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.changes import snapshot_diff
from lodestrata.schemas import BRONZE
from lodestrata.session import fresh_dir, shared_dir, sized_for, tune
from lodestrata.sources import csv_feed
from lodestrata.sources.tables import Lake
from lodestrata.streaming import ingest
from tests.conftest import NOW, ROWS, by, day, feed, money

HEADER = "a,b,c,d,e,f\n"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{line}\n" for line in lines))


def test_csv_rules(spark, tmp_path):
    write(
        tmp_path, "orders.csv",
        '1, 7 ,2024-01-02 03:04:05," done, ""ok"" ",web,12.50',
        '2,,,"",  ,',
        "x,7,not a time,done,web,twelve",
    )
    df = csv_feed.read_bronze_csv(spark, str(tmp_path), "orders", keep_bad_lines=True)
    rows = df.orderBy(F.col("order_id").asc_nulls_last()).collect()
    first = rows[0].asDict()
    assert first["customer_id"] == 7 and first["order_date"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert first["status"] == 'done, "ok"' and first["total_amount"] == Decimal("12.50")
    assert first[csv_feed.BAD_LINE] is None
    assert list(rows[1])[1:6] == [None] * 5 and rows[1][csv_feed.BAD_LINE] is None
    bad = rows[2].asDict()
    assert bad["order_id"] is None and bad["total_amount"] is None and bad["customer_id"] == 7
    assert bad[csv_feed.BAD_LINE].startswith("x,7,")


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path, "orders.csv", '1,7,2024-01-02 00:00:00,"two\nlines",web,1.00')
    df = csv_feed.read_bronze_csv(spark, str(tmp_path), "orders", multi_line=True)
    assert [r["status"] for r in df.collect()] == ["two\nlines"]


@pytest.mark.parametrize(
    "table, name, taken",
    [("customers", "customers.csv", True), ("customers", "customers_v2.csv", True),
     ("orders", "orders.csv", True), ("orders", "orders_v2.csv", True),
     ("orders", "order_items.csv", False), ("orders", "orders_backup.csv", False),
     ("order_items", "order_items_v3.csv", True), ("order_items", "orders.csv", False),
     ("payments", "payments.csv.tmp", False)],
)
def test_file_patterns(spark, tmp_path, table, name, taken):
    width = len(BRONZE[table])
    (tmp_path / name).write_text("h\n" + "1" + "," * (width - 1) + "\n")
    assert csv_feed.read_bronze_csv(spark, str(tmp_path), table).count() == int(taken)


def test_other_files_are_not_opened(spark, tmp_path):
    write(tmp_path, "orders.csv", "1,7,2024-01-02 00:00:00,done,web,1.00")
    (tmp_path / "order_items.csv").write_bytes(b"\xff\xfe" * 100)
    df = csv_feed.match_files(spark.read.option("header", True).csv(str(tmp_path)),
                              csv_feed.FILE_PATTERNS["orders"])
    assert df.count() == 1


def test_typed_by_position(spark):
    df = spark.createDataFrame([("1", " 2 ", "2024-01-02 00:00:00", "", "web", "1.239"),
                                ("x", "2", "", "ok", "web", "")], ["c1", "c2", "c3", "c4", "c5", "c6"])
    rows = csv_feed.as_typed(df, "orders").collect()
    assert rows[0]["customer_id"] == 2 and rows[0]["status"] is None
    assert rows[0]["total_amount"] == Decimal("1.24") and rows[1]["order_id"] is None
    with pytest.raises(ValueError):
        csv_feed.as_typed(df.drop("c6"), "orders")


def test_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    lake, checkpoint = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "checkpoint")

    def run():
        return ingest.ingest_stream(lake, str(landing), "orders", checkpoint)

    def stored():
        return lake.read("bronze", "orders")

    write(landing, "orders.csv", "1,7,2024-01-02 00:00:00, done ,web,1.00",
          "2,7,2024-01-02 00:00:00,done,web,1.00")
    write(landing, "order_items.csv", "9,9,9,9,9,9")
    first = run()
    assert stored().count() == 2 and ingest.has_new_data([first])
    again = run()
    assert ingest.new_rows(again) == 0 and not ingest.has_new_data([again])
    write(landing, "orders_v2.csv", "3,7,2024-01-02 00:00:00,done,web,1.00")
    third = run()
    assert ingest.new_rows(third) == 1 and stored().count() == 3
    assert {r["status"] for r in stored().collect()} == {"done"}
    assert ingest.has_new_data([again, third])


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    landing, lake = tmp_path / "landing", Lake(spark, str(tmp_path / "lake"))
    good = "1,7,2024-01-02 00:00:00,done,web,1.00"
    write(landing, "orders.csv", good, "x9,7,2024-01-02 00:00:00,done,web,1.00",
          "2,7,2024-01-02 00:00:00,done,web,12.5O", "3,7", "4,,,,,")
    for _ in range(2):
        run = ingest.ingest_stream(lake, str(landing), "orders", str(tmp_path / "c"))
    stored = lake.read("bronze", "orders")
    assert sorted(r["order_id"] for r in stored.collect()) == [1, 4] and stored.schema.names == BRONZE["orders"].names
    lines = lake.read("rejects", "orders").collect()
    assert sorted(r["line"][:2] for r in lines) == ["2,", "3,", "x9"]
    assert {r["file_name"] for r in lines} == {"orders.csv"}
    # A drop of bad lines alone is no new data.
    write(landing, "orders_v2.csv", "y,7", "z,7")
    run = ingest.ingest_stream(lake, str(landing), "orders", str(tmp_path / "c"))
    assert tuple(run)[:2] == (0, 2) and not ingest.has_new_data([run])
    assert lake.read("rejects", "orders").count() == 5 and lake.read("bronze", "orders").count() == 2


def test_each_file_is_parsed_once(spark, tmp_path):
    """Lines read by the stream: as many as the files hold, though two tables are written."""
    landing, lake = tmp_path / "landing", Lake(spark, str(tmp_path / "lake"))
    write(landing, "orders.csv", *[f"{i},7,2024-01-02 00:00:00,done,web,1.00" for i in range(50)], "bad")
    run = ingest.ingest_stream(lake, str(landing), "orders", str(tmp_path / "c"))
    assert tuple(run)[:2] == (50, 1)
    assert sum(x["numInputRows"] for x in run.query.recentProgress) == 51


def test_a_repeated_batch_takes_the_place_of_the_first(spark, tmp_path):
    """The run stops behind the write and before the checkpoint knows of it."""
    landing, lake = tmp_path / "landing", Lake(spark, str(tmp_path / "lake"))
    write(landing, "orders.csv", "1,7,2024-01-02 00:00:00,done,web,1.00", "bad")
    checkpoint = tmp_path / "c"
    ingest.ingest_stream(lake, str(landing), "orders", str(checkpoint))
    for mark in (checkpoint / "commits").iterdir():
        mark.unlink()
    run = ingest.ingest_stream(lake, str(landing), "orders", str(checkpoint))
    assert tuple(run)[:2] == (1, 1)
    assert lake.read("bronze", "orders").count() == lake.read("rejects", "orders").count() == 1
    assert len(lake.history("bronze", "orders")) == 2


def test_limited_batches_take_everything(spark, tmp_path):
    landing = tmp_path / "landing"
    for i in range(4):
        write(landing, f"orders_v{i}.csv", f"{i},7,2024-01-02 00:00:00,done,web,1.00")
    lake = Lake(spark, str(tmp_path / "lake"))
    run = ingest.ingest_stream(lake, str(landing), "orders", str(tmp_path / "c"), 1)
    assert ingest.new_rows(run) == 4 == lake.read("bronze", "orders").count()
    assert len(lake.history("bronze", "orders")) == 4


def test_change_feed_starts_with_the_rows_so_far(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    checkpoint, batches = str(tmp_path / "checkpoint"), []

    def consume():
        ingest.consume_table(
            lake, "bronze", "orders", checkpoint,
            lambda df, _: batches.append(sorted(r["order_id"] for r in df.collect())),
        )

    lake.append_log(feed(spark, "orders", ROWS["orders"][:1]), "bronze", "orders", "r1")
    lake.append_log(feed(spark, "orders", ROWS["orders"][1:2]), "bronze", "orders", "r2")
    consume()
    consume()
    lake.append_log(feed(spark, "orders", ROWS["orders"][2:]), "bronze", "orders", "r3")
    consume()
    # A run that is repeated has been handed on before.
    lake.append_log(feed(spark, "orders", ROWS["orders"][2:]), "bronze", "orders", "r3")
    consume()
    assert batches == [[10, 11], [12, 20]]


def test_change_feed_of_a_plain_folder(spark, tmp_path):
    folder, found = str(tmp_path / "orders"), []
    for rows in (ROWS["orders"][:2], ROWS["orders"][2:]):
        feed(spark, "orders", rows).write.mode("append").parquet(folder)
        ingest.consume_changes(
            ingest.changes(spark, folder, "orders"), str(tmp_path / "c"),
            lambda df, _: found.append(sorted(r["order_id"] for r in df.collect())),
        )
    assert found == [[10, 11], [12, 20]]


def test_snapshot_diff(spark):
    old = feed(spark, "orders", [
        (1, 1, None, "a", None, money(1)), (2, 1, None, "a", None, money(1)),
        (3, 1, day("2024-01-01"), "a", "web", money(1)),
    ])
    new = feed(spark, "orders", [
        (1, 1, None, "a", None, money(1)), (2, 1, None, "a", "web", money(1)),
        (4, None, None, None, None, None),
    ])
    out = by(snapshot_diff(old, new, "order_id"), "order_id")
    assert {k: v["action"] for k, v in out.items()} == {2: "UPDATE", 3: "DELETE", 4: "INSERT"}
    assert out[2]["channel"] == "web" and out[3]["status"] == "a"


def test_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    orders = feed(spark, "orders")
    assert lake.find("bronze", "orders") is None
    lake.publish(orders, "bronze", "orders")
    stored = lake.publish(orders.limit(3), "bronze", "orders", loaded_at=NOW)
    assert stored.count() == 3 and stored.first()["_loaded_at"] == NOW
    lake.append_log(orders.limit(1), "logs", "orders")
    assert lake.append_log(orders.limit(2), "logs", "orders").count() == 3
    assert lake.replace_if_any(orders.limit(0), "logs", "orders").count() == 3
    assert lake.replace_if_any(orders.limit(1), "logs", "orders").count() == 1
    found = by(lake.inventory({"bronze": ["orders", "absent"], "logs": ["orders"]}), "table_schema")
    assert found["BRONZE"]["row_count"] == 3 and found["BRONZE"]["bytes"] > 0
    assert found["LOGS"]["row_count"] == 1


def test_partitioned_publish(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.publish(feed(spark, "orders"), "bronze", "orders", partition_by=["status"])
    plan = lake.read("bronze", "orders").filter("status = 'shipped'")
    assert plan.count() == 1
    assert len(list((tmp_path / "bronze" / "orders" / "data").glob("v*/status=*"))) == 4


def test_shared_folder_comes_from_the_session(spark):
    class Conf:
        def get(self, key, default):
            return {"spark.checkpoint.dir": "/shared/"}.get(key, default)

    class Session:
        class sparkContext:
            master = "spark://x"

            @staticmethod
            def getConf():
                return Conf()

    assert shared_dir(Session) == "/shared"
    assert fresh_dir(Session, "a") != fresh_dir(Session, "a")
    Conf.get = lambda self, key, default: default
    with pytest.raises(ValueError):
        shared_dir(Session)


def test_settings_grow_with_the_input():
    small, large = sized_for(10**9), sized_for(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // 1024**3)
    assert sized_for(10**18)["spark.sql.shuffle.partitions"] == "100000"


def test_tune_sets_what_the_operators_rely_on(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    assert tune(spark) is spark
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
