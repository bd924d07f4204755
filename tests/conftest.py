from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, SparkSession

from lodestrata.schemas import BRONZE
from lodestrata.session import build_session

AS_OF = dt.date(2024, 7, 1)
NOW = dt.datetime(2024, 7, 1, 9, 30)


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def money(text) -> Decimal | None:
    return None if text is None else Decimal(str(text))


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# One small, consistent set of feeds; tests replace single tables.
ROWS = {
    "customers": [
        (1, " Ann", "Lee ", " Ann@Shop.COM", "1", " Rome", "it", "1", "vip", day("2020-01-01")),
        (2, "Bob", "Ray", "bob@x.org", "2", "Oslo", "no", "2", "new", day("2024-01-01")),
        (3, "Cy", None, "cy", "3", "Bern", "ch", "3", "regular", day("2023-07-02")),
    ],
    "orders": [
        (10, 1, day("2024-06-01"), " completed", "WEB", money("6000.00")),
        (11, 1, day("2024-06-05"), "cancelled", "mobile ", money("100.00")),
        (12, 1, day("2024-06-11"), "returned", "web", money("50.00")),
        (20, 2, day("2024-06-29"), "shipped", "phone", money("5000.00")),
    ],
    "order_items": [
        (100, 10, 7, 2, money("100.00"), money("20.00"), money("1.00")),
        (101, 10, 8, 1, money("0.00"), None, None),
        (102, 12, 7, 3, money("100.00"), None, money("300.00")),
        (103, 20, 7, 1, money("100.00"), money("60.00"), money("40.00")),
    ],
    "products": [
        (7, "Lamp ", "home", "light", "A ", money("100.00"), money("60.00"), 99, day("2020-01-01")),
        (8, "Sofa", "home", "seat", "B", money("800.00"), money("900.00"), 100, day("2020-01-01")),
        (9, "Bed", "home", "bed", "B", money("200.00"), money("0.00"), None, day("2020-01-01")),
    ],
    "payments": [
        (1, 10, " Credit_Card", money("6000.00"), day("2024-06-02"), "failed"),
        (2, 10, "PayPal", money("6000.00"), day("2024-06-03"), "completed "),
        (3, 11, "gift_card", money("100.00"), day("2024-06-05"), "failed"),
        (4, 12, "cash", money("50.00"), day("2024-06-12"), "refunded"),
    ],
    "shipments": [
        (1, 10, "ups", " T1", day("2024-06-02"), day("2024-06-10"), "delivered"),
        (2, 10, "ups", "T2", day("2024-06-03"), day("2024-06-04"), "delivered"),
        (3, 12, "dhl", "T3", day("2024-06-12"), None, "in_transit"),
        (4, 20, "dhl", "T4", day("2024-06-30"), day("2024-07-03"), "returned"),
    ],
}


def feed(spark: SparkSession, name: str, rows=None) -> DataFrame:
    return spark.createDataFrame(ROWS[name] if rows is None else rows, BRONZE[name])


@pytest.fixture()
def bronze(spark) -> dict[str, DataFrame]:
    return {name: feed(spark, name) for name in ROWS}


@pytest.fixture()
def staged(bronze) -> dict[str, DataFrame]:
    from lodestrata.operators.silver import build_silver

    return build_silver(bronze, AS_OF)


def by(df: DataFrame, key: str) -> dict:
    rows = df.collect()
    found = {row[key]: row.asDict() for row in rows}
    assert len(found) == len(rows)
    return found
