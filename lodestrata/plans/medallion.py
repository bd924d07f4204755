"""The run order: gate, profile, Silver, anomalies, gate, Gold, scores, gate."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from lodestrata.operators import anomalies, gates, gold, profiling, rfm, silver
from lodestrata.schemas import LAYERS
from lodestrata.session import shuffles_freed, tune
from lodestrata.sources.tables import Lake

# Models written at the same time; each write is a Spark job of its own, whose shuffles are on disk until it ends.
PARALLEL_MODELS = 2
# Those that shuffle most are written one after the other.
LARGE_MODELS = ["dim_products", "fact_sales", "fact_payment_summary", "fact_shipment_performance", "fact_daily_revenue"]

STEP_SCHEMA = "step_no int, step string, status string, message string"


def gate_text(checks: DataFrame) -> str:
    """The message of one gate; a single short row."""
    return gates.gate_message(checks).first()["message"]


def gated_promote(message: str, gate: int, layer: str, build: Callable[[], None]) -> tuple:
    """Build the next layer if the gate passed; otherwise skip it, without error."""
    if message.startswith(f"GATE {gate} PASSED"):
        build()
        done = f"{layer.title()} transformation completed successfully"
        return f"{layer}_transform", "DONE", done
    skipped = f"{layer.title()} transformation SKIPPED: Gate {gate} did not pass. Result: {message}"
    return f"{layer}_transform", "SKIPPED", skipped


def write_tables(writes: dict[str, Callable[[], object]]) -> None:
    """Carry out the writes of some tables, ``PARALLEL_MODELS`` at a time and ``LARGE_MODELS`` in a row."""
    large = [writes[name] for name in LARGE_MODELS if name in writes]
    with ThreadPoolExecutor(PARALLEL_MODELS) as pool:
        jobs = [pool.submit(lambda: [write() for write in large])]
        jobs += [pool.submit(write) for name, write in writes.items() if name not in LARGE_MODELS]
        for job in jobs:
            job.result()


def _write_all(lake: Lake, layer: str, models: dict[str, DataFrame], ts: dt.datetime) -> None:
    write_tables({n: (lambda n=n, df=df: lake.publish(df, layer, n, ts)) for n, df in models.items()})


def _layer(lake: Lake, layer: str) -> dict[str, DataFrame] | None:
    """All tables of a layer, or ``None`` when one is missing."""
    found = {name: lake.find(layer, name) for name in LAYERS[layer]}
    return None if any(df is None for df in found.values()) else found


def run_medallion(
    spark: SparkSession, root: str, as_of: dt.date, ts: dt.datetime, run_id: str | None = None,
    max_days: int | None = None, bronze: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Take the Bronze tables below ``root`` to certified Gold tables.

    ``bronze`` are those tables as they were at a given moment.  Returns one row per step.  Profile, anomalies and scores run on whatever
    tables are there, also when a transform was skipped.  The first gate
    checks that order ids are unique, so the Gold models of a run that passed
    it use plain counts of orders; the second, that each item has its order.
    """
    with shuffles_freed(spark):
        steps = _run(Lake(tune(spark), root), as_of, ts, run_id or str(uuid.uuid4()), max_days, bronze)
    return spark.createDataFrame(steps, STEP_SCHEMA)


def _run(
    lake: Lake, as_of: dt.date, ts: dt.datetime, run_id: str, max_days: int | None, bronze: dict[str, DataFrame] | None,
) -> list[tuple]:
    steps: list[tuple] = []

    def note(step: str, status: str, message: str) -> None:
        steps.append((len(steps) + 1, step, status, message))

    bronze = bronze or {name: lake.read("bronze", name) for name in LAYERS["bronze"]}
    first = gate_text(gates.validate_bronze(bronze))
    note("bronze_gate", "DONE", first)

    # The gate has counted these keys: without repeats, their distinct values need no shuffle.
    proved = gates.UNIQUE_KEYS if first.startswith("GATE 1 PASSED") else None
    profile = profiling.profile_tables(bronze, run_id, ts, unique=proved)
    lake.append_log(profile, "bronze", "data_profile_log", run_id)
    note("bronze_profile", "DONE", "Bronze profiling complete")

    note(*gated_promote(first, 1, "silver", lambda: _write_all(
        lake, "silver", silver.build_silver(bronze, as_of), ts)))

    staged = _layer(lake, "silver")
    if staged is None:
        note("anomalies", "SKIPPED", "no Silver tables yet")
        second = "GATE 2 FAILED: no Silver tables yet"
        note("silver_gate", "SKIPPED", second)
    else:
        lake.append_log(
            anomalies.anomaly_flags(staged, as_of, run_id, ts), "silver", "anomaly_flags", run_id
        )
        note("anomalies", "DONE", "Anomaly detection complete")
        second = gate_text(gates.validate_silver(staged))
        note("silver_gate", "DONE", second)

    unique_orders = first.startswith("GATE 1 PASSED")
    note(*gated_promote(second, 2, "gold", lambda: _write_all(
        lake, "gold", gold.build_gold(_layer(lake, "silver"), as_of, unique_orders, max_days, unique_orders), ts)))

    buyers = lake.find("gold", "dim_customers")
    if buyers is not None:
        lake.replace_if_any(
            rfm.rfm_scores(buyers, ts), "gold", "customer_rfm_scores",
            given=buyers.filter("total_orders > 0"),
        )
    counted = {
        layer: {name: lake.find(layer, name) for name in names}
        for layer, names in LAYERS.items()
    }
    counted["gold"]["customer_rfm_scores"] = lake.find("gold", "customer_rfm_scores")
    lake.append_log(profiling.run_summary(counted, run_id, ts), "gold", "pipeline_run_summary", run_id)
    note("gold_enrichment", "DONE", "Gold enrichment complete")

    certified = _layer(lake, "gold")
    if certified is None or staged is None:
        note("gold_gate", "SKIPPED", "no Gold tables yet")
    else:
        note("gold_gate", "DONE", gate_text(gates.validate_gold(certified, staged)))
    return steps
