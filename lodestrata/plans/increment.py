"""A run that rebuilds what new Bronze rows touch, and keeps the rest of Silver and Gold.

The table logs say which Bronze writes a run has seen.  From the rows that came since follow the keys
they touch: orders, customers, products, days.  Each model then runs over the Silver rows of
its keys, and its rows take the place of the stored ones with those keys; the result is
that of a run over everything.  Only narrow key tables and the touched rows are
shuffled, as long as the keys are few.  Where many orders are touched the models run over all of Silver, and
the rows that nothing has touched keep the time at which they were loaded.

Ages are counted from the day of the run, so the first run of another day, a run behind one that
a gate has stopped, and one over a replaced Bronze table build everything.  Gates, flags and
scores speak of whole tables and still read them; profiles come from states per write.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.columns import moment
from lodestrata.operators import anomalies, gates, gold, rfm, silver, states
from lodestrata.plans.medallion import PARALLEL_MODELS, STEP_SCHEMA, gate_text, run_medallion, write_tables
from lodestrata.schemas import BRONZE, LAYERS
from lodestrata.session import fresh_dir, shuffles_freed, tune
from lodestrata.sources.tables import COMPRESSION, Lake, Version, standing

LAYER, TABLE = "governance", "seen_versions"
SEEN_DDL = "run_id string, as_of date, layer string, name string, folder string, version long"
SILVER_OF = {feed: f"stg_{feed}" for feed in BRONZE}
# From this share of touched orders on Gold is built whole.  A filter by that many keys shuffles all of each Silver
# and Gold table, before the models shuffle what is left of them.
WHOLE_SHARE = 0.1
# The key by which the rows of a Gold table are replaced, and the kind of touched keys; the calendar has none.
GOLD_KEYS = {
    "dim_customers": ("customer_id", "customer"), "dim_products": ("product_id", "product"),
    "fact_sales": ("order_id", "order"), "fact_daily_revenue": ("revenue_date", "day"),
    "fact_payment_summary": ("order_id", "order"), "fact_shipment_performance": ("order_id", "order"),
}


class Seen:
    """What the last whole run has read and left."""

    def __init__(self, rows: list):
        self.as_of = rows[0].as_of if rows else None
        self.folders = {(x.layer, x.name, x.folder) for x in rows if x.layer == "bronze"}
        self.versions = {(x.layer, x.name): x.version for x in rows if x.layer != "bronze"}


def _remember(lake: Lake, as_of: dt.date, run_id: str, bronze: dict[str, list[Version]]) -> None:
    """One short row per Bronze write and per table of the other layers."""
    rows = [(run_id, as_of, "bronze", name, x.folder, x.version) for name, kept in bronze.items() for x in kept]
    for layer in ("silver", "gold"):
        for name in LAYERS[layer]:
            rows.append((run_id, as_of, layer, name, None, lake.history(layer, name)[-1].version))
    lake.publish(lake.spark.createDataFrame(rows, SEEN_DDL).coalesce(1), LAYER, TABLE)


def _among(df: DataFrame, key: Column, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among ``keys``; NULL matches NULL."""
    named = keys.select(F.col(keys.columns[0]).alias("_key"))
    return df.join(named, key.eqNullSafe(F.col("_key")), how)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path, schema = fresh_dir(df.sparkSession, label), df.schema
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _keys(label: str, *parts: DataFrame) -> DataFrame:
    """The distinct values of one-column frames, written once for their many uses."""
    return _stored(reduce(DataFrame.union, parts).distinct(), label)


class Increment:
    """New Bronze rows over the tables that the last run left."""

    def __init__(self, lake: Lake, seen: Seen, bronze: dict[str, list[Version]], as_of: dt.date, ts: dt.datetime):
        self.lake, self.seen, self.as_of, self.ts = lake, seen, as_of, ts
        fresh = {n: [x for x in kept if ("bronze", n, x.folder) not in seen.folders] for n, kept in bronze.items()}
        known = {n: [x for x in kept if ("bronze", n, x.folder) in seen.folders] for n, kept in bronze.items()}
        self.bronze = {n: lake.read_versions(kept) for n, kept in bronze.items()}
        self.new, self.old = (
            {n: lake.read_versions(some[n]) if some[n] else self.bronze[n].filter("false") for n in bronze}
            for some in (fresh, known)
        )

    def base(self, layer: str, name: str) -> DataFrame:
        """A table as the last whole run left it, whatever a run that failed has written since."""
        return self.lake.read(layer, name, self.seen.versions[layer, name])

    def _joined(self, kept: DataFrame, rows: DataFrame) -> DataFrame:
        """Stored rows and new ones, which are loaded now."""
        return kept.unionByName(rows.withColumn("_loaded_at", moment(self.ts)).select(*kept.columns))

    def build_silver(self) -> None:
        """New staging rows; items of new products and payments of new orders are staged again, as they look these up.

        Keeps what is new in ``self.staged`` and all of it in ``self.silver``.
        """
        parents = {"order_items": ("products", "product_id"), "payments": ("orders", "order_id")}
        self.staged, self.silver = {}, {}

        def build(feed: str, name: str) -> None:
            rows, kept = self.new[feed], self.base("silver", name)
            if feed in parents:
                parent, key = parents[feed]
                keys = _keys(f"new-{parent}", self.new[parent].select(key))
                rows = rows.unionByName(_among(self.old[feed], F.col(key), keys))
                kept = _among(kept, F.col(key), keys, "left_anti")
            staged = _stored(silver.MODELS[name]({**self.bronze, feed: rows}, self.as_of), name)
            self.staged[name] = staged
            at_base = self.lake.history("silver", name)[-1].version == self.seen.versions["silver", name]
            if staged.isEmpty() and at_base:
                self.silver[name] = kept
            else:
                self.silver[name] = self.lake.publish(self._joined(kept, staged), "silver", name)

        with ThreadPoolExecutor(PARALLEL_MODELS) as pool:
            for job in [pool.submit(build, feed, name) for feed, name in SILVER_OF.items()]:
                job.result()

    def touched(self) -> dict[str, DataFrame]:
        """Keys whose Gold rows may differ: orders, customers, products and days."""
        s, new = self.silver, self.staged
        ids = [new[n].select("order_id") for n in ("stg_orders", "stg_order_items", "stg_payments", "stg_shipments")]
        changed = _keys("changed-orders", *ids)
        their = _stored(_among(
            s["stg_orders"].select("order_id", "customer_id", F.to_date("order_date").alias("day")),
            F.col("order_id"), changed), "order-keys")
        customers = _keys("customers", new["stg_customers"].select("customer_id"), their.select("customer_id"))
        # All orders of these customers: the sales fact knows whether a customer has come back.
        orders = _keys("orders", changed, _among(
            s["stg_orders"].select("order_id", "customer_id"), F.col("customer_id"), customers).select("order_id"))
        products = _keys("products", new["stg_products"].select("product_id"), new["stg_order_items"].select("product_id"),
                         _among(s["stg_order_items"], F.col("order_id"), changed).select("product_id"))
        return {"order": orders, "customer": customers, "product": products, "day": _keys("days", their.select("day"))}

    def _of_orders(self, orders: DataFrame, customers: DataFrame | None = None) -> dict[str, DataFrame]:
        """Silver, cut to some orders and what belongs to them."""
        s = dict(self.silver)
        for name in ("stg_orders", "stg_order_items", "stg_payments", "stg_shipments"):
            s[name] = _among(s[name], F.col("order_id"), orders)
        if customers is not None:
            s["stg_customers"] = _among(s["stg_customers"], F.col("customer_id"), customers)
        return s

    def build_gold(self, max_days: int | None = None) -> dict[str, DataFrame]:
        """Gold rows of the touched keys in the place of the stored ones.  Returns the touched keys."""
        keys = self.touched()
        many = keys["order"].count() >= WHOLE_SHARE * self.silver["stg_orders"].count()
        tables = self._whole_gold(keys) if many else self._replaced_gold(keys)
        writes = {name: partial(self.lake.publish, rows, "gold", name) for name, rows in tables.items()}
        # The calendar hangs on the first and the last day alone.
        writes["dim_dates"] = partial(
            self.lake.publish, gold.dim_dates(self.silver, max_days), "gold", "dim_dates", self.ts)
        write_tables(writes)
        return keys

    def _whole_gold(self, keys: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Gold from all of Silver; rows of keys that are not touched, which are as they were, keep their load time.

        Of the stored rows only key and time move.  Behind the gates no key is NULL.
        """
        models, tables = gold.gold_models(self.silver, self.as_of, True, items_have_orders=True), {}
        for name, (key, kind) in GOLD_KEYS.items():
            stored = self.base("gold", name)
            touched = keys[kind].select(F.col(keys[kind].columns[0]).alias("_key"))
            times = (
                stored.select(F.col(key).alias("_key"), "_loaded_at").join(touched, "_key", "left_anti")
                .groupBy("_key").agg(F.max("_loaded_at").alias("_before"))
            )
            rows = models[name]()
            loaded = F.coalesce("_before", moment(self.ts))
            tables[name] = rows.join(times, rows[key] == times["_key"], "left").withColumn(
                "_loaded_at", loaded).select(*stored.columns)
        return tables

    def _replaced_gold(self, keys: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The stored rows of keys that are not touched, and the models over the Silver rows of those that are."""
        of_orders = self._of_orders(keys["order"], keys["customer"])
        # A product's sales hang on all its items, a day's on all its orders.
        items = _among(self.silver["stg_order_items"], F.col("product_id"), keys["product"])
        of_products = {
            **self.silver, "stg_order_items": items,
            "stg_products": _among(self.silver["stg_products"], F.col("product_id"), keys["product"]),
            "stg_orders": _among(self.silver["stg_orders"], F.col("order_id"), _keys("sold", items.select("order_id"))),
        }
        in_days = _among(self.silver["stg_orders"], F.to_date("order_date"), keys["day"])
        of_days = self._of_orders(_keys("day-orders", in_days.select("order_id")))
        # The first gate has proved that order ids don't repeat.
        models = {
            "dim_customers": gold.dim_customers(of_orders, self.as_of, True),
            "dim_products": gold.dim_products(of_products),
            "fact_sales": gold.fact_sales(of_orders),
            "fact_daily_revenue": gold.fact_daily_revenue({**of_days, "stg_orders": in_days}, True),
            "fact_payment_summary": gold.fact_payment_summary(of_orders),
            "fact_shipment_performance": gold.fact_shipment_performance(of_orders),
        }
        return {
            name: self._joined(_among(self.base("gold", name), F.col(key), keys[kind], "left_anti"), models[name])
            for name, (key, kind) in GOLD_KEYS.items()
        }


def _unseen(lake: Lake, seen: Seen, bronze: dict[str, list[Version]], as_of: dt.date) -> bool | None:
    """Whether there are new Bronze writes; ``None`` where only a whole run will do."""
    now = {("bronze", name, x.folder) for name, kept in bronze.items() for x in kept}
    left = all(lake.history(*table) for table in seen.versions)
    if seen.as_of != as_of or not seen.folders <= now or not left or not all(bronze.values()):
        return None
    return bool(now - seen.folders)


def summary_from_logs(lake: Lake, run_id: str, ts: dt.datetime) -> DataFrame:
    """Rows of every table as the logs tell them; -1 for a table that is missing."""
    listed = [(layer, name) for layer, names in LAYERS.items() for name in names] + [("gold", "customer_rfm_scores")]
    tables = lake.spark.createDataFrame(listed, "layer string, name string")
    counts = lake.logged().groupBy("layer", "name").agg(F.sum("row_count").alias("n"))
    return tables.join(counts, ["layer", "name"], "left").select(
        F.lit(run_id).alias("run_id"), F.upper("layer").alias("layer"), F.upper("name").alias("table_name"),
        F.coalesce("n", F.lit(-1)).cast("bigint").alias("row_count"), moment(ts).alias("run_timestamp"),
    )


def run_increment(
    spark: SparkSession, root: str, as_of: dt.date, ts: dt.datetime, run_id: str | None = None,
    max_days: int | None = None,
) -> DataFrame:
    """Take what is new in Bronze below ``root`` to Silver and Gold; the steps, as ``run_medallion`` gives them.

    Bronze tables are those of a ``Lake``.  A run that fails leaves the tables of the run before
    as the base of the next.
    """
    with shuffles_freed(spark):
        return _run(spark, root, as_of, ts, run_id or str(uuid.uuid4()), max_days)


def _run(
    spark: SparkSession, root: str, as_of: dt.date, ts: dt.datetime, run_id: str, max_days: int | None,
) -> DataFrame:
    lake = Lake(tune(spark), root)
    bronze = {name: standing(lake.history("bronze", name)) for name in LAYERS["bronze"]}
    known = lake.find(LAYER, TABLE)
    seen = Seen([] if known is None else known.collect())
    some = _unseen(lake, seen, bronze, as_of)
    if some is False:
        return spark.createDataFrame([(1, "increment", "SKIPPED", "no new data")], STEP_SCHEMA)

    def whole_run() -> DataFrame:
        tables = {n: lake.read_versions(kept) if kept else lake.read("bronze", n) for n, kept in bronze.items()}
        steps = run_medallion(spark, root, as_of, ts, run_id, max_days, tables)
        if steps.filter("status <> 'DONE'").isEmpty() and all(bronze.values()):
            _remember(lake, as_of, run_id, bronze)
        return steps

    if some is None:
        return whole_run()
    new = Increment(lake, seen, bronze, as_of, ts)
    first = gate_text(gates.validate_bronze(new.bronze))
    if not first.startswith("GATE 1 PASSED"):
        return whole_run()
    steps = [("bronze_gate", "DONE", first)]
    states.keep_states(lake, {"bronze": LAYERS["bronze"]})
    lake.append_log(
        states.profile_from_states(lake, LAYERS["bronze"], run_id, ts), "bronze", "data_profile_log", run_id)
    steps.append(("bronze_profile", "DONE", "Bronze profiling complete"))
    new.build_silver()
    steps.append(("silver_transform", "DONE", "Silver transformation completed successfully"))
    lake.append_log(anomalies.anomaly_flags(new.silver, as_of, run_id, ts), "silver", "anomaly_flags", run_id)
    steps.append(("anomalies", "DONE", "Anomaly detection complete"))
    second = gate_text(gates.validate_silver(new.silver))
    steps.append(("silver_gate", "DONE", second))
    passed = second.startswith("GATE 2 PASSED")
    if passed:
        new.build_gold(max_days)
        steps.append(("gold_transform", "DONE", "Gold transformation completed successfully"))
    else:
        steps.append(("gold_transform", "SKIPPED",
                      f"Gold transformation SKIPPED: Gate 2 did not pass. Result: {second}"))
    buyers = lake.read("gold", "dim_customers")
    lake.replace_if_any(
        rfm.rfm_scores(buyers, ts), "gold", "customer_rfm_scores", given=buyers.filter("total_orders > 0"))
    lake.append_log(summary_from_logs(lake, run_id, ts), "gold", "pipeline_run_summary", run_id)
    steps.append(("gold_enrichment", "DONE", "Gold enrichment complete"))
    certified = {name: lake.read("gold", name) for name in LAYERS["gold"]}
    steps.append(("gold_gate", "DONE", gate_text(gates.validate_gold(certified, new.silver))))
    if passed:
        _remember(lake, as_of, run_id, bronze)
    return spark.createDataFrame([(i, *x) for i, x in enumerate(steps, 1)], STEP_SCHEMA)
