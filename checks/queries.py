"""Registered queries: each maps a session and a table folder to a frame.

Every query reads the whole sample tables, through the Bronze feeds derived
from them.  Queries of sources and sinks write below the shared folder first.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import (
    anomalies, changes, gates, gold, governance, profiling, quality, reports, rfm, silver, states,
)
from lodestrata.plans import attachments as A
from lodestrata.plans import arrivals, increment, medallion
from lodestrata.schemas import BRONZE, LAYERS, LOG_TABLES
from lodestrata.session import fresh_dir, shuffles_freed, tune
from lodestrata.sources import csv_feed
from lodestrata.sources.sample import AS_OF, FEEDS, sample_feed
from lodestrata.sources.tables import Lake
from lodestrata.streaming import ingest, versions

NOW = dt.datetime(2001, 8, 15, 12, 0, 0)
EARLIER = dt.datetime(2000, 12, 31, 12, 0, 0)
RUN, EARLIER_RUN = "run-2", "run-1"


class Planned(Mapping):
    """Tables that are planned when first asked for."""

    def __init__(self, builders):
        self._builders = dict(builders)
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name):
        if name not in self._planned:
            self._planned[name] = self._builders[name]()
        return self._planned[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


# Where the stored layers and logs of a folder of sample tables are and which of them are written, by
# application and folder.
_STORED: dict[tuple[str, str], tuple[str, set[tuple[str, str]]]] = {}
LOGS = [("bronze", "data_profile_log"), ("silver", "anomaly_flags"), ("governance", "metric_results"),
        ("gold", "customer_rfm_scores"), ("gold", "pipeline_run_summary")]


class Layers:
    """The derived layers over one folder of sample tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, bronze=None):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self.bronze = bronze or Planned(
            {feed: (lambda f=feed: sample_feed(spark, sf_dir, f)) for feed in FEEDS}
        )
        self.silver = Planned({
            name: (lambda m=model: m(self.bronze, AS_OF))
            for name, model in silver.MODELS.items()
        })
        self.gold = Planned(gold.gold_models(self.silver, AS_OF))
        self.all = {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}

    def _stored_root(self) -> tuple[Lake, set[tuple[str, str]]]:
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORED:
            _STORED[key] = fresh_dir(self.spark, "stored"), set()
        root, written = _STORED[key]
        return Lake(self.spark, root), written

    def table(self, layer: str, name: str) -> DataFrame:
        """A stored table or log, whole; it and what it is made of are written once per application.

        Reports on logs and on the inventory read these tables, as they would after any run, and plan no
        model anew.  A report waits for the tables it reads and for no others.
        """
        lake, written = self._stored_root()
        if (layer, name) not in written:
            with shuffles_freed(self.spark):
                self._write(lake, layer, name)
            written.add((layer, name))
        return lake.read(layer, name)

    def _write(self, lake: Lake, layer: str, name: str) -> None:
        stored = self.stored()
        if (layer, name) in LOGS:
            self._write_log(lake, layer, name, stored)
        elif layer == "bronze":
            lake.publish(self.bronze[name], layer, name)
        elif layer == "silver":
            lake.publish(silver.MODELS[name](stored["bronze"], AS_OF), layer, name)
        else:
            lake.publish(gold.gold_models(stored["silver"], AS_OF)[name](), layer, name)

    def _write_log(self, lake: Lake, layer: str, name: str, now: dict[str, Mapping]) -> None:
        """A log of two runs; the earlier run has Bronze alone, with orders and customers as known then."""
        def known(table: str) -> DataFrame:
            df, column = now["bronze"][table], A.CHANGE_TIMES.get(table)
            return df if column is None else df.filter(F.col(column) <= F.lit(EARLIER.date()))

        before = {"bronze": Planned({n: (lambda n=n: known(n)) for n in LAYERS["bronze"]})}
        if name == "customer_rfm_scores":
            lake.publish(rfm.rfm_scores(now["gold"]["dim_customers"], NOW), layer, name)
            return
        if name == "data_profile_log":
            first = profiling.profile_tables(before["bronze"], EARLIER_RUN, EARLIER)
            second = profiling.profile_tables(now["bronze"], RUN, NOW)
        elif name == "anomaly_flags":
            first = anomalies.anomaly_flags(now["silver"], EARLIER.date(), EARLIER_RUN, EARLIER)
            second = anomalies.anomaly_flags(now["silver"], AS_OF, RUN, NOW)
        elif name == "metric_results":
            first = quality.dq_suite(before, EARLIER, [a for a in A.ATTACHMENTS if a[0] == "bronze"])
            second = quality.dq_suite(now, NOW)
        else:
            scored = {"customer_rfm_scores": self.table("gold", "customer_rfm_scores")}
            missing = {n: dict.fromkeys((*LAYERS[n], *(scored if n == "gold" else ()))) for n in ("silver", "gold")}
            first = profiling.run_summary({**before, **missing}, EARLIER_RUN, EARLIER)
            second = profiling.run_summary({**now, "gold": {**now["gold"], **scored}}, RUN, NOW)
        lake.append_log(first, layer, name, EARLIER_RUN)
        lake.append_log(second, layer, name, RUN)

    def stored(self) -> dict[str, Mapping[str, DataFrame]]:
        """The three layers as stored."""
        return {
            layer: Planned({n: (lambda layer=layer, n=n: self.table(layer, n)) for n in names})
            for layer, names in LAYERS.items()
        }

    def lake(self, logs: bool = True) -> Lake:
        """All stored layers and, with ``logs``, the logs of two runs; some tables are written at a time."""
        steps = [[(layer, n) for n in names] for layer, names in LAYERS.items()]
        if logs:
            # The summary counts the scores.
            steps += [LOGS[:-1], LOGS[-1:]]
        # The folder is named before the threads ask for it.
        lake, _ = self._stored_root()
        for step in steps:
            medallion.write_tables({n: (lambda layer=layer, n=n: self.table(layer, n)) for layer, n in step})
        return lake

    def flags(self) -> DataFrame:
        return anomalies.anomaly_flags(self.silver, AS_OF, RUN, NOW)

    def flag_log(self) -> DataFrame:
        """Flags of two runs."""
        return self.table("silver", "anomaly_flags")

    def latest_flags(self) -> DataFrame:
        return self.flag_log().filter(F.col("detected_at") == F.lit(NOW).cast("timestamp_ntz"))

    def scores(self) -> DataFrame:
        return rfm.rfm_scores(self.gold["dim_customers"], NOW)

    def profile_log(self) -> DataFrame:
        """Profiles of two runs."""
        return self.table("bronze", "data_profile_log")

    def metric_log(self) -> DataFrame:
        """Metrics of two runs: all attachments in the second, those of Bronze in the first."""
        return self.table("governance", "metric_results")

    def run_log(self) -> DataFrame:
        """Row counts of two runs; the first has Bronze alone."""
        return self.table("gold", "pipeline_run_summary")

    def stored_tables(self) -> DataFrame:
        """Rows, bytes and times of all stored tables, logs included."""
        return self.lake().inventory({n: [*LAYERS[n], *LOG_TABLES[n]] for n in LAYERS})

    def inventory(self) -> DataFrame:
        return self.stored_tables().select("table_schema", "table_name", "row_count")

    def tagged(self) -> DataFrame:
        """The inventory of the tables that may carry tags: all but the logs."""
        return self.lake(logs=False).inventory(LAYERS).select("table_schema", "table_name", "row_count")

    def references(self) -> DataFrame:
        return governance.tag_references(
            governance.tag_assignments(self.spark), self.tagged()
        )

    def personal(self) -> DataFrame:
        return governance.pii_inventory(governance.tag_assignments(self.spark), self.stored())

    def all_checks(self) -> DataFrame:
        return (
            gates.validate_bronze(self.bronze)
            .unionByName(gates.validate_silver(self.silver))
            .unionByName(gates.validate_gold(self.gold, self.silver))
        )


def _on_layers(build):
    return lambda spark, sf_dir: build(Layers(spark, sf_dir))


def model_queries() -> dict:
    found = {name: (lambda x, n=name: x.silver[n]) for name in silver.MODELS}
    found.update(
        customer_orders=lambda x: gold.customer_orders(x.silver, AS_OF),
        customer_payments=lambda x: gold.customer_payments(x.silver),
        preferred_channel=lambda x: gold.preferred_channel(x.silver),
        customer_ratios=lambda x: gold.customer_ratios(x.silver, AS_OF),
        loyalty_tier=lambda x: gold.loyalty_tiers(x.silver, AS_OF),
        dim_customers=lambda x: x.gold["dim_customers"],
        product_sales=lambda x: gold.product_sales(x.silver),
        return_exposure=lambda x: gold.return_exposure(x.silver),
        product_inventory=lambda x: gold.product_inventory(x.silver),
        dim_products=lambda x: x.gold["dim_products"],
        src_date_spine=lambda x: gold.date_spine(gold.order_date_bounds(x.silver)),
        dim_dates=lambda x: x.gold["dim_dates"],
        order_items_agg=lambda x: gold.order_items_agg(x.silver),
        payment_agg=lambda x: gold.payment_agg(x.silver),
        shipment_info=lambda x: gold.shipment_info(x.silver),
        customer_order_counts=lambda x: gold.customer_order_counts(x.silver),
        sales_derived=lambda x: gold.sales_derived(x.silver),
        fact_sales=lambda x: x.gold["fact_sales"],
        fact_shipment_performance=lambda x: x.gold["fact_shipment_performance"],
        payment_outcome=lambda x: gold.payment_outcomes(x.silver),
        fact_payment_summary=lambda x: x.gold["fact_payment_summary"],
        fact_daily_revenue=lambda x: x.gold["fact_daily_revenue"],
    )
    return found


def _approx_profile(x: Layers) -> DataFrame:
    """The approximate profile: exact counts as they are, sketches by whether they are near enough."""
    return _near_enough(x.bronze, profiling.profile_tables(x.bronze, RUN, NOW, approx=True))


def _near_enough(bronze: Mapping[str, DataFrame], rough: DataFrame) -> DataFrame:
    keys = ["table_name", "column_name", "metric"]
    exact = profiling.profile_tables(bronze, RUN, NOW).select(*keys, F.col("metric_value").alias("exact"))
    value, true = (F.col(c).cast("double") for c in ("metric_value", "exact"))
    near = F.when(F.abs(value - true) <= 0.15 * true + 1, "near").otherwise(F.col("metric_value"))
    return rough.join(exact, keys).withColumn(
        "metric_value", F.when(F.col("metric") == "DISTINCT_COUNT", near).otherwise(F.col("metric_value"))
    ).drop("exact")


def _parted(x: Layers) -> Lake:
    """Bronze in two writes of each table; states are kept after the first and after the second."""
    lake = _lake(x)
    for part in range(2):
        for feed, df in x.bronze.items():
            lake.append_log(df.filter(F.pmod(F.xxhash64(df.columns[0]), F.lit(3)).isin([0] if part else [1, 2])),
                            "bronze", feed, f"drop-{part}")
        states.keep_states(lake, {"bronze": LAYERS["bronze"]})
    return lake


def _profile_states(x: Layers) -> DataFrame:
    """The profile from states: exact counts as they are, sketches by whether they are near enough."""
    lake = _parted(x)
    # The exact profile reads the tables that the states are of, and derives no feed once more.
    stored = {feed: lake.read("bronze", feed) for feed in LAYERS["bronze"]}
    return _near_enough(stored, states.profile_from_states(lake, LAYERS["bronze"], RUN, NOW))


def check_queries() -> dict:
    orders, fk = "orders", ("bronze", "orders", A.CUSTOMER_FK, "customer_id,order_id")

    def metric(x, layer, table, name, argument):
        return quality.dq_metric(
            x.all[layer][table], layer, table, name, argument, NOW, A.CHANGE_TIMES.get(table),
            x.bronze["customers"],
        )

    return dict(
        profile_table=lambda x: profiling.profile_tables(x.bronze, RUN, NOW),
        profile_table_approx=_approx_profile,
        profile_states=_profile_states,
        dq_states=lambda x: states.metrics_from_states(
            _parted(x), NOW, [a for a in A.ATTACHMENTS if a[0] == "bronze"]
        ),
        iqr_outliers=lambda x: anomalies.iqr_outliers(x.silver["stg_orders"]),
        high_discount=lambda x: anomalies.high_discount(x.silver["stg_order_items"]),
        dormant_customers=lambda x: anomalies.dormant_customers(
            x.silver["stg_customers"], x.silver["stg_orders"], AS_OF
        ),
        anomaly_flags=lambda x: x.flags(),
        rfm_scores=lambda x: x.scores(),
        rfm_ntile=lambda x: rfm.rfm_ntile(x.gold["dim_customers"], NOW),
        run_summary=lambda x: profiling.run_summary(
            {**x.all, "gold": {**x.gold, "customer_rfm_scores": x.scores()}}, RUN, NOW
        ),
        gate_bronze=lambda x: gates.validate_bronze(x.bronze),
        gate_silver=lambda x: gates.validate_silver(x.silver),
        gate_gold=lambda x: gates.validate_gold(x.gold, x.silver),
        gate_message=lambda x: gates.gate_message(x.all_checks()),
        dq_null_count=lambda x: metric(x, "bronze", orders, A.NULL, "order_id"),
        dq_duplicate_count=lambda x: metric(x, "bronze", orders, A.DUPLICATE, "customer_id"),
        dq_row_count=lambda x: metric(x, "bronze", orders, A.ROWS, ""),
        dq_freshness=lambda x: metric(x, "bronze", orders, A.FRESHNESS, ""),
        dq_positive_amounts=lambda x: metric(x, "silver", "stg_orders", A.NEGATIVE, "total_amount"),
        dq_orders_customer_fk=lambda x: metric(x, *fk),
        dq_suite=lambda x: quality.dq_suite(x.stored(), NOW),
        dq_results_read=lambda x: quality.dq_results_read(x.metric_log()),
        dq_latest=lambda x: quality.dq_latest(x.metric_log()),
        dq_status=lambda x: quality.dq_status(quality.dq_latest(x.metric_log())),
        dq_scorecard=lambda x: quality.dq_scorecard(
            quality.dq_status(quality.dq_latest(x.metric_log())), x.metric_log()
        ),
        dq_trend=lambda x: quality.dq_trend(x.metric_log(), A.ROWS),
        dq_inventory=lambda x: quality.dq_inventory(x.metric_log()),
        schema_tests=lambda x: quality.schema_tests(ChainMap(x.stored()["silver"], x.stored()["gold"])),
    )


def governance_queries() -> dict:
    return dict(
        tag_definitions=lambda x: governance.definition_use(
            governance.tag_definitions(x.spark), x.references()
        ),
        tag_assignments=lambda x: governance.placed_assignments(
            governance.tag_assignments(x.spark), x.tagged()
        ),
        tag_validate=lambda x: governance.tag_validate(
            x.references(), governance.tag_definitions(x.spark)
        ),
        tag_references=lambda x: x.references(),
        tag_coverage=lambda x: governance.tag_coverage(x.references(), x.inventory()),
        tag_distribution=lambda x: governance.tag_distribution(x.references()),
        governance_kpis=lambda x: governance.governance_kpis(
            x.references(), x.inventory(), quality.dq_inventory(x.metric_log()), x.latest_flags()
        ),
        pii_inventory=lambda x: x.personal(),
        pii_by_layer=lambda x: governance.pii_by_layer(x.personal()),
        pii_propagation=lambda x: governance.pii_propagation(x.personal()),
        classification_distribution=lambda x: governance.classification_distribution(
            x.references()
        ),
        quality_tier_by_layer=lambda x: governance.quality_tier_by_layer(x.references()),
        tables_by_layer=lambda x: governance.tables_by_layer(x.references()),
        domain_coverage=lambda x: governance.domain_coverage(x.references()),
        row_count_consistency=lambda x: governance.row_count_consistency(x.tagged()),
        profile_log_read=lambda x: governance.profile_log_read(x.profile_log()),
        anomalies_by_type=lambda x: governance.anomalies_by_type(x.flag_log()),
        anomaly_kpis=lambda x: governance.anomaly_kpis(x.flag_log()),
        anomaly_timeline=lambda x: governance.anomaly_timeline(x.flag_log()),
        anomaly_details=lambda x: governance.anomaly_details(
            x.flag_log(), ["AMOUNT_OUTLIER", "DORMANT_CUSTOMER"], 500
        ),
        null_highlights=lambda x: governance.null_highlights(
            reports.rpt_latest_profile(x.profile_log()), 20
        ),
    )


def report_queries() -> dict:
    def daily(x):
        return reports.rpt_daily_revenue(x.gold)

    def segments(x):
        return reports.rpt_customer_segments(x.gold)

    def shipments(x):
        return reports.rpt_shipment_performance(x.gold)

    def latest(x):
        return reports.rpt_latest_profile(x.profile_log())

    return dict(
        rpt_daily_revenue=daily,
        rpt_kpis=lambda x: reports.rpt_kpis(x.gold),
        rpt_customer_segments=segments,
        rpt_top_products=lambda x: reports.rpt_top_products(x.gold),
        rpt_top15=lambda x: reports.rpt_top15(x.gold, 15),
        rpt_shipment_performance=shipments,
        rpt_payment_summary=lambda x: reports.rpt_payment_summary(x.gold),
        rpt_payment_health=lambda x: reports.rpt_payment_health(
            reports.rpt_payment_summary(x.gold)
        ),
        rpt_rfm_segments=lambda x: reports.rpt_rfm_segments(x.scores()),
        rpt_anomaly_summary=lambda x: reports.rpt_anomaly_summary(x.latest_flags()),
        rpt_anomaly_totals=lambda x: reports.rpt_anomaly_totals(
            reports.rpt_anomaly_summary(x.latest_flags())
        ),
        rpt_latest_profile=latest,
        rpt_latest_run=lambda x: reports.rpt_latest_run(x.run_log()),
        rpt_status_monthly=lambda x: reports.rpt_status_monthly(daily(x)),
        rpt_channel_mix=lambda x: reports.rpt_channel_mix(daily(x)),
        rpt_orders_vs_customers=lambda x: reports.rpt_orders_vs_customers(daily(x)),
        rpt_spend_by_segment=lambda x: reports.rpt_spend_by_segment(segments(x)),
        rpt_loyalty_mix=lambda x: reports.rpt_loyalty_mix(segments(x)),
        rpt_segment_detail=lambda x: reports.rpt_segment_detail(segments(x)),
        rpt_category_revenue=lambda x: reports.rpt_category_revenue(x.gold),
        rpt_low_stock=lambda x: reports.rpt_low_stock(x.gold),
        rpt_carrier_on_time=lambda x: reports.rpt_carrier_on_time(shipments(x)),
        rpt_speed_mix=lambda x: reports.rpt_speed_mix(shipments(x)),
        rpt_profile_rows=lambda x: reports.rpt_profile_rows(latest(x)),
        rpt_profile_nulls=lambda x: reports.rpt_profile_nulls(latest(x), 15),
    )


# ------------------------------------------------- sources, sinks and the run


def _csv_files(x: Layers, *feeds: str) -> str:
    """A folder of CSV files whose names start with the feed, one writer each."""
    folder = fresh_dir(x.spark, "landing")
    for feed in feeds:
        _write_named(x.bronze[feed], folder, feed)
    return folder


def _write_named(df: DataFrame, folder: str, feed: str, drop: str = "") -> None:
    """CSV part files named after the feed."""
    staged = f"{folder}/_staged_{feed}{drop}"
    with shuffles_freed(df.sparkSession):
        df.write.option("header", True).csv(staged)
    _name_files(df, staged, folder, feed, drop, "csv")


def _write_text(lines: DataFrame, folder: str, feed: str) -> None:
    """A file of a header and the given lines, named after the feed."""
    staged = f"{folder}/_staged_lines_{feed}"
    header = lines.sparkSession.createDataFrame([("header",)], "line string")
    header.unionByName(lines).coalesce(1).write.text(staged)
    _name_files(lines, staged, folder, feed, "9", "txt")


def _name_files(df: DataFrame, staged: str, folder: str, feed: str, drop: str, kind: str) -> None:
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(staged)
    fs = source.getFileSystem(conf)
    number = 1000 if drop else 0
    for spot, status in enumerate(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{staged}/*.{kind}"))):
        name = f"{feed}_v{spot + number}{drop if drop.isdigit() else ''}.csv"
        fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))


def _read_csv(x: Layers) -> DataFrame:
    folder = _csv_files(x, "customers")
    return csv_feed.read_bronze_csv(x.spark, folder, "customers")


def _files_match(x: Layers) -> DataFrame:
    """Order files only, from a folder that also holds order_items files."""
    folder = _csv_files(x, "orders", "order_items")
    return csv_feed.read_bronze_csv(x.spark, folder, "orders")


def _typed(x: Layers) -> DataFrame:
    feed = x.bronze["order_items"]
    texts = feed.select(
        *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(feed.columns)]
    )
    return csv_feed.as_typed(texts, "order_items")


def _ingest(x: Layers, feed: str):
    """Ingest a feed twice: the files are there before the first run."""
    folder, lake, checkpoint = _csv_files(x, feed), _lake(x), fresh_dir(x.spark, "checkpoint")
    runs = [ingest.ingest_stream(lake, folder, feed, checkpoint) for _ in range(2)]
    return lake.read("bronze", feed), runs


def _has_data(x: Layers) -> DataFrame:
    """Three runs: over the files, over nothing, and over lines that don't fit."""
    folder, lake, checkpoint = _csv_files(x, "orders"), _lake(x), fresh_dir(x.spark, "checkpoint")
    runs = []
    for spot in range(3):
        if spot == 2:
            _write_text(x.bronze["orders"].select(F.concat(F.lit("x"), "order_id", F.lit(",,,,,")).alias("line")),
                        folder, "orders")
        runs.append(ingest.ingest_stream(lake, folder, "orders", checkpoint))
    rows = [(spot + 1, ingest.has_new_data([run])) for spot, run in enumerate(runs)]
    return x.spark.createDataFrame(rows, "run int, has_new_data boolean")


def _change_feed(x: Layers) -> DataFrame:
    """Consume the change feed of a table that is appended to in between."""
    lake = Lake(x.spark, fresh_dir(x.spark, "lake"))
    seen, checkpoint = f"{lake.root}/seen", fresh_dir(x.spark, "checkpoint")

    def keep(batch: DataFrame, number: int) -> None:
        # A batch that is repeated after a failure replaces its own folder.
        batch.write.mode("overwrite").parquet(f"{seen}/batch={number}")

    feed = x.bronze["payments"]
    cut = F.col("payment_date") <= F.lit(EARLIER.date())
    # The second part is written twice, as by a run that is repeated.
    for run, part in (("1", feed.filter(cut)), ("2", feed.filter(~cut)), ("2", feed.filter(~cut))):
        lake.append_log(part, "bronze", "payments", run)
        ingest.consume_table(lake, "bronze", "payments", checkpoint, keep)
    return x.spark.read.parquet(seen).select(BRONZE["payments"].names)


def _versions_feed(x: Layers) -> DataFrame:
    """Changes of three drops of orders, each consumed by a query of its own: first rows, then changed,
    new and removed ones, then some that come back or go.  Every drop also holds the rows that stay as they are."""
    landing, checkpoint = fresh_dir(x.spark, "versions"), fresh_dir(x.spark, "checkpoint")
    seen, before = fresh_dir(x.spark, "seen"), None

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{seen}/batch={number}")

    first, second = order_versions(x)
    third = x.bronze["orders"].filter("order_id % 5 <> 0 or order_date is null")
    for number, drop in enumerate((first, second, third), 1):
        versions.land_versions(drop, landing, number, before, "order_id")
        feed = versions.net_changes(versions.row_versions(x.spark, landing, "orders"), "order_id")
        ingest.consume_changes(feed, checkpoint, keep)
        before = drop
    return x.spark.read.parquet(seen).select(F.col("_version").alias("drop"), "action", *BRONZE["orders"].names)


def order_versions(x: Layers) -> tuple[DataFrame, DataFrame]:
    """Orders as known at the earlier run, and today without the first years."""
    orders = x.bronze["orders"]
    placed = F.col("order_date")
    late = placed >= F.lit(dt.date(2000, 12, 1))
    open_status = F.when(late, "pending").otherwise(F.col("status"))
    old = orders.filter(placed <= F.lit(EARLIER.date())).withColumn("status", open_status)
    new = orders.filter(placed >= F.lit(dt.date(1996, 1, 1)))
    return old, new


def _lake(x: Layers) -> Lake:
    return Lake(x.spark, fresh_dir(x.spark, "lake"))


def _overwrite(x: Layers) -> DataFrame:
    lake = _lake(x)
    lake.publish(x.silver["stg_orders"], "silver", "stg_products")
    return lake.publish(x.silver["stg_products"], "silver", "stg_products")


def _append(x: Layers) -> DataFrame:
    """The flags of two runs, the second of which is repeated."""
    lake = _lake(x)
    lake.append_log(
        anomalies.anomaly_flags(x.silver, EARLIER.date(), EARLIER_RUN, EARLIER), "silver",
        "anomaly_flags", EARLIER_RUN,
    )
    lake.append_log(x.flags(), "silver", "anomaly_flags", RUN)
    return lake.append_log(x.flags(), "silver", "anomaly_flags", RUN)


def _replace(x: Layers) -> DataFrame:
    lake = _lake(x)
    scores = x.scores()
    lake.replace_if_any(scores, "gold", "customer_rfm_scores")
    lake.replace_if_any(scores, "gold", "customer_rfm_scores")
    return lake.replace_if_any(scores.limit(0), "gold", "customer_rfm_scores")


def _metric_rows(x: Layers) -> DataFrame:
    lake = _lake(x)
    return lake.append_log(x.metric_log(), "governance", "metric_results")


def _land_bronze(x: Layers) -> str:
    lake = _lake(x)
    for feed in FEEDS:
        lake.publish(x.bronze[feed], "bronze", feed)
    return lake.root


def _sized(inventory: DataFrame, size: str) -> DataFrame:
    """An inventory by what another engine can tell, too: names, rows, and that sizes and times are there."""
    return inventory.select(
        "table_schema", "table_name", "row_count", F.col(size).isNotNull().alias("has_size"),
        F.col("last_altered").isNotNull().alias("has_time"),
    )


def _inventory(x: Layers) -> DataFrame:
    return _sized(x.stored_tables(), "bytes")


def _promote(x: Layers) -> DataFrame:
    """Build Silver behind the Bronze gate, once as is and once without products."""
    rows = []
    lake = _lake(x)
    for spot, feeds in enumerate((
        {**x.bronze}, {**x.bronze, "products": x.bronze["products"].filter("product_id is null")}
    )):
        message = medallion.gate_text(gates.validate_bronze(feeds))
        built = medallion.gated_promote(message, 1, "silver", lambda: lake.publish(
            silver.stg_products(feeds), "silver", "stg_products"))
        rows.append((spot + 1, *built))
    return x.spark.createDataFrame(rows, medallion.STEP_SCHEMA)


# A measure of each Gold table by which a whole run is compared.
CHECKSUMS = {
    "dim_customers": "lifetime_spend", "dim_products": "total_revenue", "dim_dates": "year_num",
    "fact_sales": "net_revenue", "fact_daily_revenue": "gross_revenue",
    "fact_payment_summary": "total_amount_completed", "fact_shipment_performance": "delivery_days",
}


def _run(x: Layers) -> DataFrame:
    """The steps of a run, and rows and checksum of every Gold table it left."""
    with shuffles_freed(x.spark):
        root = _land_bronze(x)
    return _with_checksums(x, root, medallion.run_medallion(x.spark, root, AS_OF, NOW, RUN))


def _with_checksums(x: Layers, root: str, steps: DataFrame) -> DataFrame:
    lake = Lake(x.spark, root)
    for spot, (table, measure) in enumerate(CHECKSUMS.items()):
        total = F.sum(measure).cast("decimal(30,2)").cast("string")
        steps = steps.unionByName(lake.read("gold", table).agg(
            F.concat(F.count("*").cast("string"), F.lit(" rows, "), total).alias("message")
        ).select(F.lit(101 + spot).alias("step_no"), F.lit(table).alias("step"),
                 F.lit("STORED").alias("status"), "message"))
    return steps


def _increment(x: Layers) -> DataFrame:
    """All feeds in two drops, the second of which is what was ordered, paid and sent late: a run for each.

    The steps of the second run, and rows and checksum of every Gold table.
    """
    lake, cut = _lake(x), F.lit(dt.date(2001, 5, 1))
    late = {"orders": F.col("order_date") >= cut, "payments": F.col("payment_date") >= cut,
            "shipments": F.col("ship_date") >= cut}
    late = {feed: F.coalesce(condition, F.lit(False)) for feed, condition in late.items()}
    ordered = x.bronze["orders"].filter(late["orders"]).select("order_id")
    for spot in range(2):
        for feed, df in x.bronze.items():
            if feed == "order_items":
                part = df.join(ordered, "order_id", "left_semi" if spot else "left_anti")
            elif feed in late:
                part = df.filter(late[feed] if spot else ~late[feed])
            else:
                part = df.filter("false") if spot else df
            # Late payments and shipments may be of early orders.
            with shuffles_freed(x.spark):
                lake.append_log(part, "bronze", feed, f"drop-{spot}")
        steps = increment.run_increment(x.spark, lake.root, AS_OF, NOW, f"run-{spot + 1}")
    return _with_checksums(x, lake.root, steps)


def _arrivals(x: Layers) -> DataFrame:
    """Two drops of files, a bad line in each feed, and a call without any: what came of them."""
    landing, root = fresh_dir(x.spark, "landing"), fresh_dir(x.spark, "lake")
    cut, found = F.col("payment_date") <= F.lit(EARLIER.date()), []

    def arrive() -> None:
        for step in arrivals.on_arrival(x.spark, landing, root, AS_OF, NOW, RUN).collect():
            found.append((f"call {calls}", f"{step.step} {step.status}", 1))

    for feed, df in x.bronze.items():
        _write_named(df.filter(cut) if feed == "payments" else df, landing, feed)
        width = len(BRONZE[feed])
        bad = x.spark.createDataFrame([("x9" + "," * (width - 1),)], "line string")
        _write_text(bad, landing, feed)
    calls = 1
    arrive()
    _write_named(x.bronze["payments"].filter(~cut), landing, "payments", "late")
    for calls in (2, 3):
        arrive()
    for feed in x.bronze:
        for kind, layer in (("stored", "bronze"), ("rejected", "rejects")):
            found.append((kind, feed, Lake(x.spark, root).read(layer, feed).count()))
    return x.spark.createDataFrame(found, "what string, name string, n long")


# ------------------------------------------------------------ failing checks

# What is wrong with each table: columns replaced, rows kept, rows repeated.  The oracle
# applies the same texts.
DIRTY = {
    ("bronze", "orders"): (
        {"order_id": "case when order_id % 17 = 0 then null else order_id end",
         "customer_id": "case when order_id % 19 = 0 then null else customer_id end"},
        "true", "order_id % 23 = 1"),
    ("bronze", "customers"): (
        {"email": "case when customer_id % 13 = 0 then null else email end"}, "true", "customer_id % 29 = 1"),
    ("bronze", "products"): ({}, "true", "product_id % 31 = 1"),
    ("bronze", "shipments"): ({}, "false", "false"),
    ("silver", "stg_orders"): (
        {"customer_id": "case when order_id % 7 = 0 then -customer_id when order_id % 11 = 0 then null "
                        "else customer_id end",
         "order_date": "case when order_id % 13 = 0 then null else order_date end",
         "total_amount": "case when order_id % 5 = 0 then -total_amount else total_amount end",
         "status": "case when order_id % 3 = 0 then 'ODD' else status end"}, "true", "order_id % 37 = 1"),
    ("silver", "stg_order_items"): (
        {"order_id": "case when order_item_id % 9 = 0 then -order_id else order_id end"}, "true", "false"),
    ("silver", "stg_payments"): (
        {"order_id": "case when payment_id % 8 = 0 then null else order_id end"}, "true", "false"),
    ("silver", "stg_products"): ({}, "false", "false"),
    ("gold", "fact_sales"): (
        {"order_id": "case when order_id % 10 = 0 then null else order_id end"}, "order_id % 3 <> 0", "false"),
    ("gold", "dim_customers"): (
        {"loyalty_tier": "case when customer_id % 6 = 0 then 'WOOD' else loyalty_tier end"},
        "true", "customer_id % 41 = 1"),
    ("gold", "dim_products"): ({}, "false", "false"),
    ("gold", "dim_dates"): ({}, "false", "false"),
    ("gold", "fact_shipment_performance"): (
        {"shipment_id": "case when shipment_id % 9 = 0 then null else shipment_id end"}, "true", "false"),
    ("gold", "fact_payment_summary"): (
        {"payment_outcome": "case when order_id % 12 = 0 then 'ODD' else payment_outcome end",
         "order_id": "case when order_id % 14 = 0 then null else order_id end"}, "true", "false"),
    ("gold", "fact_daily_revenue"): (
        {"revenue_date": "case when total_orders % 2 = 0 then null else revenue_date end"}, "true", "false"),
}


def dirty_layers(x: Layers) -> dict[str, Mapping[str, DataFrame]]:
    """The stored layers with faults of every kind that a check looks for."""
    clean = x.stored()

    def dirty(layer: str, table: str) -> DataFrame:
        df = clean[layer][table]
        if (layer, table) not in DIRTY:
            return df
        replaced, kept, repeated = DIRTY[layer, table]
        rows = df.filter(kept).unionByName(df.filter(repeated))
        return rows.selectExpr(*[f"{replaced[c]} as {c}" if c in replaced else c for c in df.columns])

    return {layer: Planned({n: (lambda layer=layer, n=n: dirty(layer, n)) for n in names})
            for layer, names in LAYERS.items()}


def _dirty_checks(x: Layers) -> Mapping[str, DataFrame]:
    dirty, clean = dirty_layers(x), x.stored()
    return Planned({
        "gate_bronze_dirty": lambda: gates.validate_bronze(dirty["bronze"]),
        "gate_silver_dirty": lambda: gates.validate_silver(dirty["silver"]),
        "gate_gold_dirty": lambda: gates.validate_gold(dirty["gold"], clean["silver"]),
    })


def _dirty_message(x: Layers) -> DataFrame:
    first, second, third = _dirty_checks(x).values()
    return gates.gate_message(first.unionByName(second).unionByName(third))


def _dirty_tests(x: Layers) -> DataFrame:
    dirty = dirty_layers(x)
    return quality.schema_tests(ChainMap(dirty["silver"], dirty["gold"]))


def dirty_queries() -> dict:
    return dict(
        **{n: (lambda x, n=n: _dirty_checks(x)[n])
           for n in ("gate_bronze_dirty", "gate_silver_dirty", "gate_gold_dirty")},
        gate_message_dirty=_dirty_message,
        schema_tests_dirty=_dirty_tests,
    )


def storage_queries() -> dict:
    return dict(
        src_csv=_read_csv,
        src_files_match=_files_match,
        src_bronze_typed=_typed,
        src_ingest_stream=lambda x: _ingest(x, "order_items")[0],
        src_backfill=lambda x: _ingest(x, "shipments")[0],
        src_has_data=_has_data,
        src_cdc_append=_change_feed,
        src_cdc_stream=_versions_feed,
        src_cdc_diff=lambda x: changes.snapshot_diff(*order_versions(x), "order_id"),
        src_inventory=_inventory,
        inventory_report=lambda x: _sized(governance.inventory_report(x.stored_tables()), "size_mb"),
        snk_overwrite=_overwrite,
        snk_append=_append,
        snk_replace=_replace,
        snk_metric_rows=_metric_rows,
        gated_promote=_promote,
        medallion_run=_run,
        increment_run=_increment,
        event_run=_arrivals,
    )


def layer_queries() -> dict:
    """The queries over given layers."""
    return {
        **model_queries(), **check_queries(), **governance_queries(), **report_queries(),
        **storage_queries(), **dirty_queries(),
    }


def all_queries() -> dict:
    """The queries over a folder of sample tables."""
    return {name: _on_layers(build) for name, build in layer_queries().items()}
