"""Oracle text of each registered query."""

from __future__ import annotations

import re

from checks.queries import CHECKSUMS, DIRTY
from checks.sql_models import CTES, TODAY, days, half_up, mean, with_ctes
from lodestrata.plans import attachments as A
from lodestrata.plans import tags as T
from lodestrata.plans.contracts import CONTRACTS
from lodestrata.schemas import BRONZE, LAYERS

NOW = "timestamp '2001-08-15 12:00:00'"
EARLIER = "timestamp '2000-12-31 12:00:00'"
EARLIER_DAY = "date '2000-12-31'"
RUN, EARLIER_RUN = "run-2", "run-1"

CTE_OF = {
    **{("bronze", name): f"b_{name}" for name in LAYERS["bronze"]},
    **{("silver", name): f"s_{name[4:]}" for name in LAYERS["silver"]},
    **{("gold", name): name for name in LAYERS["gold"]},
}
CTE_OF_TABLE = {table: cte for (_, table), cte in CTE_OF.items()}

TEXTS: dict[str, str] = {}


def _union(parts) -> str:
    return "\nunion all\n".join(parts)


# ------------------------------------------------------------------- models

for _key, _name in {
    "stg_customers": "s_customers",
    "stg_orders": "s_orders",
    "stg_order_items": "s_order_items",
    "stg_products": "s_products",
    "stg_payments": "s_payments",
    "stg_shipments": "s_shipments",
    "customer_orders": "g_customer_orders",
    "customer_payments": "g_customer_payments",
    "preferred_channel": "g_preferred_channel",
    "product_sales": "g_product_sales",
    "return_exposure": "g_return_exposure",
    "src_date_spine": "g_spine",
    "order_items_agg": "g_order_items",
    "payment_agg": "g_payments",
    "shipment_info": "g_shipments",
    "customer_order_counts": "g_order_counts",
    **{name: name for name in LAYERS["gold"]},
}.items():
    TEXTS[_key] = f"select * from {_name}"

TEXTS["customer_ratios"] = (
    "select customer_id, cancellation_rate, avg_days_between_orders, orders_per_month, "
    "net_paid from dim_customers"
)
TEXTS["loyalty_tier"] = (
    "select customer_id, total_orders, lifetime_spend, loyalty_tier from dim_customers"
)
TEXTS["product_inventory"] = (
    "select product_id, inventory_turnover, days_of_stock_remaining, sales_tier from dim_products"
)
TEXTS["sales_derived"] = (
    "select order_id, net_revenue, is_profitable, days_to_ship, days_to_deliver, "
    "is_repeat_customer, order_month, order_quarter, order_year from fact_sales"
)
TEXTS["payment_outcome"] = (
    "select order_id, completed_payments, failed_payments, refunded_payments, "
    "pending_payments, payment_outcome from fact_payment_summary"
)

# ---------------------------------------------------- earlier state of Bronze

for _table, _column in A.CHANGE_TIMES.items():
    CTES[f"e_{_table}"] = f"select * from b_{_table} where {_column} <= {EARLIER_DAY}"
EARLIER_OF = {name: f"e_{name}" if name in A.CHANGE_TIMES else f"b_{name}"
              for name in LAYERS["bronze"]}

# ------------------------------------------------------------------ profile


def _profile(cte_of: dict[str, str], run: str, ts: str) -> str:
    parts = []
    for table, schema in BRONZE.items():
        cte = cte_of[table]
        head = f"select '{run}' as profile_run_id, '{table.upper()}' as table_name, "
        tail = f", {ts} as profiled_at from {cte}"
        parts.append(f"{head}'*' as column_name, 'ROW_COUNT' as metric, "
                     f"cast(count(*) as varchar) as metric_value{tail}")
        for column in schema.names:
            nulls = f"(count(*) - count({column}))"
            pct = half_up(f"({nulls}::double / count(*)::double * 100.0::double)", 2)
            values = {
                "NULL_COUNT": nulls,
                "NULL_PCT": f"case when count(*) > 0 then {pct} else 0.0::double end",
                "DISTINCT_COUNT": f"count(distinct {column}) "
                                  f"+ coalesce(max(({column} is null)::int), 0)",
            }
            for metric, value in values.items():
                parts.append(f"{head}'{column.upper()}', '{metric}', "
                             f"cast({value} as varchar){tail}")
    return _union(parts)


_CURRENT = {name: f"b_{name}" for name in LAYERS["bronze"]}
CTES["l_profile"] = _profile(_CURRENT, RUN, NOW)
CTES["l_profile_log"] = _union(
    [_profile(EARLIER_OF, EARLIER_RUN, EARLIER), "select * from l_profile"]
)
TEXTS["profile_table"] = "select * from l_profile"
TEXTS["profile_log_read"] = (
    "select table_name, column_name, metric, metric_value, profiled_at from l_profile_log"
)
# The newest of the two runs in the log.
TEXTS["rpt_latest_profile"] = "select table_name, column_name, metric, metric_value from l_profile"
TEXTS["profile_table_approx"] = (
    "select * replace (case metric when 'DISTINCT_COUNT' then 'near' else metric_value end "
    "as metric_value) from l_profile"
)
TEXTS["profile_states"] = TEXTS["profile_table_approx"]
TEXTS["rpt_profile_rows"] = (
    "select table_name, cast(metric_value as bigint) as row_count from l_profile "
    "where metric = 'ROW_COUNT'"
)


def _null_share(limit: int) -> str:
    return (
        "select table_name, column_name, cast(metric_value as double) as null_pct from l_profile "
        "where metric = 'NULL_PCT' and cast(metric_value as double) > 0 "
        f"order by null_pct desc, table_name, column_name limit {limit}"
    )


TEXTS["rpt_profile_nulls"] = _null_share(15)
TEXTS["null_highlights"] = _null_share(20)

# ---------------------------------------------------------------- anomalies

CTES["a_bounds"] = """
select q1 - 1.5 * (q3 - q1) as low, q3 + 1.5 * (q3 - q1) as high from (
  select
    cast(round(quantile_cont(cast(total_amount as double), 0.25), 4) as decimal(18,4)) as q1,
    cast(round(quantile_cont(cast(total_amount as double), 0.75), 4) as decimal(18,4)) as q3
  from s_orders
) as quartiles
"""
CTES["a_outliers"] = """
select 'STG_ORDERS' as table_name, cast(order_id as varchar) as record_id,
  'AMOUNT_OUTLIER' as anomaly_type,
  'Amount $' || cast(total_amount as varchar) || ' outside IQR bounds [$'
    || cast(cast(low as decimal(18,2)) as varchar) || ', $'
    || cast(cast(high as decimal(18,2)) as varchar) || ']' as details
from s_orders, a_bounds where total_amount not between low and high
"""
CTES["a_discounts"] = """
select 'STG_ORDER_ITEMS' as table_name, cast(order_item_id as varchar) as record_id,
  'HIGH_DISCOUNT' as anomaly_type,
  'Discount ' || cast(discount_pct as varchar) || '% exceeds 50% threshold (order_item_id='
    || cast(order_item_id as varchar) || ')' as details
from s_order_items where discount_pct > 50
"""


def _dormant(today: str) -> str:
    return f"""
select 'STG_CUSTOMERS' as table_name, cast(customer_id as varchar) as record_id,
  'DORMANT_CUSTOMER' as anomaly_type,
  'Tenure >365 days with no orders in last 90 days' as details
from s_customers as c
where customer_tenure_days > 365 and not exists (
  select 1 from s_orders as o
  where o.customer_id = c.customer_id and {days('o.order_date', today)} <= 90
)
"""


CTES["a_dormant"] = _dormant(TODAY)
CTES["a_dormant_before"] = _dormant(EARLIER_DAY)


def _flags(dormant: str, run: str, ts: str) -> str:
    return f"""
select md5('{run}|' || table_name || '|' || record_id || '|' || anomaly_type) as anomaly_id,
  table_name, record_id, anomaly_type, details, {ts} as detected_at
from (select * from a_outliers union all select * from a_discounts
      union all select * from {dormant}) as found
"""


CTES["a_flags"] = _flags("a_dormant", RUN, NOW)
CTES["a_flag_log"] = _union(
    ["select * from a_flags", _flags("a_dormant_before", EARLIER_RUN, EARLIER)]
)
TEXTS.update(
    iqr_outliers="select * from a_outliers",
    high_discount="select * from a_discounts",
    dormant_customers="select * from a_dormant",
    anomaly_flags="select * from a_flags",
    snk_append="select * from a_flag_log",
    anomalies_by_type=(
        "select anomaly_type, count(*) as anomalies from a_flag_log group by anomaly_type"
    ),
    anomaly_kpis="""
        select count(*) as total_anomalies,
          count(*) filter (where anomaly_type = 'DORMANT_CUSTOMER') as dormant_customers,
          count(*) filter (where anomaly_type = 'AMOUNT_OUTLIER') as amount_outliers
        from a_flag_log
    """,
    anomaly_timeline="""
        select cast(detected_at as date) as detected_date, anomaly_type, count(*) as anomalies
        from a_flag_log group by 1, 2
    """,
    anomaly_details="""
        select record_id, anomaly_type, details, detected_at from a_flag_log
        where anomaly_type in ('AMOUNT_OUTLIER', 'DORMANT_CUSTOMER')
        order by detected_at desc, anomaly_type, record_id limit 500
    """,
    rpt_anomaly_summary="""
        select anomaly_type, table_name, count(*) as cnt from a_flags group by 1, 2
    """,
    rpt_anomaly_totals="""
        select cast(sum(cnt) as bigint) as total_anomalies, count(*) as anomaly_types
        from (select anomaly_type, table_name, count(*) as cnt from a_flags group by 1, 2) as g
    """,
)

# ---------------------------------------------------------------------- RFM


def _cuts(column: str, short: str) -> str:
    return ", ".join(
        f"list_sort(list({column}))[(count({column}) * {i}) // 4 + 1] as {short}{i}"
        for i in (1, 2, 3)
    )


CTES["r_base"] = (
    "select customer_id, days_since_last_order as r, total_orders as f, lifetime_spend as m "
    "from dim_customers where total_orders > 0"
)
CTES["r_cuts"] = f"select {_cuts('r', 'r')}, {_cuts('f', 'f')}, {_cuts('m', 'm')} from r_base"
CTES["r_scored"] = """
select customer_id,
  cast(5 - case when r <= r1 then 1 when r <= r2 then 2 when r <= r3 then 3 else 4 end as bigint)
    as recency_score,
  cast(case when f <= f1 then 1 when f <= f2 then 2 when f <= f3 then 3 else 4 end as bigint)
    as frequency_score,
  cast(case when m <= m1 then 1 when m <= m2 then 2 when m <= m3 then 3 else 4 end as bigint)
    as monetary_score
from r_base, r_cuts
"""
CTES["r_scores"] = f"""
select *, case when mean_score >= 3.5 then 'CHAMPION' when mean_score >= 2.5 then 'LOYAL'
    when mean_score >= 1.5 then 'AT_RISK' else 'HIBERNATING' end as rfm_segment,
  {NOW} as scored_at
from (select *, (recency_score + frequency_score + monetary_score)::double / 3 as mean_score
      from r_scored) as s
"""
TEXTS["rfm_scores"] = TEXTS["snk_replace"] = "select * exclude (mean_score) from r_scores"
TEXTS["rfm_ntile"] = f"""
select customer_id, recency_score, frequency_score, monetary_score,
  case when total >= 11 then 'CHAMPION' when total >= 8 then 'LOYAL' when total >= 5 then 'AT_RISK'
    else 'HIBERNATING' end as rfm_segment, {NOW} as scored_at
from (select *, recency_score + frequency_score + monetary_score as total from (
  select customer_id,
    5 - ntile(4) over (order by coalesce(days_since_last_order, 9999), customer_id) as recency_score,
    ntile(4) over (order by total_orders, customer_id) as frequency_score,
    ntile(4) over (order by lifetime_spend, customer_id) as monetary_score
  from dim_customers where total_orders > 0))
"""
TEXTS["rpt_rfm_segments"] = f"""
select rfm_segment, count(*) as customer_count, {mean('recency_score')} as avg_r,
  {mean('frequency_score')} as avg_f, {mean('monetary_score')} as avg_m
from r_scores group by rfm_segment
"""

# -------------------------------------------------------------- run summary


def _counts(run: str, ts: str, tables: list[tuple[str, str, str | None]]) -> str:
    return _union(
        f"select '{run}' as run_id, '{layer.upper()}' as layer, '{name.upper()}' as table_name, "
        + (f"(select count(*) from {cte})" if cte else "-1")
        + f" as row_count, {ts} as run_timestamp"
        for layer, name, cte in tables
    )


_ALL_TABLES = [
    *((layer, name, cte) for (layer, name), cte in CTE_OF.items()),
    ("gold", "customer_rfm_scores", "r_scores"),
]
TEXTS["run_summary"] = _counts(RUN, NOW, _ALL_TABLES)
CTES["l_runs"] = _union([
    _counts(EARLIER_RUN, EARLIER,
            [(layer, n, EARLIER_OF[n] if layer == "bronze" else None) for layer, n, _ in _ALL_TABLES]),
    _counts(RUN, NOW, _ALL_TABLES),
])
TEXTS["rpt_latest_run"] = """
select layer, table_name, row_count, run_timestamp from l_runs
qualify run_timestamp = max(run_timestamp) over ()
"""

# -------------------------------------------------------------------- gates


def _orphans(child: str, key: str, parent: str) -> str:
    return f"(select count(*) from {child} where {key} is null or {key} not in " \
           f"(select {key} from {parent} where {key} is not null))"


def _repeats(cte: str, key: str) -> str:
    return f"(select count(*) from (select 1 from {cte} group by {key} having count(*) > 1))"


def _rows(cte: str, where: str = "true") -> str:
    return f"(select count(*) from {cte} where {where})"


def _check(gate: int, no: int, name: str, seen: str, text: str, want: str = "0",
           ok: str | None = None) -> str:
    ok = ok or f"{seen} = {want}"
    return (f"select {gate} as gate, {no} as check_no, '{name}' as check_name, "
            f"cast({seen} as bigint) as observed, cast({want} as bigint) as expected, "
            f"{ok} as passed, 'FAIL: ' || {text} as failure")


def _none(gate: int, no: int, name: str, seen: str, text: str) -> str:
    return _check(gate, no, name, seen, f"{seen} || ' {text}'")


def _same(no: int, table: str, staged: str, cte: str) -> str:
    a, b = _rows(table), _rows(cte)
    return _check(3, no, table, a, f"'{table} rows (' || {a} || ') != {staged} rows (' || {b} "
                  "|| ').'", b)


def _some(no: int, table: str) -> str:
    return _check(3, no, table, _rows(table), f"'{table} is empty.'", "1", f"{_rows(table)} > 0")


def _empties(ctes: list[str]) -> str:
    return "(" + " + ".join(f"({_rows(c)} = 0)::int" for c in ctes) + ")"


_short = {"cust": "customers", "ord": "orders", "oi": "order_items", "prod": "products",
          "pay": "payments", "ship": "shipments"}
CTES["c_bronze"] = _union([
    _none(1, 1, "orders_null_keys", _rows("b_orders", "order_id is null or customer_id is null"),
          "null key values in orders."),
    _none(1, 2, "customers_null_keys", _rows("b_customers", "customer_id is null or email is null"),
          "null key values in customers."),
    _check(1, 3, "empty_tables", _empties([f"b_{t}" for t in _short.values()]),
           "'One or more Bronze tables are empty (' || "
           + " || ', ' || ".join(f"'{s}=' || {_rows('b_' + t)}" for s, t in _short.items())
           + " || ').'"),
    _none(1, 4, "orders_duplicate_keys", _repeats("b_orders", "order_id"), "duplicate order_ids."),
    _none(1, 5, "customers_duplicate_keys", _repeats("b_customers", "customer_id"),
          "duplicate customer_ids."),
    _none(1, 6, "products_duplicate_keys", _repeats("b_products", "product_id"),
          "duplicate product_ids."),
])
CTES["c_silver"] = _union([
    _none(2, 1, "orphan_orders", _orphans("s_orders", "customer_id", "s_customers"),
          "orphan orders (no matching customer)."),
    _none(2, 2, "orphan_order_items", _orphans("s_order_items", "order_id", "s_orders"),
          "orphan order_items (no matching order)."),
    _none(2, 3, "orphan_payments", _orphans("s_payments", "order_id", "s_orders"),
          "orphan payments (no matching order)."),
    _none(2, 4, "orders_required_fields",
          _rows("s_orders", "order_id is null or customer_id is null or order_date is null"),
          "null required fields in stg_orders."),
    _none(2, 5, "orders_negative_amounts", _rows("s_orders", "total_amount < 0"),
          "negative amounts in stg_orders."),
    _check(2, 6, "empty_tables", _empties([f"s_{t}" for t in _short.values()]),
           "'One or more Silver tables are empty.'"),
])
_tiers = "'PLATINUM', 'GOLD', 'SILVER', 'BRONZE'"
_outcomes = "'CLEAN', 'RECOVERED', 'ALL_FAILED', 'REFUNDED', 'NO_PAYMENT'"
CTES["c_gold"] = _union([
    _same(1, "fact_sales", "stg_orders", "s_orders"),
    _same(2, "dim_customers", "stg_customers", "s_customers"),
    _same(3, "dim_products", "stg_products", "s_products"),
    _some(4, "dim_dates"),
    _same(5, "fact_shipment_performance", "stg_shipments", "s_shipments"),
    _same(6, "fact_payment_summary", "stg_orders", "s_orders"),
    _some(7, "fact_daily_revenue"),
    _none(3, 8, "fact_sales_null_keys", _rows("fact_sales", "order_id is null"),
          "null order_ids in fact_sales."),
    _none(3, 9, "fact_shipment_performance_null_keys",
          _rows("fact_shipment_performance", "shipment_id is null"),
          "null shipment_ids in fact_shipment_performance."),
    _none(3, 10, "fact_payment_summary_null_keys",
          _rows("fact_payment_summary", "order_id is null"),
          "null order_ids in fact_payment_summary."),
    _none(3, 11, "fact_daily_revenue_null_keys",
          _rows("fact_daily_revenue", "revenue_date is null"),
          "null revenue_dates in fact_daily_revenue."),
    _none(3, 12, "loyalty_tier_values",
          _rows("dim_customers", f"loyalty_tier not in ({_tiers})"),
          "invalid loyalty_tier values."),
    _none(3, 13, "payment_outcome_values",
          _rows("fact_payment_summary", f"payment_outcome not in ({_outcomes})"),
          "invalid payment_outcome values."),
    _check(3, 14, "core_tables", _empties(["fact_sales", "dim_customers", "dim_products"]),
           "'One or more core Gold tables are empty.'"),
])
CTES["c_all"] = "select * from c_bronze union all select * from c_silver " \
                "union all select * from c_gold"
CTES["c_messages"] = """
select gate, case when bool_and(passed) then 'GATE ' || gate || ' PASSED: '
  || case gate when 1 then 'Bronze data validated for Silver promotion'
       when 2 then 'Silver data validated for Gold promotion'
       else 'Gold data certified for analytics consumption' end
  else 'GATE ' || gate || ' FAILED (' || count(*) filter (where not passed) || ' checks): '
    || string_agg(failure || ' ', '' order by check_no) filter (where not passed)
  end as message
from c_all group by gate
"""
_steps = _union(
    f"select {no} as step_no, '{step}' as step, 'DONE' as status, {text} as message"
    for no, (step, text) in enumerate([
        ("bronze_gate", "(select message from c_messages where gate = 1)"),
        ("bronze_profile", "'Bronze profiling complete'"),
        ("silver_transform", "'Silver transformation completed successfully'"),
        ("anomalies", "'Anomaly detection complete'"),
        ("silver_gate", "(select message from c_messages where gate = 2)"),
        ("gold_transform", "'Gold transformation completed successfully'"),
        ("gold_enrichment", "'Gold enrichment complete'"),
        ("gold_gate", "(select message from c_messages where gate = 3)"),
    ], 1)
)
TEXTS["medallion_run"] = _union([_steps, *(
    f"select {101 + i}, '{table}', 'STORED', count(*) || ' rows, ' || "
    f"cast(cast(sum({measure}) as decimal(30,2)) as varchar) from {table}"
    for i, (table, measure) in enumerate(CHECKSUMS.items())
)])
# Steps and tables of a run over what is new are those of a run over everything.
TEXTS["increment_run"] = TEXTS["medallion_run"]
TEXTS.update(
    gate_bronze="select * from c_bronze",
    gate_silver="select * from c_silver",
    gate_gold="select * from c_gold",
    gate_message="select * from c_messages",
)
_no_products = _union([
    "select 1 as step_no, 'silver_transform' as step, 'DONE' as status, "
    "'Silver transformation completed successfully' as message "
    "where (select bool_and(passed) from c_bronze)",
    "select 2, 'silver_transform', 'SKIPPED', 'Silver transformation SKIPPED: Gate 1 did not "
    "pass. Result: GATE 1 FAILED (1 checks): FAIL: One or more Bronze tables are empty (' || "
    + " || ', ' || ".join(
        f"'{s}=' || " + ("0" if s == "prod" else _rows("b_" + t)) for s, t in _short.items())
    + " || '). '",
])
TEXTS["gated_promote"] = _no_products

# ------------------------------------------------------------ quality metrics


def _metric(layer: str, table: str, metric: str, argument: str, cte: str, customers: str,
            ts: str) -> str:
    key = argument.split(",")[0]
    changed = A.CHANGE_TIMES.get(table)
    value = {
        A.NULL: _rows(cte, f"{key} is null"),
        A.DUPLICATE: _repeats(cte, key),
        A.ROWS: _rows(cte),
        A.NEGATIVE: _rows(cte, f"{key} < 0"),
        A.CUSTOMER_FK: _rows(cte, f"{key} not in (select customer_id from {customers})"),
        A.FRESHNESS: f"(select date_diff('second', max({changed}), {ts}) from {cte})",
    }[metric]
    return (f"select '{layer.upper()}' as table_schema, '{table.upper()}' as table_name, "
            f"'{metric}' as metric_name, '{argument.upper()}' as argument_names, "
            f"cast({value} as bigint) as value, {ts} as measurement_time")


def _now_metric(layer: str, table: str, metric: str, argument: str) -> str:
    return _metric(layer, table, metric, argument, CTE_OF[layer, table], "b_customers", NOW)


TEXTS.update(
    dq_null_count=_now_metric("bronze", "orders", A.NULL, "order_id"),
    dq_duplicate_count=_now_metric("bronze", "orders", A.DUPLICATE, "customer_id"),
    dq_row_count=_now_metric("bronze", "orders", A.ROWS, ""),
    dq_freshness=_now_metric("bronze", "orders", A.FRESHNESS, ""),
    dq_positive_amounts=_now_metric("silver", "stg_orders", A.NEGATIVE, "total_amount"),
    dq_orders_customer_fk=_now_metric("bronze", "orders", A.CUSTOMER_FK, "customer_id,order_id"),
    dq_suite=_union(_now_metric(*a) for a in A.ATTACHMENTS),
    dq_states=_union(
        _now_metric(*a) for a in A.ATTACHMENTS
        if a[0] == "bronze" and a[2] not in (A.DUPLICATE, A.CUSTOMER_FK)
    ),
)
CTES["l_metrics"] = _union(
    text
    for a in A.ATTACHMENTS
    for text in (
        _now_metric(*a),
        *([_metric(*a, EARLIER_OF[a[1]], "e_customers", EARLIER)] if a[0] == "bronze" else []),
    )
)
CTES["l_latest"] = """
select table_schema, table_name, metric_name, argument_names, cast(value as double) as value,
  measurement_time
from (select *, row_number() over (partition by table_schema, table_name, metric_name
        order by measurement_time desc, argument_names desc) as place from l_metrics) as ranked
where place = 1
"""
CTES["l_status"] = """
select *, case
    when metric_name in ('NULL_COUNT', 'DUPLICATE_COUNT', 'DMF_POSITIVE_AMOUNTS',
      'DMF_ORDERS_CUSTOMER_FK')
      then case when value = 0 then 'PASS' else 'FAIL (' || cast(value as bigint) || ')' end
    when metric_name = 'ROW_COUNT' then case when value > 0 then 'OK' else 'EMPTY' end
    when metric_name = 'FRESHNESS' then cast(value as bigint) || 's ago'
    else cast(cast(value as bigint) as varchar) end as status
from l_latest
"""
_listed = ", ".join(
    "(" + ", ".join(f"'{part.upper()}'" for part in a) + ")"
    for a in A.ATTACHMENTS if a[1] in A.INVENTORY_TABLES
)
CTES["l_attachments"] = f"""
select *, '60 MINUTES' as schedule, case when exists (
    select 1 from l_metrics as m where m.table_schema = a.table_schema
      and m.table_name = a.table_name and m.metric_name = a.metric_name
      and m.argument_names = a.argument_names) then 'STARTED' else 'SUSPENDED' end
    as schedule_status
from (values {_listed}) as a(table_schema, table_name, metric_name, argument_names)
"""
TEXTS.update(
    dq_results_read="select * from l_metrics",
    snk_metric_rows="select * from l_metrics",
    dq_latest="select * from l_latest",
    dq_status="select * from l_status",
    dq_scorecard="""
        select count(*) filter (where status like 'PASS%' or status like 'OK%') as checks_passing,
          count(*) filter (where status like '%FAIL%') as checks_failing,
          (select count(*) from l_metrics) as total_results
        from l_status
    """,
    dq_trend="""
        select measurement_time, table_schema || '.' || table_name as label, value
        from l_metrics where metric_name = 'ROW_COUNT'
    """,
    dq_inventory="select * from l_attachments",
)


def _column_test(table: str, column: str, test: str, failures: str) -> str:
    return (f"select '{table}' as table_name, '{column}' as column_name, '{test}' as test, "
            f"cast({failures} as bigint) as failures, {failures} = 0 as passed")


def _column_tests() -> str:
    parts = []
    for c in CONTRACTS:
        cte = CTE_OF_TABLE[c.table]
        parts.append(_column_test(c.table, c.column, "not_null", _rows(cte, f"{c.column} is null")))
        if c.unique:
            known = f"(select * from {cte} where {c.column} is not null)"
            parts.append(_column_test(c.table, c.column, "unique", _repeats(known, c.column)))
        if c.accepted:
            listed = ", ".join(f"'{v}'" for v in c.accepted)
            parts.append(_column_test(c.table, c.column, "accepted_values",
                                      _rows(cte, f"{c.column} not in ({listed})")))
        if c.parent:
            parent, key = c.parent
            missing = (f"{c.column} not in (select {key} from {CTE_OF_TABLE[parent]} "
                       f"where {key} is not null)")
            parts.append(_column_test(c.table, c.column, "relationships", _rows(cte, missing)))
    return _union(parts)


TEXTS["schema_tests"] = _column_tests()

# --------------------------------------------------------------- governance

# Rows that two runs leave in the logs, whatever the data: three per column and one per
# table in the profile, and one per table in the run log.
_PROFILE_ROWS = 2 * sum(3 * len(schema.names) + 1 for schema in BRONZE.values())
_LOGS = [
    ("bronze", "data_profile_log", f"(select 1 from range({_PROFILE_ROWS})) as p"),
    ("silver", "anomaly_flags", "a_flag_log"),
    ("gold", "pipeline_run_summary", f"(select 1 from range({2 * len(_ALL_TABLES)})) as p"),
]
CTES["t_inventory"] = _union(
    f"select '{layer.upper()}' as table_schema, '{name.upper()}' as table_name, "
    f"count(*) as row_count from {cte}"
    for layer, name, cte in [*_ALL_TABLES, *_LOGS]
)
TEXTS["src_inventory"] = TEXTS["inventory_report"] = (
    "select *, true as has_size, true as has_time from t_inventory"
)
_tag_rows = [
    f"('{tag}', '{value}', 'RETAIL', '{layer}', '{table}', 'TABLE', null)"
    for layer, table, kind, domain in T.TABLES
    for tag, value in zip(T.TABLE_TAGS, (layer, kind, domain, T.QUALITY_BY_LAYER[layer]))
] + [
    f"('PII', 'TRUE', 'RETAIL', '{layer}', '{table}', 'COLUMN', '{column}')"
    for layer, table, columns in T.PERSONAL_COLUMNS
    for column in columns
]
CTES["t_references"] = f"""
select t.*, i.row_count from (values {', '.join(_tag_rows)}) as t(tag_name, tag_value,
  object_database, object_schema, object_name, domain, column_name)
join t_inventory as i on i.table_schema = t.object_schema and i.table_name = t.object_name
"""
CTES["t_personal"] = _union(
    f"select '{layer}' as schema_name, '{table}' as table_name, '{column}' as column_name, "
    f"(select count({column.lower()}) from {CTE_OF[layer.lower(), table.lower()]}) as values_held"
    for layer, table, columns in T.PERSONAL_COLUMNS
    for column in columns
)


def _per(tag: str, **keys: str) -> str:
    columns = ", ".join(f"{source} as {name}" for name, source in keys.items())
    return (f"select {columns}, count(*) as tables, cast(sum(row_count) as bigint) as "
            f"rows_covered from t_references where domain = 'TABLE' and tag_name = '{tag}' "
            f"group by {', '.join(keys.values())}")


_types = ", ".join(f"('{tag}')" for tag in T.TABLE_TAGS)
_allowed = ", ".join(
    f"('{tag}', '{value}')" for tag, values in T.DEFINITIONS.items() for value in values
)
TEXTS.update(
    tag_definitions=f"""
        select d.tag_name, d.allowed_value, count(r.tag_name) as uses,
          cast(coalesce(sum(r.row_count), 0) as bigint) as rows_covered
        from (values {_allowed}) as d(tag_name, allowed_value) left join t_references as r
          on r.tag_name = d.tag_name and r.tag_value = d.allowed_value
        group by 1, 2
    """,
    tag_assignments="select * from t_references",
    tag_validate=f"""
        select * from t_references where (tag_name, tag_value) not in (values {_allowed})
    """,
    tag_references="select * from t_references",
    tag_coverage=f"""
        select i.table_schema || '.' || i.table_name as full_name, k.tag_name,
          coalesce(r.tag_value, 'MISSING') as value, (r.tag_value is not null)::int as present
        from t_inventory as i cross join (values {_types}) as k(tag_name)
        left join t_references as r on r.object_schema = i.table_schema
          and r.object_name = i.table_name and r.tag_name = k.tag_name and r.domain = 'TABLE'
    """,
    tag_distribution="""
        select tag_name, count(*) as assignments, cast(sum(row_count) as bigint) as rows_covered
        from t_references group by tag_name
    """,
    classification_distribution=_per("DATA_CLASSIFICATION", classification="tag_value"),
    quality_tier_by_layer=_per("QUALITY_TIER", layer="object_schema", quality_tier="tag_value"),
    tables_by_layer=_per("PIPELINE_LAYER", layer="tag_value"),
    domain_coverage=_per("DATA_DOMAIN", layer="object_schema", data_domain="tag_value"),
    governance_kpis="""
        select count(distinct object_name) filter (where domain = 'TABLE') as tagged_tables,
          (select count(*) from t_inventory) as total_tables,
          count(*) filter (where domain = 'COLUMN' and tag_name = 'PII' and tag_value = 'TRUE')
            as pii_columns,
          (select count(*) from l_attachments) as active_metrics,
          (select count(*) from l_attachments where schedule_status = 'STARTED')
            as running_metrics,
          (select count(*) from a_flags) as anomalies_detected
        from t_references
    """,
    pii_inventory="select * from t_personal",
    pii_by_layer=(
        "select schema_name, count(*) as pii_columns from t_personal group by schema_name"
    ),
    pii_propagation="select column_name as pii_column, " + ", ".join(
        f"case when bool_or(schema_name = '{layer}') then 'Tagged' else '-' end as {layer.lower()}"
        for layer in ("BRONZE", "SILVER", "GOLD")
    ) + " from t_personal group by column_name",
    row_count_consistency=_union(
        "select *, case when bronze = silver and silver = gold then 'Yes' else 'No' end as match "
        f"from (select '{entity}' as entity, " + ", ".join(
            f"{_rows(CTE_OF[layer.lower(), table.lower()])} as {layer.lower()}"
            for layer, table in tables.items()
        ) + ") as sizes"
        for entity, tables in T.ENTITIES.items()
    ),
)

# ------------------------------------------------------------------ reports

CTES["p_daily"] = f"""
select cast(order_date as date) as revenue_date, count(*) as total_orders,
  count(distinct customer_id) as unique_customers, sum(order_total) as gross_revenue,
  sum(net_revenue) as net_revenue, {mean('order_total')} as avg_order_value,
  sum(if(order_status = 'COMPLETED', order_total, 0)) as completed_revenue,
  sum(if(order_status = 'CANCELLED', order_total, 0)) as cancelled_revenue,
  sum(if(order_status = 'RETURNED', order_total, 0)) as returned_revenue,
  count(*) filter (where channel = 'web') as web_orders,
  count(*) filter (where channel = 'mobile') as mobile_orders,
  count(*) filter (where channel = 'in-store') as instore_orders,
  count(*) filter (where channel = 'phone') as phone_orders,
  cast(sum(total_units) as bigint) as total_units_sold, sum(total_discount) as total_discount
from fact_sales group by 1
"""
CTES["p_segments"] = f"""
select segment, loyalty_tier, count(*) as customer_count,
  cast(sum(total_orders) as bigint) as total_orders, sum(lifetime_spend) as total_spend,
  {mean('cast(avg_order_value as decimal(20,6))')} as avg_aov,
  {mean('cast(cancellation_rate as decimal(5,2))')} as avg_cancel_rate
from dim_customers group by 1, 2
"""
CTES["p_shipments"] = f"""
select carrier, shipment_status, shipping_speed, count(*) as shipment_count,
  {mean('delivery_days')} as avg_delivery_days, {mean('days_order_to_ship')} as avg_days_to_ship,
  count(*) filter (where is_delayed) as delayed_count,
  count(*) filter (where is_delivered) as delivered_count
from fact_shipment_performance group by 1, 2, 3
"""
CTES["p_payments"] = f"""
select payment_outcome, count(*) as order_count, sum(total_amount_completed) as total_completed,
  sum(total_amount_refunded) as total_refunded, sum(total_amount_failed) as total_failed,
  {mean('cast(payment_success_rate as decimal(5,2))')} as avg_success_rate
from fact_payment_summary group by 1
"""
CTES["p_products"] = """
select product_id, product_name, category, brand, price_tier, sales_tier, total_revenue,
  total_units_sold, orders_with_product, margin_pct, profit_margin, stock_quantity, is_low_stock,
  days_of_stock_remaining
from dim_products
"""
TEXTS.update(
    rpt_daily_revenue="select * from p_daily",
    rpt_kpis=f"""
        select (select count(*) from dim_customers) as total_customers,
          (select sum(order_total) from fact_sales) as total_revenue,
          (select count(*) from fact_sales) as total_orders,
          (select {mean('order_total')} from fact_sales) as avg_order_value,
          (select count(*) from dim_products) as total_products,
          (select cast(sum(total_units) as bigint) from fact_sales) as total_units_sold
    """,
    rpt_customer_segments="select * from p_segments",
    rpt_top_products="select * from p_products",
    rpt_top15="select * from p_products order by total_revenue desc, product_id limit 15",
    rpt_shipment_performance="select * from p_shipments",
    rpt_payment_summary="select * from p_payments",
    rpt_payment_health="""
        select sum(total_completed) as total_completed, sum(total_refunded) as total_refunded,
          sum(total_failed) as total_failed,
          cast(sum(cast(avg_success_rate as decimal(20,6)) * order_count) as double)
            / sum(order_count)::double as success_rate
        from p_payments
    """,
    rpt_status_monthly=_union(
        "select cast(date_trunc('month', revenue_date) as date) as month, "
        f"'{kind}' as type, sum({kind.lower()}_revenue) as amount from p_daily group by 1"
        for kind in ("Completed", "Cancelled", "Returned")
    ),
    rpt_channel_mix=_union(
        f"select '{kind}' as channel, cast(sum({kind.lower()}_orders) as bigint) as orders "
        "from p_daily"
        for kind in ("Web", "Mobile", "Instore", "Phone")
    ),
    rpt_orders_vs_customers="""
        select revenue_date, 'Orders' as metric, total_orders as count from p_daily
        union all select revenue_date, 'Customers', unique_customers from p_daily
    """,
    rpt_spend_by_segment="""
        select segment, sum(total_spend) as total_spend,
          cast(sum(customer_count) as bigint) as customer_count
        from p_segments group by segment
    """,
    rpt_loyalty_mix="""
        select loyalty_tier, cast(sum(customer_count) as bigint) as customer_count
        from p_segments group by loyalty_tier
    """,
    rpt_segment_detail=f"""
        select segment, cast(sum(customer_count) as bigint) as customer_count,
          cast(sum(total_orders) as bigint) as total_orders, sum(total_spend) as total_spend,
          {mean('cast(avg_aov as decimal(20,6))')} as avg_aov,
          {mean('cast(avg_cancel_rate as decimal(20,6))')} as avg_cancel_rate
        from p_segments group by segment
    """,
    rpt_category_revenue=(
        "select category, sum(total_revenue) as total_revenue from dim_products group by category"
    ),
    rpt_low_stock="""
        select product_id, product_name, category, stock_quantity, total_units_sold,
          days_of_stock_remaining
        from dim_products where is_low_stock
    """,
    rpt_carrier_on_time=f"""
        select *, (delivered_count - delayed_count)::double
          / (case delivered_count when 0 then 1 else delivered_count end)::double * 100.0::double
          as on_time_pct
        from (select carrier, cast(sum(shipment_count) as bigint) as shipment_count,
            cast(sum(delivered_count) as bigint) as delivered_count,
            cast(sum(delayed_count) as bigint) as delayed_count,
            {mean('cast(avg_delivery_days as decimal(20,6))')} as avg_delivery_days
          from p_shipments group by carrier) as totals
    """,
    rpt_speed_mix="""
        select shipping_speed, cast(sum(shipment_count) as bigint) as shipment_count
        from p_shipments group by shipping_speed
    """,
)

# -------------------------------------------------------- sources and sinks


def _as_landed(feed: str) -> str:
    columns = ", ".join(
        f"nullif(trim({f.name}), '') as {f.name}" if f.dataType.simpleString() == "string"
        else f.name
        for f in BRONZE[feed].fields
    )
    return f"select {columns} from b_{feed}"


CTES["v_old"] = f"""
select * replace (case when order_date >= date '2000-12-01' then 'pending' else status end
  as status) from b_orders where order_date <= {EARLIER_DAY}
"""
CTES["v_new"] = "select * from b_orders where order_date >= date '1996-01-01'"
CTES["v_third"] = "select * from b_orders where order_id % 5 <> 0 or order_date is null"
CTES["v_none"] = "select * from b_orders where false"
TEXTS.update(
    src_csv=_as_landed("customers"),
    src_files_match=_as_landed("orders"),
    src_bronze_typed=_as_landed("order_items"),
    src_ingest_stream=_as_landed("order_items"),
    src_backfill=_as_landed("shipments"),
    src_has_data="""
        select 1 as run, (select count(*) from b_orders) > 0 as has_new_data
        union all select 2, false union all select 3, false
    """,
    src_cdc_append="select * from b_payments",
    src_cdc_stream=_union(
        f"""
        select {drop}::bigint as "drop", 'INSERT' as action, n.* from {new} as n
          where not exists (select 1 from {old} as o where o.order_id = n.order_id)
        union all select {drop}, 'DELETE', o.* from {old} as o
          where not exists (select 1 from {new} as n where n.order_id = o.order_id)
        union all select {drop}, 'UPDATE', n.* from {new} as n join {old} as o on o.order_id = n.order_id
          where (n.customer_id, n.order_date, n.status, n.channel, n.total_amount)
            is distinct from (o.customer_id, o.order_date, o.status, o.channel, o.total_amount)
        """
        for drop, old, new in ((1, "v_none", "v_old"), (2, "v_old", "v_new"), (3, "v_new", "v_third"))
    ),
    src_cdc_diff="""
        select 'INSERT' as action, n.* from v_new as n
          where not exists (select 1 from v_old as o where o.order_id = n.order_id)
        union all select 'DELETE', o.* from v_old as o
          where not exists (select 1 from v_new as n where n.order_id = o.order_id)
        union all select 'UPDATE', n.* from v_new as n join v_old as o on o.order_id = n.order_id
          where o.status is distinct from n.status
    """,
    snk_overwrite="select * from s_products",
)


# ------------------------------------------------------------ failing checks


def _faulty(text: str) -> str:
    """The text over the tables with faults."""
    for key in DIRTY:
        text = re.sub(rf"\b(from|join) {CTE_OF[key]}\b", rf"\1 d_{CTE_OF[key]}", text)
    return text


for _key, (_replaced, _kept, _repeated) in DIRTY.items():
    _columns = ", ".join(f"{sql} as {name}" for name, sql in _replaced.items())
    _cte = CTE_OF[_key]
    CTES[f"d_{_cte}"] = (
        f"select *{f' replace ({_columns})' if _columns else ''} from (select * from {_cte} where {_kept} "
        f"union all select * from {_cte} where {_repeated}) as rows_"
    )
CTES["dc_bronze"] = _faulty(CTES["c_bronze"])
CTES["dc_silver"] = _faulty(CTES["c_silver"])
# Gold is compared to the clean Silver.
_dirty_gold = CTES["c_gold"]
for (_layer, _table) in DIRTY:
    if _layer == "gold":
        _dirty_gold = re.sub(rf"\bfrom {_table}\b", f"from d_{_table}", _dirty_gold)
CTES["dc_gold"] = _dirty_gold
CTES["dc_all"] = "select * from dc_bronze union all select * from dc_silver " \
                 "union all select * from dc_gold"
TEXTS.update(
    gate_bronze_dirty="select * from dc_bronze",
    gate_silver_dirty="select * from dc_silver",
    gate_gold_dirty="select * from dc_gold",
    gate_message_dirty=CTES["c_messages"].replace("from c_all", "from dc_all"),
    schema_tests_dirty=_faulty(_column_tests()),
    event_run=_union([
        *(f"select 'call {call}' as what, '{step} DONE' as name, 1 as n" for call in (1, 2) for step in (
            "bronze_gate", "bronze_profile", "silver_transform", "anomalies", "silver_gate",
            "gold_transform", "gold_enrichment", "gold_gate")),
        "select 'call 3', 'ingest SKIPPED', 1",
        *(f"select 'stored', '{feed}', count(*) from b_{feed}" for feed in LAYERS["bronze"]),
        *(f"select 'rejected', '{feed}', 1" for feed in LAYERS["bronze"]),
    ]),
)


def all_oracles() -> dict[str, str]:
    return {name: with_ctes(text) for name, text in TEXTS.items()}
