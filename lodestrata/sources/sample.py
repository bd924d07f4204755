"""Bronze feeds derived from the sample star-schema tables.

Each text is valid in Spark and in ANSI engines alike; ``{name}`` stands for
an input table and ``{ts}`` for the engine's timestamp type.  Every row of the
sample tables is used.  Some customers and products are swapped for their
neighbour so that customers without orders and products without sales occur;
pending orders have no payment; a failed payment of a web or mobile order is
tried once more.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2001, 8, 15)

# Inputs and text of each feed, in build order.
FEEDS: dict[str, tuple[dict[str, str], str]] = {
    "customers": (
        {"customer": "customer", "nation": "nation"},
        """
        select c_custkey as customer_id,
          ' ' || split_part(c_name, '#', 1) as first_name,
          split_part(c_name, '#', 2) || ' ' as last_name,
          ' ' || upper(replace(c_name, '#', '.')) || '@Example' || cast(c_custkey % 7 as string)
            || '.COM' as email,
          '555-' || split_part(c_name, '#', 2) as phone,
          ' City ' || cast(c_nationkey as string) as city,
          lower(substr(n_name, 1, 2)) as state,
          cast(10000 + c_custkey % 90000 as string) as zip_code,
          case c_mktsegment when 'BUILDING' then 'vip' when 'AUTOMOBILE' then 'premium'
            when 'MACHINERY' then 'new' else 'regular' end as segment,
          cast(date '1994-01-01' + cast(c_custkey * 37 % 2700 as int) as {ts}) as created_at
        from {customer} join {nation} on c_nationkey = n_nationkey
        """,
    ),
    "orders": (
        {"orders": "orders"},
        """
        select o_orderkey as order_id,
          o_custkey + case when o_custkey % 50 = 7 then 1 else 0 end as customer_id,
          o_orderdate as order_date,
          case when o_orderkey % 10 = 0 then ' cancelled' when o_orderkey % 10 = 1 then 'returned '
            when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'shipped'
            else 'pending' end as status,
          case o_orderpriority when '1-URGENT' then 'WEB' when '2-HIGH' then 'Mobile'
            when '3-MEDIUM' then 'in-store' when '4-NOT SPECIFIED' then 'phone'
            else ' web ' end as channel,
          cast(cast(case when o_orderkey % 97 = 0 then round(o_totalprice * 100)
            else floor(round(o_totalprice * 100) / 50) end as bigint) * 0.01 as decimal(12,2))
            as total_amount
        from {orders}
        """,
    ),
    "products": (
        {"part": "part"},
        """
        select p_partkey as product_id, p_name || ' ' as product_name, lower(p_type) as category,
          split_part(p_name, ' ', 2) as subcategory, p_brand as brand,
          cast((p_size * 2000 + p_partkey % 100) * 0.01 as decimal(10,2)) as unit_price,
          cast(p_size * 1200 * 0.01 as decimal(10,2)) as cost_price,
          cast(p_partkey * 7 % 500 as bigint) as stock_quantity,
          cast(date '1994-01-01' + cast(p_partkey % 365 as int) as {ts}) as created_at
        from {part}
        """,
    ),
    "order_items": (
        {"lineitem": "lineitem", "part": "part"},
        """
        select l_orderkey * 1000000000 + (l_linenumber * 1000003 + l_partkey * 7919
            + l_suppkey * 104729 + cents * 31) % 1000000000 as order_item_id,
          l_orderkey as order_id, p_partkey as product_id, quantity,
          cast(unit_cents * 0.01 as decimal(10,2)) as unit_price,
          case when l_linenumber = 7 then null else cast(cast(floor(unit_cents * quantity
            * cast(round(l_discount * 100) as int) * 6 / 100) as bigint) * 0.01
            as decimal(10,2)) end as discount,
          cast(unit_cents * quantity * 0.01 as decimal(12,2)) as line_total
        from (
          select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, p_partkey,
            cast(l_quantity as bigint) as quantity,
            cast(round(l_extendedprice * 100) as bigint) as cents,
            cast(p_size * 2000 + p_partkey % 100 as bigint) as unit_cents
          from {lineitem}
          join {part} on p_partkey = l_partkey - case when l_partkey % 40 = 3 then 1 else 0 end
        ) as lines
        """,
    ),
    "payments": (
        {"orders": "b_orders"},
        """
        select order_id * 10 + attempt as payment_id, order_id,
          case (order_id + attempt) % 6 when 1 then ' Credit_Card' when 2 then 'debit_card'
            when 3 then 'paypal' when 4 then 'google_pay' when 5 then 'gift_card'
            else 'bank_transfer' end as payment_method,
          total_amount as amount,
          order_date + interval '1' day * (order_id % 4 + 2 * attempt - 2) as payment_date,
          status
        from (
          select order_id, order_date, total_amount, 1 as attempt,
            case when order_id % 11 = 0 then 'failed' when order_id % 13 = 0 then 'refunded'
              when order_id % 17 = 0 then 'pending' else 'completed' end as status
          from {orders} where status <> 'pending'
          union all
          select order_id, order_date, total_amount, 2 as attempt, 'completed' as status
          from {orders}
          where status <> 'pending' and order_id % 11 = 0
            and lower(trim(channel)) in ('web', 'mobile')
        ) as attempts
        """,
    ),
    "shipments": (
        {"lineitem": "lineitem", "orders": "b_orders"},
        """
        select order_id * 10 + parcel as shipment_id, order_id,
          case order_id % 4 when 0 then 'ups' when 1 then 'FedEx ' when 2 then 'usps'
            else 'dhl' end as carrier,
          'TRK' || cast(order_id * 10 + parcel as string) as tracking_number,
          order_date + interval '1' day * (order_id % 5 + parcel) as ship_date,
          case when order_id % 9 = 0 then null
            else order_date + interval '1' day * (order_id % 5 + parcel + order_id % 11) end
            as delivery_date,
          case when order_id % 9 = 0 then 'in_transit' when order_id % 10 = 1 then 'returned'
            when order_id % 23 = 0 then 'out_for_delivery' else 'delivered' end as status
        from (select distinct l_orderkey, l_suppkey % 2 as parcel from {lineitem}) as parcels
        join {orders} on order_id = l_orderkey
        """,
    ),
}


def sample_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """One Bronze feed over the sample tables in ``sf_dir``."""
    inputs, text = FEEDS[feed]
    frames = {
        alias: sample_feed(spark, sf_dir, source[2:])
        if source.startswith("b_")
        else spark.read.parquet(f"{sf_dir}/{source}.parquet")
        for alias, source in inputs.items()
    }
    return spark.sql(text.replace("{ts}", "timestamp_ntz"), **frames)


def sample_bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six Bronze feeds over the sample tables in ``sf_dir``."""
    return {feed: sample_feed(spark, sf_dir, feed) for feed in FEEDS}
