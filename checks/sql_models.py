"""Oracle texts of the feeds, the Silver models and the Gold models.

Plain SQL for an independent engine.  A text refers to other texts by name;
``with_ctes`` puts the ones it needs in front of it.
"""

from __future__ import annotations

import re

from lodestrata.sources.sample import AS_OF, FEEDS

TODAY = f"date '{AS_OF.isoformat()}'"


def mean(expr: str) -> str:
    return f"cast(sum({expr}) as double) / count({expr})"


def half_up(expr: str, digits: int) -> str:
    scale = f"{10 ** digits}.0::double"
    return f"sign({expr}) * floor(abs({expr}) * {scale} + 0.5::double) / {scale}"


def exact_pct(part: str, whole: str) -> str:
    """Percent with two decimals from the cents of both sides, in integers."""
    a = f"cast({part} * 100 as hugeint)"
    b = f"cast({whole} * 100 as hugeint)"
    eight = f"((2 * abs({a}) * 100000000 + {b}) // (2 * {b}))"
    two = f"(({eight} + 5000) // 10000)"
    return f"cast(sign({a}) * {two} * 0.01 as decimal(18,2))"


def days(start: str, end: str) -> str:
    return f"cast(date_diff('day', cast({start} as date), cast({end} as date)) as integer)"


CTES: dict[str, str] = {
    f"b_{feed}": text.format(ts="timestamp", **inputs) for feed, (inputs, text) in FEEDS.items()
}

# ------------------------------------------------------------------- Silver

CTES["s_customers"] = f"""
select customer_id, trim(first_name) as first_name, trim(last_name) as last_name,
  trim(first_name) || ' ' || trim(last_name) as full_name,
  lower(trim(email)) as email, split_part(lower(trim(email)), '@', 2) as email_domain,
  trim(phone) as phone, trim(city) as city, upper(trim(state)) as state,
  trim(zip_code) as zip_code, upper(trim(segment)) as segment, created_at,
  {days('created_at', TODAY)} as customer_tenure_days,
  coalesce({days('created_at', TODAY)} <= 365, false) as is_active
from b_customers where customer_id is not null and email is not null
"""

CTES["s_orders"] = f"""
select order_id, customer_id, order_date, upper(trim(status)) as status,
  lower(trim(channel)) as channel, total_amount,
  {days('order_date', TODAY)} as days_since_order,
  total_amount > 5000 as is_high_value,
  substr(dayname(order_date), 1, 3) as order_day_of_week,
  dayofweek(order_date) in (0, 6) as is_weekend_order
from b_orders where order_id is not null and customer_id is not null and total_amount >= 0
"""

CTES["s_order_items"] = f"""
select order_item_id, order_id, product_id, quantity, unit_price, discount,
  gross - discount as line_total,
  case when gross > 0 then {exact_pct('discount', 'gross')}
    else cast(0 as decimal(18,2)) end as discount_pct,
  discount > 0 as is_discounted,
  gross - discount - quantity * unit_cost as item_margin
from (
  select i.order_item_id, i.order_id, i.product_id, i.quantity, i.unit_price,
    coalesce(i.discount, 0::decimal(10,2)) as discount, i.quantity * i.unit_price as gross,
    coalesce(p.cost_price, 0::decimal(10,2)) as unit_cost
  from b_order_items as i left join b_products as p on p.product_id = i.product_id
  where i.order_item_id is not null and i.order_id is not null and i.quantity > 0
    and i.unit_price >= 0
) as lines
"""

CTES["s_products"] = f"""
select product_id, trim(product_name) as product_name, upper(trim(category)) as category,
  upper(trim(subcategory)) as subcategory, trim(brand) as brand, unit_price, cost_price,
  stock_quantity, unit_price - cost_price as profit_margin,
  {exact_pct('(unit_price - cost_price)', 'unit_price')} as margin_pct,
  case when unit_price >= 800 then 'LUXURY' when unit_price >= 500 then 'PREMIUM'
    when unit_price >= 200 then 'MID_RANGE' else 'BUDGET' end as price_tier,
  coalesce(stock_quantity < 100, false) as is_low_stock, created_at
from b_products where product_id is not null and unit_price > 0 and cost_price >= 0
"""

CTES["s_payments"] = f"""
select p.payment_id, p.order_id, lower(trim(p.payment_method)) as payment_method,
  case lower(trim(p.payment_method)) when 'credit_card' then 'CARD' when 'debit_card' then 'CARD'
    when 'paypal' then 'DIGITAL' when 'google_pay' then 'DIGITAL'
    when 'gift_card' then 'GIFT_CARD' else 'OTHER' end as payment_method_group,
  p.amount, p.payment_date, upper(trim(p.status)) as status,
  coalesce(upper(trim(p.status)) = 'COMPLETED', false) as is_successful,
  {days('o.order_date', 'p.payment_date')} as days_to_payment
from b_payments as p left join b_orders as o on o.order_id = p.order_id
where p.payment_id is not null and p.order_id is not null and p.amount >= 0
"""

CTES["s_shipments"] = f"""
select shipment_id, order_id, upper(trim(carrier)) as carrier,
  trim(tracking_number) as tracking_number, ship_date, delivery_date,
  upper(trim(status)) as status, took as delivery_days,
  coalesce(took > 7, false) as is_delayed,
  coalesce(upper(trim(status)) = 'DELIVERED', false) as is_delivered,
  case when took is null then 'PENDING' when took > 7 then 'SLOW' when took > 3 then 'STANDARD'
    when took > 1 then 'FAST' else 'SAME_DAY' end as shipping_speed
from (select *, {days('ship_date', 'delivery_date')} as took from b_shipments) as s
where shipment_id is not null and order_id is not null and ship_date is not null
"""

# --------------------------------------------------------------------- Gold

CTES["g_customer_orders"] = f"""
select customer_id, count(distinct order_id) as total_orders,
  sum(total_amount) as lifetime_spend, {mean('total_amount')} as avg_order_value,
  min(order_date) as first_order_date, max(order_date) as last_order_date,
  {days('max(order_date)', TODAY)} as days_since_last_order,
  count(distinct order_id) filter (where status = 'COMPLETED') as completed_orders,
  count(distinct order_id) filter (where status = 'CANCELLED') as cancelled_orders,
  count(distinct order_id) filter (where status = 'RETURNED') as returned_orders,
  count(*) filter (where is_high_value) as high_value_order_count,
  count(*) filter (where is_weekend_order) as weekend_order_count
from s_orders group by customer_id
"""

CTES["g_customer_payments"] = """
select o.customer_id, count(distinct p.payment_id) as total_payments,
  coalesce(sum(p.amount) filter (where p.status = 'COMPLETED'), 0) as total_paid,
  coalesce(sum(p.amount) filter (where p.status = 'REFUNDED'), 0) as total_refunded
from s_payments as p join s_orders as o using (order_id) group by o.customer_id
"""

CTES["g_preferred_channel"] = """
select customer_id, channel as preferred_channel from (
  select customer_id, channel,
    row_number() over (partition by customer_id order by count(*) desc, channel) as place
  from s_orders group by customer_id, channel
) as ranked where place = 1
"""

CTES["dim_customers"] = f"""
select c.customer_id, first_name, last_name, full_name, email, email_domain, city, state,
  zip_code, segment, created_at as customer_since, customer_tenure_days, is_active,
  coalesce(o.total_orders, 0) as total_orders, coalesce(o.lifetime_spend, 0) as lifetime_spend,
  coalesce(o.avg_order_value, 0) as avg_order_value, o.first_order_date, o.last_order_date,
  o.days_since_last_order, coalesce(o.completed_orders, 0) as completed_orders,
  coalesce(o.cancelled_orders, 0) as cancelled_orders,
  coalesce(o.returned_orders, 0) as returned_orders,
  coalesce(o.high_value_order_count, 0) as high_value_order_count,
  coalesce(o.weekend_order_count, 0) as weekend_order_count,
  case when o.total_orders > 0
    then {half_up('(o.cancelled_orders::double / o.total_orders::double * 100.0::double)', 2)}
    else 0 end as cancellation_rate,
  case when o.total_orders > 1 and {days('o.first_order_date', 'o.last_order_date')} > 0
    then {half_up('(' + days('o.first_order_date', 'o.last_order_date')
                  + '::double / (o.total_orders - 1)::double)', 1)} end
    as avg_days_between_orders,
  case when customer_tenure_days > 0
    then {half_up('(coalesce(o.total_orders, 0)::double '
                  '/ (customer_tenure_days::double / 30.0::double))', 2)}
    else 0 end as orders_per_month,
  ch.preferred_channel, coalesce(p.total_paid, 0) as total_paid,
  coalesce(p.total_refunded, 0) as total_refunded,
  coalesce(p.total_paid, 0) - coalesce(p.total_refunded, 0) as net_paid,
  case when o.total_orders >= 10 and o.lifetime_spend >= 50000 then 'PLATINUM'
    when o.total_orders >= 5 and o.lifetime_spend >= 20000 then 'GOLD'
    when o.total_orders >= 2 and o.lifetime_spend >= 5000 then 'SILVER'
    else 'BRONZE' end as loyalty_tier
from s_customers as c
left join g_customer_orders as o on o.customer_id = c.customer_id
left join g_customer_payments as p on p.customer_id = c.customer_id
left join g_preferred_channel as ch on ch.customer_id = c.customer_id
"""

CTES["g_product_sales"] = f"""
select i.product_id, count(distinct i.order_id) as orders_with_product,
  cast(sum(i.quantity) as bigint) as total_units_sold, sum(i.line_total) as total_revenue,
  sum(i.item_margin) as total_margin, {mean('i.unit_price')} as avg_selling_price,
  {mean('i.discount')} as avg_discount,
  cast(coalesce(sum(i.quantity) filter (where i.is_discounted), 0) as bigint) as discounted_units,
  {mean('i.discount_pct')} as avg_discount_pct,
  {half_up('(sum(i.quantity)::double / count(distinct i.order_id)::double)', 2)}
    as avg_units_per_order,
  min(o.order_date) as first_sold_date, max(o.order_date) as last_sold_date,
  {days('min(o.order_date)', 'max(o.order_date)')} as selling_span_days
from s_order_items as i join s_orders as o on o.order_id = i.order_id group by i.product_id
"""

CTES["g_return_exposure"] = """
select i.product_id, sum(i.line_total) as returned_revenue
from s_order_items as i join s_orders as o on o.order_id = i.order_id
where o.status = 'RETURNED' group by i.product_id
"""

CTES["dim_products"] = f"""
select p.product_id, product_name, category, subcategory, brand, unit_price, cost_price,
  profit_margin, margin_pct, price_tier, stock_quantity, is_low_stock,
  coalesce(total_units_sold, 0) as total_units_sold, coalesce(total_revenue, 0) as total_revenue,
  coalesce(total_margin, 0) as total_margin,
  coalesce(orders_with_product, 0) as orders_with_product,
  coalesce(avg_selling_price, 0) as avg_selling_price, coalesce(avg_discount, 0) as avg_discount,
  coalesce(avg_discount_pct, 0) as avg_discount_pct,
  coalesce(discounted_units, 0) as discounted_units,
  coalesce(avg_units_per_order, 0) as avg_units_per_order, first_sold_date, last_sold_date,
  coalesce(selling_span_days, 0) as selling_span_days,
  coalesce(returned_revenue, 0) as returned_revenue,
  case when total_units_sold > 0 and stock_quantity > 0
    then {half_up('(total_units_sold::double / stock_quantity::double)', 2)} else 0 end
    as inventory_turnover,
  case when total_units_sold > 0 and selling_span_days > 0
    then {half_up('(stock_quantity::double '
                  '/ (total_units_sold::double / selling_span_days::double))', 0)} end
    as days_of_stock_remaining,
  case when total_revenue > 50000 then 'TOP_SELLER' when total_revenue > 10000 then 'STRONG'
    when total_revenue > 0 then 'ACTIVE' else 'NO_SALES' end as sales_tier,
  created_at
from s_products as p
left join g_product_sales as s on s.product_id = p.product_id
left join g_return_exposure as r on r.product_id = p.product_id
"""

CTES["g_spine"] = """
select cast(unnest(generate_series(cast(min(order_date) as date), cast(max(order_date) as date),
  interval 1 day)) as date) as date_key
from s_orders
"""

CTES["dim_dates"] = """
select date_key, date_key as full_date, cast(dayofweek(date_key) as integer) as day_of_week,
  substr(dayname(date_key), 1, 3) as day_name, dayofweek(date_key) in (0, 6) as is_weekend,
  cast(day(date_key) as integer) as day_of_month,
  cast(weekofyear(date_key) as integer) as week_of_year,
  cast(month(date_key) as integer) as month_num, substr(monthname(date_key), 1, 3) as month_name,
  cast(quarter(date_key) as integer) as quarter_num, 'Q' || quarter(date_key) as quarter_name,
  cast(year(date_key) as integer) as year_num,
  case quarter(date_key) when 1 then 'FQ4' when 2 then 'FQ1' when 3 then 'FQ2' else 'FQ3' end
    as fiscal_quarter,
  cast(date_trunc('month', date_key) as date) as first_day_of_month,
  cast(last_day(date_key) as date) as last_day_of_month
from g_spine
"""

CTES["g_order_items"] = f"""
select order_id, count(*) as line_item_count, cast(sum(quantity) as bigint) as total_units,
  sum(line_total) as items_total, sum(discount) as total_discount,
  sum(item_margin) as total_item_margin, count(distinct product_id) as unique_products,
  {mean('discount_pct')} as avg_discount_pct,
  count(*) filter (where is_discounted) as discounted_line_items
from s_order_items group by order_id
"""

CTES["g_payments"] = """
select order_id, count(*) as payment_count,
  coalesce(sum(amount) filter (where status = 'COMPLETED'), 0) as amount_paid,
  coalesce(sum(amount) filter (where status = 'REFUNDED'), 0) as amount_refunded,
  coalesce(sum(amount) filter (where status = 'FAILED'), 0) as amount_failed,
  coalesce(string_agg(distinct payment_method, ', ' order by payment_method), '')
    as payment_methods,
  coalesce(string_agg(distinct payment_method_group, ', ' order by payment_method_group), '')
    as payment_method_groups
from s_payments group by order_id
"""

CTES["g_shipments"] = f"""
select order_id, min(ship_date) as first_ship_date, max(delivery_date) as last_delivery_date,
  max(status) as shipment_status, {mean('delivery_days')} as avg_delivery_days,
  bool_or(is_delayed) as has_delayed_shipment, max(shipping_speed) as slowest_shipping_speed
from s_shipments group by order_id
"""

CTES["g_order_counts"] = """
select customer_id, count(distinct order_id) as customer_total_orders,
  count(distinct order_id) > 1 as is_repeat_customer
from s_orders group by customer_id
"""

CTES["fact_sales"] = f"""
select o.order_id, o.customer_id, c.full_name as customer_name, c.segment as customer_segment,
  c.state as customer_state, c.is_active as is_active_customer, o.order_date,
  o.status as order_status, o.channel, o.total_amount as order_total, o.is_high_value,
  o.is_weekend_order, o.order_day_of_week,
  coalesce(line_item_count, 0) as line_item_count, coalesce(total_units, 0) as total_units,
  coalesce(items_total, 0) as items_total, coalesce(total_discount, 0) as total_discount,
  coalesce(total_item_margin, 0) as total_item_margin,
  coalesce(unique_products, 0) as unique_products,
  coalesce(avg_discount_pct, 0) as avg_discount_pct,
  coalesce(discounted_line_items, 0) as discounted_line_items,
  coalesce(payment_count, 0) as payment_count, coalesce(amount_paid, 0) as amount_paid,
  coalesce(amount_refunded, 0) as amount_refunded, coalesce(amount_failed, 0) as amount_failed,
  payment_methods, payment_method_groups,
  coalesce(amount_paid, 0) - coalesce(amount_refunded, 0) as net_revenue,
  coalesce(amount_paid, 0) > coalesce(amount_refunded, 0) as is_profitable,
  first_ship_date, last_delivery_date, shipment_status, avg_delivery_days,
  coalesce(has_delayed_shipment, false) as has_delayed_shipment, slowest_shipping_speed,
  {days('o.order_date', 'first_ship_date')} as days_to_ship,
  {days('o.order_date', 'last_delivery_date')} as days_to_deliver,
  coalesce(n.is_repeat_customer, false) as is_repeat_customer,
  cast(date_trunc('month', o.order_date) as date) as order_month,
  cast(date_trunc('quarter', o.order_date) as date) as order_quarter,
  cast(year(o.order_date) as integer) as order_year
from s_orders as o
left join s_customers as c on c.customer_id = o.customer_id
left join g_order_items as i on i.order_id = o.order_id
left join g_payments as p on p.order_id = o.order_id
left join g_shipments as s on s.order_id = o.order_id
left join g_order_counts as n on n.customer_id = o.customer_id
"""

CTES["fact_shipment_performance"] = f"""
select s.shipment_id, s.order_id, o.customer_id, c.segment as customer_segment,
  c.state as customer_state, o.channel as order_channel, o.total_amount as order_value,
  o.is_high_value as is_high_value_order, o.order_date, s.ship_date, s.delivery_date, s.carrier,
  s.status as shipment_status, s.tracking_number, s.delivery_days, s.is_delayed, s.is_delivered,
  s.shipping_speed, {days('o.order_date', 's.ship_date')} as days_order_to_ship,
  {days('o.order_date', 's.delivery_date')} as days_order_to_delivery,
  cast(date_trunc('month', s.ship_date) as date) as ship_month,
  cast(year(s.ship_date) as integer) as ship_year
from s_shipments as s
join s_orders as o on o.order_id = s.order_id
left join s_customers as c on c.customer_id = o.customer_id
"""

CTES["g_attempts"] = f"""
select order_id, count(*) as attempts, count(*) filter (where status = 'COMPLETED') as completed,
  count(*) filter (where status = 'FAILED') as failed,
  count(*) filter (where status = 'REFUNDED') as refunded,
  count(*) filter (where status = 'PENDING') as pending,
  sum(amount) as attempted,
  sum(amount) filter (where status = 'COMPLETED') as paid,
  sum(amount) filter (where status = 'FAILED') as lost,
  sum(amount) filter (where status = 'REFUNDED') as returned,
  {half_up("(count(*) filter (where status = 'COMPLETED')::double / count(*)::double"
           " * 100.0::double)", 2)} as success,
  coalesce(string_agg(distinct payment_method, ', ' order by payment_method), '') as methods,
  coalesce(string_agg(distinct payment_method_group, ', ' order by payment_method_group), '')
    as groups_used,
  min(payment_date) as first_payment_date, max(payment_date) as last_payment_date
from s_payments group by order_id
"""

CTES["fact_payment_summary"] = """
select o.order_id, customer_id, order_date, o.status as order_status, channel,
  total_amount as order_total, coalesce(attempts, 0) as total_payment_attempts,
  coalesce(completed, 0) as completed_payments, coalesce(failed, 0) as failed_payments,
  coalesce(refunded, 0) as refunded_payments, coalesce(pending, 0) as pending_payments,
  coalesce(attempted, 0) as total_amount_attempted, coalesce(paid, 0) as total_amount_completed,
  coalesce(lost, 0) as total_amount_failed, coalesce(returned, 0) as total_amount_refunded,
  coalesce(success, 0) as payment_success_rate, methods as payment_methods_used,
  groups_used as payment_groups_used, first_payment_date, last_payment_date,
  case when failed > 0 then case when completed > 0 then 'RECOVERED' else 'ALL_FAILED' end
    when refunded > 0 then 'REFUNDED' when completed > 0 then 'CLEAN'
    else 'NO_PAYMENT' end as payment_outcome
from s_orders as o left join g_attempts as a on a.order_id = o.order_id
"""

CTES["g_daily_orders"] = f"""
select cast(order_date as date) as revenue_date, count(distinct order_id) as total_orders,
  count(distinct customer_id) as unique_customers, sum(total_amount) as gross_revenue,
  {mean('total_amount')} as avg_order_value, min(total_amount) as min_order_value,
  max(total_amount) as max_order_value, count(*) filter (where is_high_value) as high_value_orders,
  count(*) filter (where is_weekend_order) as weekend_orders,
  coalesce(sum(total_amount) filter (where status = 'COMPLETED'), 0) as completed_revenue,
  coalesce(sum(total_amount) filter (where status = 'CANCELLED'), 0) as cancelled_revenue,
  coalesce(sum(total_amount) filter (where status = 'RETURNED'), 0) as returned_revenue,
  count(distinct order_id) filter (where channel = 'web') as web_orders,
  count(distinct order_id) filter (where channel = 'mobile') as mobile_orders,
  count(distinct order_id) filter (where channel = 'in-store') as instore_orders,
  count(distinct order_id) filter (where channel = 'phone') as phone_orders
from s_orders group by 1
"""

CTES["g_daily_items"] = """
select cast(o.order_date as date) as revenue_date,
  cast(sum(i.quantity) as bigint) as total_units_sold, sum(i.discount) as total_discount,
  sum(i.line_total) as total_line_revenue, sum(i.item_margin) as total_item_margin,
  count(distinct i.product_id) as unique_products_sold
from s_order_items as i join s_orders as o on o.order_id = i.order_id group by 1
"""

CTES["fact_daily_revenue"] = """
select o.revenue_date, total_orders, unique_customers, gross_revenue, avg_order_value,
  min_order_value, max_order_value, high_value_orders, weekend_orders, completed_revenue,
  cancelled_revenue, returned_revenue,
  gross_revenue - cancelled_revenue - returned_revenue as net_revenue, web_orders,
  mobile_orders, instore_orders, phone_orders,
  coalesce(total_units_sold, 0) as total_units_sold, coalesce(total_discount, 0) as total_discount,
  coalesce(total_line_revenue, 0) as total_line_revenue,
  coalesce(total_item_margin, 0) as total_item_margin,
  coalesce(unique_products_sold, 0) as unique_products_sold
from g_daily_orders as o left join g_daily_items as i on i.revenue_date = o.revenue_date
order by o.revenue_date
"""


def with_ctes(text: str, ctes: dict[str, str] | None = None) -> str:
    """``text`` preceded by every named text it uses, directly or not."""
    ctes = CTES if ctes is None else ctes
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"[a-z_][a-z0-9_]*", sql):
            if word in ctes and word not in ordered and ctes[word] is not sql:
                visit(ctes[word])
                if word not in ordered:
                    ordered.append(word)

    visit(text)
    parts = [f"{name} as ({ctes[name].strip()})" for name in ordered]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + text.strip()
