"""SQL twins of the registered queries, for DuckDB.

Rounded ratios use integer arithmetic so that ties round the same way in
both engines.
"""

from __future__ import annotations

from parity.views import cents, day, half_up, moment, with_views
from tallyhouse.operators.orders import ORDER_TRANSITIONS

AS_OF = "date '2001-08-02'"
EVENTS_AS_OF = "date '2024-01-31'"


def money(value: str) -> str:
    return f"cast(cast({value} as decimal(18,2)) as double)"


def avg_money(value: str, count: str | None = None) -> str:
    return half_up(cents(f"sum({value})"), f"100 * {count or f'count({value})'}", 2)


def n(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def total(value: str, condition: str | None = None) -> str:
    where = f" filter (where {condition})" if condition else ""
    return f"cast(coalesce(sum({value}){where}, 0) as bigint)"


def shift(column: str) -> str:
    return moment(f"{column} + interval 7 hour")


def reasons(*rules: tuple[str, str]) -> str:
    """Comma-joined names of the rules whose condition is definitely false."""
    parts = ", ".join(f"case when not ({holds}) then '{name}' end" for name, holds in rules)
    return f"nullif(concat_ws(',', {parts}), '')"


ITEMS_PER_ORDER = """
    select order_id, sum(quantity) q, sum(coalesce(discount_amount, 0)) d from v_order_items group by order_id"""
STOCK = "select product_id, sum(quantity) total_stock from v_inventory group by product_id"
PRICED = """
    select i.order_id, i.product_id, i.line, i.quantity, coalesce(i.unit_price, p.price) unit_price,
      i.discount_amount
    from v_order_items i left join v_product p on p.id = i.product_id"""
TREE = """
    select id product_id, name product_name, price, brand_name, sub_category_name, category_name from v_product"""
LOG = """
    select inventory_id,
      coalesce(sum(abs(quantity_change)) filter (where change_type = 'sale'), 0) total_sold_qty,
      coalesce(sum(quantity_change) filter (where change_type = 'restock'), 0) total_restock_qty,
      coalesce(sum(quantity_change) filter (where change_type = 'return'), 0) total_return_qty,
      coalesce(sum(quantity_change) filter (where change_type = 'adjustment'), 0) total_adjustment_qty,
      coalesce(sum(abs(quantity_change)) filter (where change_type = 'damage'), 0) total_damage_qty,
      count(*) filter (where change_type = 'sale') sale_event_count,
      count(*) filter (where change_type = 'restock') restock_event_count,
      count(*) filter (where change_type = 'damage') damage_event_count,
      count(*) total_log_events,
      max(cast(created_at as date)) last_day, min(cast(created_at as date)) first_day
    from v_inventory_log group by inventory_id"""
WHERE_STORED = """
    select w.id warehouse_id, w.name warehouse_name, g.province_name
    from v_warehouse w left join v_geo g on g.ward_code = w.geo_location_id"""

DAILY = f"""
    select cast(o.order_date as date) order_date, g.province_name, o.order_channel_id,
      count(*) total_orders, cast(sum(o.total_price) as decimal(18,2)) revenue,
      cast(sum(o.profit) as decimal(18,2)) profit, sum(i.q) items_sold, count(i.q) with_items,
      cast(sum(coalesce(i.d, 0)) as decimal(18,2)) discounts,
      count(*) filter (where status = 'COMPLETED') completed,
      count(*) filter (where status = 'CANCELLED') cancelled,
      count(*) filter (where status = 'RETURNED') returned,
      sum(coalesce(r.n, 0)) returns, cast(sum(coalesce(r.refund, 0)) as decimal(18,2)) refunds
    from v_orders o
    left join ({ITEMS_PER_ORDER}) i on i.order_id = o.id
    left join (select order_id, count(*) n, sum(refund_amount) refund from v_order_return group by order_id) r
      on r.order_id = o.id
    left join v_customers c on c.id = o.customer_id
    left join v_geo g on g.ward_code = c.geo_location_id
    group by 1, 2, 3"""

FIRST_FREE = """
    select o.owner {owner}, count(p.id) - count(h.product_id) open_products,
      min(p.id) filter (where h.product_id is null) first_product_id
    from ({owners}) o
    cross join (select id from v_product where is_active) p
    left join (select distinct {owner}, product_id from {owned}) h
      on h.{owner} = o.owner and h.product_id = p.id
    group by o.owner"""

# Line by line: stock is a list of [quantity, -inventory id, warehouse id], whose largest entry serves the line.
IN_TURN = """
    with recursive stock as (select product_id, list([cast(quantity as bigint), -id, warehouse_id]) held
        from v_inventory group by product_id),
      arrived as (select *, row_number() over (partition by product_id
        order by created_at, order_id, line, warehouse_id, quantity) place from v_order_items),
      served as (
        select product_id, cast(0 as bigint) place, held, cast(null as bigint[]) top, cast(0 as bigint) wanted from stock
        union all
        select product_id, place,
          list_transform(before, lambda s: case when s[2] = best[2] and best[1] >= wanted
            then [s[1] - wanted, s[2], s[3]] else s end),
          case when best[1] >= wanted then best end, wanted
        from (select a.product_id, a.place, s.held before, list_max(s.held) best, cast(a.quantity as bigint) wanted
          from served s join arrived a on a.product_id = s.product_id and a.place = s.place + 1)),
      told as (select a.*, s.top[2:3] served,
          list_sum(list_transform(b.held, lambda x: x[1])) before
        from arrived a left join served s on s.product_id = a.product_id and s.place = a.place
        left join served b on b.product_id = a.product_id and b.place = a.place - 1)"""

# Decisions before the watermark: the newest event less a day.
DUE = f"""
    with cut as (select max(ts) - interval 1 day until from events),
      steps as (select l_orderkey id, l_shipdate t, l_returnflag = 'R' and l_linestatus = 'O' failed from lineitem),
      confirmed as (select id, min(t) c from steps where not failed group by id),
      fails as (select id, t, row_number() over (partition by id order by t) nth from steps where failed),
      touches as (select user_id id, ts t, lead(ts) over (partition by user_id order by ts) following
        from events where ts <= (select until from cut)),
      due as (
        select 'order' kind, o_orderkey id, 'cancelled' decision, o_orderdate + interval 30 day t
        from orders left join confirmed on id = o_orderkey where c is null or c > o_orderdate + interval 30 day
        union all select 'delivery', id, 'returned', t from fails where nth = 3
        union all select 'cart', id, 'expired', t + interval 1 day from touches
        where following is null or following > t + interval 1 day)
    select kind, id, decision, {moment("t")} as "at" from due where t < (select until from cut)"""

STEPS = """
    select *, lag(status) over (partition by order_id order by changed_at, line, product_id) previous_status
    from v_status_history"""

RETURN_REASONS = reasons(
    ("order_missing", "o.status is not null"),
    ("order_not_delivered", "o.status in ('DELIVERED','COMPLETED')"),
    ("refund_above_total", "r.refund_amount <= o.total_price"),
)
JUDGED_RETURNS = f"""
    select r.id, r.order_id, o.status order_status, {money("o.total_price")} order_total,
      {money("r.refund_amount")} refund_amount, {RETURN_REASONS} reject_reason
    from v_order_return r left join v_orders o on o.id = r.order_id"""
ITEMS_TOTAL = """
    select o.id, o.total_price, cast(coalesce(i.s, 0) as decimal(18,2)) items_total
    from v_orders o left join (select order_id, sum(amount) s from v_order_items group by order_id) i
      on i.order_id = o.id"""
CART_TOTALS = """
    select c.id, c.status, coalesce(i.s, 0) total_amount, coalesce(i.n, 0) item_count
    from v_cart c left join (select cart_id, sum(amount) s, count(*) n from v_cart_items where is_active
      group by cart_id) i on i.cart_id = c.id"""
CONVERTIBLE = "select * from v_cart where status = 'active' and item_count > 0 and total_amount > 0"
SPENT = """
    select customer_id id, cast(sum(total_price) as decimal(18,2)) spent, count(*) n
    from v_orders where status = 'COMPLETED'"""
TIER = """case when {0} >= 50000000 then 'Platinum' when {0} >= 20000000 then 'Gold'
    when {0} >= 5000000 then 'Silver' else 'Bronze' end"""


NOT_ASKED = "cast(null as varchar) commonest, cast(null as bigint) commonest_rows"


def _check(table: str, rule: str, sql: str) -> str:
    return f"select '{table}' table_name, '{rule}' \"rule\", checked, failed from ({sql})"


def _unique(table: str, view: str, *columns: str) -> str:
    keys = ", ".join(columns)
    return _check(
        table,
        f"unique({','.join(columns)})",
        f"select {total('m')} checked, {total('m - 1')} failed"
        f" from (select count(*) m from {view} group by {keys})",
    )


def _reference(table: str, view: str, column: str, parent: str, key: str) -> str:
    return _check(
        table,
        f"reference({column})",
        f"select count({column}) checked,"
        f" {n(f'{column} is not null and {column} not in (select {key} from {parent})')} failed from {view}",
    )


def _domain(table: str, view: str, column: str, *allowed: str) -> str:
    names = ",".join(f"'{name}'" for name in allowed)
    return _check(
        table,
        f"domain({column})",
        f"select count({column}) checked, {n(f'{column} not in ({names})')} failed from {view}",
    )


def _least(table: str, view: str, column: str, least: int) -> str:
    return _check(
        table,
        f"at_least({column},{least})",
        f"select count({column}) checked, {n(f'{column} < {least}')} failed from {view}",
    )


BRANDS = "(select distinct brand_id id from v_product)"
SUB_CATEGORIES = """(select distinct sub_category_id id, case category_name when 'SIZED' then 1 else 2 end category_id
    from v_product)"""
CATEGORIES = "(select distinct case category_name when 'SIZED' then 1 else 2 end id from v_product)"

CONSTRAINTS = "\nunion all ".join(
    [
        _unique("orders", "v_orders", "id"),
        _reference("orders", "v_orders", "customer_id", "v_customers", "id"),
        _reference("orders", "v_orders", "payment_id", "v_payment", "id"),
        _reference("orders", "v_orders", "shipping_id", "v_shipment", "id"),
        _reference("orders", "v_orders", "discount_id", "v_discount", "id"),
        _reference("orders", "v_orders", "order_channel_id", "v_method", "id"),
        _reference("order_items", "v_order_items", "order_id", "v_orders", "id"),
        _reference("order_items", "v_order_items", "product_id", "v_product", "id"),
        _unique("order_return", "v_order_return", "id"),
        _reference("order_return", "v_order_return", "order_id", "v_orders", "id"),
        _reference("order_return", "v_order_return", "customer_id", "v_customers", "id"),
        _domain("order_return", "v_order_return", "return_type", "refund", "exchange", "repair"),
        _domain(
            "order_return", "v_order_return", "status", "pending", "approved", "rejected", "processing", "completed"
        ),
        _unique("inventory", "v_inventory", "id"),
        _unique("inventory", "v_inventory", "product_id", "warehouse_id"),
        _reference("inventory", "v_inventory", "product_id", "v_product", "id"),
        _reference("inventory", "v_inventory", "warehouse_id", "v_warehouse", "id"),
        _least("inventory", "v_inventory", "quantity", 0),
        _unique("wishlist", "v_wishlist", "id"),
        _unique("wishlist", "v_wishlist", "customer_id", "product_id"),
        _reference("wishlist", "v_wishlist", "customer_id", "v_customers", "id"),
        _reference("wishlist", "v_wishlist", "product_id", "v_product", "id"),
        _unique("cart_items", "v_cart_items", "cart_id", "product_id"),
        _reference("cart_items", "v_cart_items", "cart_id", "v_cart", "id"),
        _reference("cart_items", "v_cart_items", "product_id", "v_product", "id"),
        _least("cart_items", "v_cart_items", "quantity", 1),
        _unique("customers", "v_customers", "id"),
        _reference("customers", "v_customers", "geo_location_id", "v_geo", "ward_code"),
        _domain("customers", "v_customers", "tier", "Bronze", "Silver", "Gold", "Platinum"),
        _unique("geo_location", "v_geo", "ward_code"),
        _unique("product", "v_product", "id"),
        _reference("product", "v_product", "brand_id", BRANDS, "id"),
        _reference("product", "v_product", "sub_category_id", SUB_CATEGORIES, "id"),
        _unique("brand", BRANDS, "id"),
        _unique("sub_category", SUB_CATEGORIES, "id"),
        _reference("sub_category", SUB_CATEGORIES, "category_id", CATEGORIES, "id"),
        _unique("category", CATEGORIES, "id"),
        _unique("warehouse", "v_warehouse", "id"),
        _reference("warehouse", "v_warehouse", "geo_location_id", "v_geo", "ward_code"),
        _unique("logistics_partner", "v_partner", "id"),
        _unique("order_channel", "v_method", "id"),
        _unique("shipping_method", "v_method", "id"),
        _reference("inventory_log", "v_inventory_log", "inventory_id", "v_inventory", "id"),
        _domain("inventory_log", "v_inventory_log", "change_type", "sale", "restock", "return", "adjustment", "damage"),
        _unique("shipment", "v_shipment", "id"),
        _reference("shipment", "v_shipment", "logistics_partner_id", "v_partner", "id"),
        _unique("customer_activity_log", "v_activity", "id"),
        _reference("customer_activity_log", "v_activity", "customer_id", "v_customers", "id"),
        _reference("customer_activity_log", "v_activity", "product_id", "v_product", "id"),
        _domain(
            "customer_activity_log", "v_activity", "activity_type",
            "view", "search", "add_to_cart", "remove_from_cart", "purchase", "review", "wishlist",
        ),
        _unique("cart", "v_cart", "id"),
        _reference("cart", "v_cart", "customer_id", "v_customers", "id"),
        _domain("cart", "v_cart", "status", "active", "checked_out", "abandoned", "expired"),
        _reference("product_review", "v_review", "product_id", "v_product", "id"),
        _reference("product_review", "v_review", "customer_id", "v_customers", "id"),
        _domain("product_review", "v_review", "rating", "1", "2", "3", "4", "5"),
        _unique("discount", "v_discount", "id"),
        _unique("payment", "v_payment", "id"),
        _reference("order_status_history", "v_status_history", "order_id", "v_orders", "id"),
    ]
)

ALLOWED = ",".join(f"'{was}>{becomes}'".upper() for was, becomes in ORDER_TRANSITIONS)

SQL = {
    "daily_sales": f"""
        select {day("order_date")} order_date, province_name, order_channel_id, total_orders,
          cast(revenue as double) total_revenue, cast(profit as double) total_profit,
          case when with_items > 0 then cast(items_sold as bigint) end total_items_sold,
          {half_up(cents("revenue"), "100 * total_orders", 2)} avg_order_value,
          cast(discounts as double) total_discount_amount, completed completed_orders,
          cancelled cancelled_orders, returned returned_orders, cast(returns as bigint) total_returns_count,
          cast(refunds as double) total_refund_amount,
          {half_up("cancelled", "total_orders", 4)} cancellation_rate
        from ({DAILY})""",
    "daily_sales_by_channel": f"""
        select {day("order_date")} order_date, order_channel_id, cast(sum(total_orders) as bigint) total_orders,
          {money("sum(revenue)")} gmv, {money("sum(profit)")} profit,
          {half_up(cents("sum(revenue)"), "100 * sum(total_orders)", 2)} aov,
          {half_up(cents("sum(profit)"), cents("sum(revenue)"), 4)} profit_margin
        from ({DAILY}) group by order_date, order_channel_id""",
    "customer_analytics": f"""
        select c.id customer_id, c.name customer_name, c.email, c.phone, g.province_name, c.tier, c.loyalty_points,
          {day("o.first_day")} first_order_date, {day("o.last_day")} last_order_date,
          coalesce(o.n, 0) total_orders, {money("coalesce(o.spent, 0)")} total_spent,
          coalesce({half_up(cents("o.spent"), "100 * o.n", 2)}, 0) avg_order_value,
          cast(coalesce(o.items, 0) as bigint) total_items_purchased, coalesce(r.n, 0) total_returns,
          {money("coalesce(r.refund, 0)")} total_refund_amount, coalesce(k.n, 0) total_carts_created,
          coalesce(k.done, 0) total_carts_checked_out, coalesce(a.n, 0) total_activities,
          cast({AS_OF} - o.last_day as int) days_since_last_order
        from v_customers c
        left join (select customer_id, count(*) n, sum(total_price) spent, min(cast(order_date as date)) first_day,
            max(cast(order_date as date)) last_day, sum(i.q) items
          from v_orders left join ({ITEMS_PER_ORDER}) i on i.order_id = id group by customer_id) o
          on o.customer_id = c.id
        left join (select customer_id, count(*) n, sum(refund_amount) refund from v_order_return
          group by customer_id) r on r.customer_id = c.id
        left join (select customer_id, count(*) n, {n("status = 'checked_out'")} done from v_cart
          group by customer_id) k on k.customer_id = c.id
        left join (select customer_id, count(*) n from v_activity group by customer_id) a on a.customer_id = c.id
        left join v_geo g on g.ward_code = c.geo_location_id""",
    "product_performance": f"""
        select p.product_id, p.product_name, p.brand_name, p.category_name, p.sub_category_name,
          cast(coalesce(s.sold, 0) as bigint) total_sold, {money("coalesce(s.revenue, 0)")} total_revenue,
          coalesce(s.price, 0) avg_unit_price, coalesce(v.rating, 0) avg_rating, coalesce(v.n, 0) total_reviews,
          coalesce(t.n, 0) total_return_events, coalesce(w.n, 0) total_wishlist_adds,
          case when s.sold > 0 then cast(coalesce(t.n, 0) as double) / cast(s.sold as double) else 0.0 end return_rate
        from ({TREE}) p
        left join (select product_id, sum(quantity) sold, sum(amount) revenue, {avg_money("unit_price")} price
          from v_order_items group by product_id) s on s.product_id = p.product_id
        left join (select product_id, {half_up("sum(rating)", "count(rating)", 2)} rating, count(*) n
          from v_review group by product_id) v on v.product_id = p.product_id
        left join (select i.product_id, count(*) n from v_order_items i join v_order_return r
          on r.order_id = i.order_id group by i.product_id) t on t.product_id = p.product_id
        left join (select product_id, count(*) n from v_wishlist where is_active group by product_id) w
          on w.product_id = p.product_id""",
    "logistics": f"""
        with sent as (
          select p.name logistics_partner_name, m.name shipping_method_name, g.province_name, p.rating, s.*,
            epoch_us(s.actual_delivery) // 1000000 - epoch_us(s.created_at) // 1000000 as seconds
          from v_orders o left join v_shipment s on s.id = o.shipping_id
          left join v_partner p on p.id = s.logistics_partner_id
          left join v_method m on m.id = s.shipping_method_id
          left join v_customers c on c.id = o.customer_id left join v_geo g on g.ward_code = c.geo_location_id)
        select logistics_partner_name, shipping_method_name, province_name, count(id) total_shipments,
          {money("sum(shipping_cost)")} total_shipping_cost, {avg_money("shipping_cost")} avg_shipping_cost,
          {half_up("sum(rating)", "count(rating)", 2)} partner_rating,
          {half_up(f"100 * {n('is_expedited')}", "count(*)", 2)} expedited_ratio,
          {half_up("sum(seconds)", "3600 * count(seconds)", 2)} avg_delivery_time_hours,
          {half_up(f"100 * {n('actual_delivery <= estimated_delivery')}", "count(actual_delivery)", 2)}
            on_time_delivery_rate,
          {half_up("sum(delivery_attempts)", "count(delivery_attempts)", 1)} avg_delivery_attempts,
          {n("shipping_status = 'Failed'")} failed_delivery_count
        from sent group by logistics_partner_name, shipping_method_name, province_name""",
    "inventory_snapshot": f"""
        select '2001-08-02' snapshot_date, w.warehouse_name, w.province_name, i.product_id, p.product_name, i.quantity,
          i.safety_stock, i.reorder_level, {money("i.quantity * i.unit_cost")} stock_value,
          i.quantity <= i.reorder_level is_low_stock, i.quantity = 0 is_out_of_stock,
          cast(coalesce(l.total_sold_qty, 0) as bigint) total_sales_qty_accumulated,
          cast(coalesce(l.total_restock_qty, 0) as bigint) total_restock_qty_accumulated
        from v_inventory i left join ({LOG}) l on l.inventory_id = i.id
        left join ({TREE}) p on p.product_id = i.product_id
        left join ({WHERE_STORED}) w on w.warehouse_id = i.warehouse_id""",
    "inventory_analysis": f"""
        select inventory_id, product_id, product_name, category_name, sub_category_name,
          cast(price as double) product_price, warehouse_id, warehouse_name, province_name,
          quantity current_quantity, safety_stock, reorder_level, cast(unit_cost as double) unit_cost,
          {money("quantity * unit_cost")} stock_value, quantity <= reorder_level is_low_stock,
          quantity <= safety_stock is_critical_stock, quantity = 0 is_out_of_stock,
          {half_up("quantity - safety_stock", "safety_stock", 2)} stock_buffer_ratio,
          total_sold_qty, total_restock_qty, total_return_qty, total_adjustment_qty, total_damage_qty,
          sale_event_count, restock_event_count, damage_event_count, total_log_events,
          {day("last_day")} last_movement_date, {day("first_day")} first_movement_date,
          cast({AS_OF} - last_day as int) days_since_last_movement,
          quantity > 0 and coalesce({AS_OF} - last_day > 30, true) is_dead_stock,
          case when quantity > 0 then {half_up("total_sold_qty", "quantity", 2)} else 0.0 end turnover_rate,
          case when total_sold_qty + quantity > 0
            then {half_up("100 * total_damage_qty", "(total_sold_qty + quantity)", 2)} else 0.0 end damage_loss_rate,
          case when total_sold_qty > 0 and last_day - first_day > 0
            then {half_up("quantity * (last_day - first_day)", "total_sold_qty", 1)} end days_of_stock_remaining,
          '2001-08-02' snapshot_date
        from (select i.id inventory_id, i.product_id, p.product_name, p.category_name, p.sub_category_name, p.price,
            i.warehouse_id, w.warehouse_name, w.province_name, i.quantity, i.safety_stock, i.reorder_level,
            i.unit_cost, {", ".join(f"cast(coalesce(l.{c}, 0) as bigint) {c}" for c in (
                "total_sold_qty", "total_restock_qty", "total_return_qty", "total_adjustment_qty", "total_damage_qty",
                "sale_event_count", "restock_event_count", "damage_event_count", "total_log_events"))},
            l.last_day, l.first_day
          from v_inventory i left join ({LOG}) l on l.inventory_id = i.id
          left join ({TREE}) p on p.product_id = i.product_id
          left join ({WHERE_STORED}) w on w.warehouse_id = i.warehouse_id)""",
    "cart_analytics": f"""
        select channel, count(*) total_carts, {n("status = 'checked_out'")} checked_out_carts,
          {n("status = 'abandoned'")} abandoned_carts, {n("status = 'expired'")} expired_carts,
          {n("status = 'active'")} active_carts, {money("sum(total_amount)")} total_cart_value,
          {avg_money("total_amount")} avg_cart_value,
          {half_up("sum(item_count)", "count(item_count)", 2)} avg_items_per_cart,
          {half_up("100 * " + n("status = 'abandoned'"), "count(*)", 2)} cart_abandonment_rate,
          {half_up("100 * " + n("status = 'checked_out'"), "count(*)", 2)} cart_conversion_rate
        from v_cart group by channel""",
    "customer_retention": f"""
        with o as (
          select customer_id, count(*) n, sum(total_price) spent, min(cast(order_date as date)) first_day,
            max(cast(order_date as date)) last_day, {n("status = 'COMPLETED'")} completed,
            {n("status = 'CANCELLED'")} cancelled, {n("status = 'RETURNED'")} returned,
            count(distinct cast(order_date as date)) as days
          from v_orders group by customer_id),
        a as (
          select customer_id, count(*) n, {n("activity_type = 'view'")} views,
            {n("activity_type = 'search'")} searches, {n("activity_type = 'add_to_cart'")} adds,
            {n("activity_type = 'purchase'")} purchases, {n("activity_type = 'review'")} reviews,
            {n("activity_type = 'wishlist'")} wishes, count(distinct product_id) products,
            count(distinct channel) channels, max(cast(created_at as date)) last_day
          from v_activity group by customer_id),
        k as (
          select customer_id, count(*) n, {n("status = 'checked_out'")} done, {n("status = 'abandoned'")} lost,
            sum(total_amount) filter (where status = 'abandoned') lost_value
          from v_cart group by customer_id)
        select c.id customer_id, c.name customer_name, c.email, c.tier, c.loyalty_points,
          coalesce(o.n, 0) total_orders, coalesce(completed, 0) completed_orders,
          coalesce(cancelled, 0) cancelled_orders, coalesce(returned, 0) returned_orders,
          coalesce(o.days, 0) distinct_order_dates, coalesce(a.n, 0) total_activities,
          coalesce(views, 0) view_count, coalesce(searches, 0) search_count, coalesce(adds, 0) add_to_cart_count,
          coalesce(purchases, 0) purchase_activity_count, coalesce(reviews, 0) review_count,
          coalesce(wishes, 0) wishlist_activity_count, coalesce(products, 0) distinct_products_interacted,
          coalesce(channels, 0) distinct_channels_used, coalesce(k.n, 0) total_carts,
          coalesce(done, 0) checked_out_carts, coalesce(lost, 0) abandoned_carts,
          {money("coalesce(o.spent, 0)")} total_spent,
          coalesce({half_up(cents("o.spent"), "100 * o.n", 2)}, 0) avg_order_value,
          {money("coalesce(lost_value, 0)")} abandoned_cart_value,
          {day("o.first_day")} first_order_date, {day("o.last_day")} last_order_date,
          {day("a.last_day")} last_activity_date,
          cast({AS_OF} - o.last_day as int) days_since_last_order,
          cast({EVENTS_AS_OF} - a.last_day as int) days_since_last_activity,
          case when o.n is null then 'Never Purchased' when {AS_OF} - o.last_day <= 30 then 'Active'
            when {AS_OF} - o.last_day <= 90 then 'At Risk' when {AS_OF} - o.last_day <= 180 then 'Dormant'
            else 'Churned' end churn_segment,
          coalesce(o.n, 0) > 1 is_repeat_customer,
          case when o.n > 1 then {half_up("o.last_day - o.first_day", "(o.n - 1)", 1)} end avg_days_between_orders,
          coalesce({half_up("100 * lost", "k.n", 2)}, 0) cart_abandonment_rate,
          coalesce(purchases * 5 + adds * 3 + reviews * 3 + wishes * 2 + views + searches, 0) engagement_score
        from v_customers c left join o on o.customer_id = c.id left join a on a.customer_id = c.id
        left join k on k.customer_id = c.id""",
    "return_analysis": f"""
        with lines as (
          select order_id, product_id, sum(quantity) q, sum(amount) amount from v_order_items
          group by order_id, product_id),
        ordered as (select product_id, count(distinct order_id) n from v_order_items group by product_id)
        select l.product_id, any_value(p.product_name) product_name, any_value(p.category_name) category_name,
          any_value(p.sub_category_name) sub_category_name, count(distinct r.id) total_returns,
          count(distinct r.order_id) distinct_orders_returned,
          {n("return_type = 'refund'")} refund_count, {n("return_type = 'exchange'")} exchange_count,
          {n("return_type = 'repair'")} repair_count, {n("status = 'pending'")} status_pending,
          {n("status = 'approved'")} status_approved, {n("status = 'rejected'")} status_rejected,
          {n("status = 'processing'")} status_processing, {n("status = 'completed'")} status_completed,
          {money("sum(coalesce(refund_amount, 0))")} total_refund_amount,
          {avg_money("coalesce(refund_amount, 0)", "count(*)")} avg_refund_amount,
          {half_up("sum(cast(resolved_at as date) - cast(r.created_at as date))", "count(resolved_at)", 1)}
            avg_resolution_days,
          cast(sum(l.q) as bigint) total_quantity_in_returned_orders,
          {money("sum(l.amount)")} total_revenue_in_returned_orders, count(reason) total_reason_entries,
          any_value(ordered.n) total_product_orders,
          {half_up("count(distinct r.order_id)", "any_value(ordered.n)", 4)} return_rate
        from v_order_return r left join lines l on l.order_id = r.order_id
        left join ({TREE}) p on p.product_id = l.product_id left join ordered on ordered.product_id = l.product_id
        group by l.product_id""",
    "top_return_reasons": """
        select reason, count(*) reason_count from v_order_return group by reason order by 2 desc, 1""",
    "kpi_orders": f"""
        select count(*) orders, {money("sum(total_price)")} gmv, {avg_money("total_price")} aov,
          {half_up(cents("sum(profit)"), cents("sum(total_price)"), 4)} profit_margin from v_orders""",
    "conversion_rate": f"""
        select {n("status = 'COMPLETED'")} completed_orders, count(*) orders,
          {half_up(n("status = 'COMPLETED'"), "count(*)", 4)} conversion_rate from v_orders""",
    "return_rate": f"""
        select count(r.order_id) returned_orders, count(*) delivered_orders,
          {half_up("count(r.order_id)", "count(*)", 4)} return_rate
        from v_orders o left join (select distinct order_id from v_order_return) r on r.order_id = o.id
        where o.status in ('DELIVERED','COMPLETED','RETURNED')""",
    "kpi_customer_retention": f"""
        select {n("n > 1")} repeat_customers, count(*) customers, {half_up(n("n > 1"), "count(*)", 4)} customer_retention
        from (select c.id, count(o.id) n from v_customers c left join v_orders o on o.customer_id = c.id group by c.id)""",
    "kpi_inventory_turnover": f"""
        select product_id, {total("sold")} units_sold, {half_up("sum(quantity)", "count(*)", 2)} average_stock,
          {half_up("sum(sold) * count(*)", "sum(quantity)", 4)} inventory_turnover
        from (select i.product_id, i.quantity, coalesce(l.total_sold_qty, 0) sold
          from v_inventory i left join ({LOG}) l on l.inventory_id = i.id) group by product_id""",
    "kpi_shipping_sla": f"""
        select {n("actual_delivery <= estimated_delivery")} on_time, count(actual_delivery) delivered,
          {half_up(n("actual_delivery <= estimated_delivery"), "count(actual_delivery)", 4)} shipping_sla
        from v_shipment""",
    "kpi_carts": f"""
        select count(*) carts, {half_up(n("status = 'abandoned'"), "count(*)", 4)} cart_abandonment,
          {half_up(n("status = 'checked_out'"), "count(*)", 4)} cart_to_order from v_cart""",
    "reassigned_payment_ids": f"""
        select row_number() over (order by id) id, {money("amount")} amount, payment_status,
          {moment("created_at")} created_at from v_payment""",
    "silver_geo": "select ward_code, province_name, region_name from v_geo",
    "silver_order_items": f"""
        select order_id, product_id, warehouse_id, line, quantity, cast(unit_price as double) unit_price,
          cast(gross as double) gross, cast(discount_amount as double) discount_amount,
          cast(amount as double) amount, rf, ls, {moment("created_at")} created_at
        from (select *, row_number() over (partition by order_id, product_id
            order by line, created_at, warehouse_id) place from v_order_items
          where order_id is not null and product_id is not null) where place = 1""",
    "silver_default": f"""
        select id, customer_id, activity_type, product_id, channel, metadata, {shift("created_at")} created_at
        from v_activity""",
    "silver_status_history": f"""
        select order_id, status, {shift("changed_at")} changed_at, line, product_id from v_status_history""",
    "silver_wishlist": f"""
        select id, customer_id, product_id, is_active, {shift("added_at")} added_at from v_wishlist""",
    "silver_cart_items": f"""
        select cart_id, product_id, line, quantity, cast(unit_price as double) unit_price,
          cast(discount_amount as double) discount_amount, cast(amount as double) amount, is_active,
          {shift("added_at")} added_at from v_cart_items""",
    "backfilled_customers": """
        select id, '2023-01-01 00:00:00.000000' created_at from v_customers""",
    "item_amount": f"""
        select order_id, product_id, line, quantity, cast(unit_price as double) unit_price,
          cast(discount_amount as double) discount_amount,
          {money("unit_price * quantity - coalesce(discount_amount, 0)")} amount from ({PRICED})""",
    "order_totals": f"""
        select order_id, cast(t as double) total_price, n item_count,
          cast(cast(t * cast(0.30 as decimal(3,2)) as decimal(18,2)) as double) profit
        from (select order_id, cast(sum(amount) as decimal(18,2)) t, count(*) n from v_order_items group by order_id)""",
    "order_header_rollup": f"""
        select order_id, {money("case when sum(amount) <= 0 then 1 else sum(amount) end")} total_price,
          count(*) item_count from v_order_items group by order_id""",
    "payment_sync": f"""
        select payment_id, {money("p.amount")} old_amount, {money("h.t")} new_amount
        from v_orders o join (select order_id, case when sum(amount) <= 0 then 1 else sum(amount) end t
          from v_order_items group by order_id) h on h.order_id = o.id
        join v_payment p on p.id = o.payment_id where p.amount is distinct from h.t""",
    "order_code": """
        select id, 'ORD_' || strftime(created_at, '%Y%m%d') || '_' || case when place < 100000
          then lpad(cast(place as varchar), 5, '0') else cast(place as varchar) end order_code
        from (select id, created_at, row_number() over (order by id) place from v_orders)""",
    "status_changes": f"""
        select order_id, status, {moment("changed_at")} changed_at, line, product_id, previous_status
        from ({STEPS}) where status is distinct from previous_status""",
    "invalid_transitions": f"""
        select order_id, status, {moment("changed_at")} changed_at, line, product_id, previous_status,
          previous_status = 'DELIVERED' and status = 'CANCELLED' cancelled_after_delivery
        from ({STEPS}) where previous_status is not null and status <> previous_status
          and previous_status || '>' || status not in ({ALLOWED})""",
    "orders_without_items": f"""
        select id, customer_id, {moment("order_date")} order_date from v_orders o where status = 'PENDING'
          and not exists (select 1 from v_order_items i where i.order_id = o.id)""",
    "lifetime_spend": f"""
        select id customer_id, cast(spent as double) total_spent, n completed_orders
        from ({SPENT} group by customer_id)""",
    "overdue_orders": f"""
        select id, customer_id, {moment("created_at")} created_at from v_orders where status = 'PENDING'
          and created_at + interval 30 minute < {AS_OF}""",
    "stock_check": f"""
        select i.order_id, i.product_id, i.line, i.warehouse_id, i.quantity,
          cast(s.total_stock as bigint) total_stock,
          case when p.is_active = false then 'inactive_product'
            when s.total_stock is null or s.total_stock < i.quantity then 'insufficient_stock' end reject_reason
        from v_order_items i left join v_product p on p.id = i.product_id
        left join ({STOCK}) s on s.product_id = i.product_id""",
    "stock_allocation": f"""
        select i.order_id, i.product_id, i.line, i.quantity,
          case when t.quantity >= i.quantity then t.id end inventory_id,
          case when t.quantity >= i.quantity then t.warehouse_id end allocated_warehouse_id,
          case when s.total_stock is null or s.total_stock < i.quantity then 'insufficient_stock'
            when t.quantity < i.quantity then 'no_single_warehouse' end reject_reason
        from v_order_items i left join ({STOCK}) s on s.product_id = i.product_id
        left join (select * from (select *, row_number() over (partition by product_id
          order by quantity desc, id) place from v_inventory) where place = 1) t on t.product_id = i.product_id""",
    "stock_in_turn": f"""
        {IN_TURN} select order_id, product_id, line, warehouse_id, quantity, -served[1] inventory_id,
          served[2] allocated_warehouse_id, case when served is null and (before is null or before < quantity)
            then 'insufficient_stock' when served is null then 'no_single_warehouse' end reject_reason
        from told""",
    "remaining_stock": f"""
        {IN_TURN} select i.id, i.product_id, i.warehouse_id, cast(i.quantity as bigint) opening,
          cast(coalesce(t.taken, 0) as bigint) taken, cast(i.quantity - coalesce(t.taken, 0) as bigint) quantity
        from v_inventory i left join (select -served[1] id, sum(quantity) taken from told where served is not null
          group by 1) t on t.id = i.id""",
    "stock_demand_cover": f"""
        select order_id, product_id, line, warehouse_id, quantity, cast(demand as bigint) running_demand,
          demand <= coalesce(total_stock, 0) covered
        from (select i.*, s.total_stock, sum(i.quantity) over (partition by i.product_id
            order by i.created_at, i.order_id, i.line, i.warehouse_id, i.quantity
            rows between unbounded preceding and current row) demand
          from v_order_items i left join ({STOCK}) s on s.product_id = i.product_id)""",
    "inventory_change_log": f"""
        select inventory_id, quantity_before, quantity_after, quantity_after - quantity_before quantity_change,
          case when quantity_after > quantity_before then 'restock' else 'sale' end change_type
        from (select inventory_id,
            {total("quantity_change", "created_at < timestamp '1998-01-01'")} quantity_before,
            {total("quantity_change", "created_at < timestamp '2001-08-02'")} quantity_after
          from v_inventory_log group by inventory_id) where quantity_after <> quantity_before""",
    "stock_clamp": f"""
        with s as (select *, 20 + sum(quantity_change) over w total from v_inventory_log
          window w as (partition by inventory_id order by created_at, reference_id, line, quantity_change
            rows between unbounded preceding and current row)),
        m as (select *, least(0, min(total) over w) low,
            least(0, coalesce(min(total) over (partition by inventory_id
              order by created_at, reference_id, line, quantity_change
              rows between unbounded preceding and 1 preceding), 0)) low_before
          from s window w as (partition by inventory_id order by created_at, reference_id, line, quantity_change
            rows between unbounded preceding and current row))
        select inventory_id, change_type, quantity_change, reference_id, line, {moment("created_at")} created_at,
          cast(total - quantity_change - low_before as bigint) quantity_before, cast(total - low as bigint) quantity_after,
          cast((total - low) - (total - quantity_change - low_before) as bigint) applied_change
        from m where (total - low) <> (total - quantity_change - low_before)""",
    "inventory_seed": """
        select p.id product_id, coalesce(s.n, 0) stocked_warehouses,
          (select count(*) from v_warehouse) - coalesce(s.n, 0) missing_warehouses,
          cast(cast(p.price * cast(0.70 as decimal(3,2)) as decimal(12,2)) as double) unit_cost
        from v_product p left join (select product_id, count(distinct warehouse_id) n from v_inventory
          where warehouse_id in (select id from v_warehouse) group by product_id) s on s.product_id = p.id""",
    "stocked_warehouses": """
        select id, name from v_warehouse where id in (select warehouse_id from v_inventory)""",
    "customer_tier": f"""
        select id customer_id, cast(spent as double) total_spent, n completed_orders, {TIER.format("spent")} tier,
          cast(case when spent >= 50000000 then points * 3 when spent >= 20000000 then points * 2
            when spent >= 5000000 then (points * 3 + 1) // 2 else points end as int) loyalty_points
        from (select c.id, coalesce(s.spent, 0) spent, coalesce(s.n, 0) n,
            {cents("coalesce(s.spent, 0)")} // 1000000 points
          from v_customers c left join ({SPENT} group by customer_id) s on s.id = c.id)""",
    "customer_code": """
        with coded as (select c.id, c.order_channel_id, 'KH_' || m.channel || '_' || case when place < 1000
            then lpad(cast(place as varchar), 3, '0') else cast(place as varchar) end customer_code
          from (select *, row_number() over (partition by order_channel_id order by id) place from v_customers) c
          left join v_method m on m.id = c.order_channel_id)
        select id, order_channel_id, customer_code, lower(replace(customer_code, '_', '.')) || '@gmail.com' email
        from coded""",
    "customers_without_cart": """
        select id, name from v_customers c where is_active
          and not exists (select 1 from v_cart k where k.customer_id = c.id and k.status = 'active')""",
    "wishlist_candidates": FIRST_FREE.format(
        owner="customer_id", owners="select id owner from v_customers where is_active", owned="v_wishlist"
    ),
    "reactivated_carts": """
        select id, customer_id, status was, 'active' status, 'reactivated' reject_reason from v_cart
        where id % 2 = 0 and status in ('checked_out','expired')""",
    "addable_products": FIRST_FREE.format(
        owner="cart_id", owners="select id owner from v_cart where status = 'active'", owned="v_cart_items"
    ),
    "payment_validation": f"""
        select payment_id, payment_status, cast(amount as double) amount, {moment("changed_at")} changed_at, line,
          product_id, previous_status, {reasons(
              ("refund_not_from_completed", "payment_status <> 'Refunded' or previous_status = 'Completed'"),
              ("amount_not_positive", "amount > 0"))} reject_reason
        from (select *, lag(payment_status) over (partition by payment_id order by changed_at, line, product_id)
          previous_status from v_payment_history)""",
    "payment_effects": """
        select o.payment_id, case when h.done > 0 then 'Completed' else 'Cancelled' end payment_status
        from (select order_id, count(*) filter (where status = 'COMPLETED') done from v_status_history
          where status in ('COMPLETED','CANCELLED') group by order_id) h join v_orders o on o.id = h.order_id""",
    "return_validation": JUDGED_RETURNS,
    "quarantine": f"""
        select id, order_id, refund_amount, reject_reason, '2001-08-02 00:00:00.000000' rejected_at
        from ({JUDGED_RETURNS}) where reject_reason is not null""",
    "returnable_orders": f"""
        select id, customer_id, {money("total_price")} total_price from v_orders o
        where status in ('DELIVERED','COMPLETED')
          and not exists (select 1 from v_order_return r where r.order_id = o.id)""",
    "review_unique": f"""
        select product_id, customer_id, source_system, {moment("created_at")} created_at, order_id, line, rating,
          n - 1 rejected_reviews
        from (select *, row_number() over (partition by product_id, customer_id, source_system
            order by created_at, order_id, line, rating) place,
            count(*) over (partition by product_id, customer_id, source_system) n from v_review) where place = 1""",
    "reviewable_pairs": """
        select distinct o.customer_id, i.product_id from v_orders o join v_order_items i on i.order_id = o.id
        where o.status = 'COMPLETED' and not exists (select 1 from v_review r
          where r.customer_id = o.customer_id and r.product_id = i.product_id)""",
    "shipment_order_sync": """
        select o.id order_id, o.status, s.shipping_status,
          case when o.status in ('CANCELLED','REFUNDED') then o.status
            when s.shipping_status = 'Delivered' then 'DELIVERED'
            when s.shipping_status = 'ReturnToSender' then 'RETURNED'
            when s.shipping_status = 'InTransit' and o.status <> 'DELIVERED' then 'SHIPPED'
            else o.status end synced_status,
          s.delivery_attempts + case when s.shipping_status = 'Failed' then 1 else 0 end delivery_attempts
        from v_orders o join v_shipment s on s.id = o.shipping_id""",
    "shipment_counters": f"""
        select order_id, {moment("shipped")} last_shipped_at, {moment("failed")} last_failed_at,
          {moment("completed")} actual_delivery, attempts delivery_attempts,
          case when completed is not null then 'Delivered'
            when failed is not null and (shipped is null or failed >= shipped) then 'Failed'
            when shipped is not null then 'InTransit' else 'Created' end shipping_status
        from (select order_id, max(changed_at) filter (where status = 'SHIPPED') shipped,
            max(changed_at) filter (where status = 'DELIVERYFAILED') failed,
            max(changed_at) filter (where status = 'COMPLETED') completed,
            {n("status = 'DELIVERYFAILED'")} attempts
          from v_status_history group by order_id)""",
    "expected_delivery": f"""
        select s.id, s.shipping_method_id, {moment("s.created_at")} created_at,
          {moment("s.created_at + to_hours(m.estimated_delivery_time)")} expected_delivery
        from v_shipment s left join v_method m on m.id = s.shipping_method_id""",
    "shipping_terms": f"""
        select o.id order_id, s.is_expedited,
          {money("case when s.is_expedited then greatest(s.shipping_cost, 30000) when o.total_price > 500000 then 0"
                 " else s.shipping_cost end")} fee, s.delivery_attempts >= 3 return_to_sender
        from v_orders o join v_shipment s on s.id = o.shipping_id""",
    "discount_validation": f"""
        select id, discount_type, cast("value" as double) "value", {moment("start_date")} start_date,
          {moment("end_date")} end_date, is_active, {moment("created_at")} created_at,
          {reasons(("start_after_end", "start_date <= end_date"), ("ends_before_creation", "end_date >= created_at"),
                   ("percent_too_high", "discount_type <> '%' or \"value\" <= 70"),
                   ("value_not_positive", '"value" > 0'))} reject_reason
        from v_discount""",
    "discounts_in_force": """
        select o.id order_id, count(d.id) discounts, arg_max(d.id, d."value" * 1000 - d.id) best_discount_id,
          cast(max(d."value") as double) best_value
        from v_orders o left join v_discount d on d.start_date <= o.order_date and o.order_date <= d.end_date
        group by o.id""",
    "discount_timeline": f"""
        select {moment("since")} since, count(d.id) discounts, arg_max(d.id, d."value" * 1000 - d.id) best_discount_id,
          cast(max(d."value") as double) best_value
        from (select start_date since from v_discount union select end_date + interval 1 microsecond from v_discount) m
        left join v_discount d on d.start_date <= since and since <= d.end_date group by since""",
    "discounts_in_force_now": """
        select id, discount_type, cast("value" as double) "value" from v_discount
        where start_date <= timestamp '1996-04-10' and end_date >= timestamp '1996-04-10'""",
    "discount_split": f"""
        select order_id, product_id, line, quantity, cast(unit_price as double) unit_price, discount_type,
          cast(share as double) discount_amount, {money("greatest(unit_price * quantity - share, 0)")} amount
        from (select i.*, d.discount_type, cast(case when d.discount_type = '%'
              then {half_up(f"{cents('unit_price * quantity')} * {cents('d.value')}", "1000000", 2)}
              when d.discount_type = 'fixed' then {half_up(cents("d.value"), "100 * c.n", 2)} else 0 end
              as decimal(18,2)) share
          from ({PRICED}) i join v_orders o on o.id = i.order_id
          join (select order_id, count(*) n from v_order_items group by order_id) c on c.order_id = i.order_id
          left join v_discount d on d.id = o.discount_id)""",
    "cart_item_amount": f"""
        select cart_id, product_id, line, quantity, cast(price as double) unit_price,
          cast(discount_amount as double) discount_amount,
          {money("price * quantity - coalesce(discount_amount, 0)")} amount, is_active, {moment("added_at")} added_at,
          case when sold = false then 'inactive_product' end reject_reason
        from (select c.*, p.is_active sold,
            case when c.unit_price is null or c.unit_price = 0 then p.price else c.unit_price end price
          from v_cart_items c left join v_product p on p.id = c.product_id)""",
    "cart_totals": f"select id, status, {money('total_amount')} total_amount, item_count from ({CART_TOTALS})",
    "checkout_validation": f"""
        select id, status, item_count, short_items, {reasons(
            ("not_active", "status = 'active'"), ("empty_cart", "item_count > 0"),
            ("insufficient_stock", "short_items = 0"))} reject_reason
        from (select c.id, c.status, c.item_count, coalesce(x.n, 0) short_items from ({CART_TOTALS}) c
          left join (select i.cart_id, {n("coalesce(s.total_stock, 0) < i.quantity")} n from v_cart_items i
            join v_product p on p.id = i.product_id left join ({STOCK}) s on s.product_id = i.product_id
            where i.is_active group by i.cart_id) x on x.cart_id = c.id)""",
    "cart_to_order": f"""
        select k.id cart_id, k.customer_id, {money("k.total_amount")} total_price, c.geo_location_id location_id,
          c.order_channel_id, 'PENDING' status
        from ({CONVERTIBLE}) k left join v_customers c on c.id = k.customer_id""",
    "cart_to_order_items": f"""
        select i.cart_id, i.product_id, i.quantity, cast(i.unit_price as double) unit_price,
          cast(i.discount_amount as double) discount_amount, cast(i.amount as double) amount, k.customer_id
        from v_cart_items i join ({CONVERTIBLE}) k on k.id = i.cart_id where i.is_active""",
    "cart_expiry": f"""
        select id, customer_id, {moment("updated_at")} updated_at from v_cart
        where status = 'active' and updated_at < {EVENTS_AS_OF} - interval 7 day""",
    "cart_activity_spans": f"""
        select cart_id, {moment("min(t)")} first_touch, {moment("max(t) + interval 7 day")} expires_at, count(*) touches
        from (select cart_id, t, sum(fresh) over (partition by cart_id order by t rows between unbounded preceding
              and current row) span
          from (select cart_id, added_at t, case when added_at <= lag(added_at) over (partition by cart_id
              order by added_at) + interval 7 day then 0 else 1 end fresh from v_cart_items))
        group by cart_id, span""",
    "activity_payload": """
        select id, activity_type, cast(json_extract(metadata, '$.k') as int) k from v_activity""",
    "packed_payload": """
        select id, activity_type, case activity_type when 'view' then '{"source":"' || channel || '"}'
          when 'add_to_cart' then '{"quantity":' || product_id || '}' else '{}' end metadata
        from v_activity""",
    "activity_daily_window": f"""
        select {moment("date_trunc('day', created_at)")} window_start, activity_type, count(*) activities
        from v_activity group by date_trunc('day', created_at), activity_type""",
    "activity_daily_stream": f"""
        select {moment("date_trunc('day', ts)")} window_start, event_type activity_type, count(*) activities
        from events group by date_trunc('day', ts), event_type
        having date_trunc('day', ts) + interval 1 day <= (select max(ts) from events) - interval 1 day""",
    "cart_session_stream": f"""
        select cart_id, {moment("min(t)")} first_touch, {moment("max(t) + interval 1 day")} expires_at, count(*) touches
        from (select cart_id, t, sum(fresh) over (partition by cart_id order by t rows between unbounded preceding
              and current row) span
          from (select user_id cart_id, ts t, case when ts <= lag(ts) over (partition by user_id
              order by ts) + interval 1 day then 0 else 1 end fresh from events))
        group by cart_id, span
        having max(t) + interval 1 day <= (select max(ts) from events) - interval 1 day""",
    "due_deadlines": DUE,
    "deadline_stream": DUE,
    "ingested_activity": f"""
        select event_id id, event_type activity_type, 1 "version", {day("ts")} created_at_day from events""",
    "stored_profiles": "\nunion all ".join(
        f"""select 'orders' table_name, '{name}' column_name, count(*) "rows", count(*) - count({name}) nulls,
          {lowest} lowest, {highest} highest, count(distinct {name}) >= 0.95 * count({name}) looks_unique,
          {commonest} from v_orders"""
        for name, lowest, highest, commonest in (
            *[(c, f"cast(min({c}) as double)", f"cast(max({c}) as double)", NOT_ASKED) for c in ("id", "customer_id", "total_price")],
            ("order_date", "cast(epoch_us(min(order_date)) as double)", "cast(epoch_us(max(order_date)) as double)", NOT_ASKED),
            ("status", "cast(null as double)", "cast(null as double)",
             "mode(status) commonest, (select count(*) from v_orders where status = (select mode(status) from v_orders)) commonest_rows"),
        )
    ),
    "stored_checks": """
        with days as (select strftime(created_at, '%Y-%m-%d') ds, * from v_activity where created_at < timestamp '2024-01-31'),
          own as (select * from days where ds = '2024-01-20'),
          usual as (select avg(n) n from (select ds, count(*) n from days
            where ds < '2024-01-20' group by ds order by ds desc limit 7)),
          told as (
            select 'not_null(id)' "rule", count(id) passed, count(*) - count(id) failed from own
            union all select 'unique(id)', cast(count(distinct id) >= 0.95 * count(id) as bigint),
              cast(count(distinct id) < 0.95 * count(id) as bigint) from own
            union all select 'fresh(created_at)', cast(max(created_at) >= timestamp '2024-01-18' as bigint),
              cast(max(created_at) < timestamp '2024-01-18' as bigint) from own
            union all select 'row_count', cast(20 * abs(count(*) - any_value(n)) < any_value(n) as bigint),
              cast(20 * abs(count(*) - any_value(n)) >= any_value(n) as bigint) from own, usual)
        select 'customer_activity_log' table_name, "rule", '2024-01-20' ds, passed, failed from told""",
    "constraint_check": CONSTRAINTS,
    "dq_not_null_unique": f"""
        select 'order_items' table_name, 'not_null(order_id)' "rule", '2001-08-02' ds, count(order_id) passed,
          count(*) - count(order_id) failed from v_order_items
        union all select 'order_items', 'not_null(product_id)', '2001-08-02', count(product_id),
          count(*) - count(product_id) from v_order_items
        union all select 'order_items', 'unique(order_id,product_id)', '2001-08-02', {total("m", "m = 1")},
          {total("m", "m > 1")} from (select count(*) m from v_order_items group by order_id, product_id)""",
    "dq_freshness": f"""
        select 'orders' table_name, 'fresh(created_at)' "rule", '2001-08-02' ds,
          {n(f"created_at >= {AS_OF} - interval 48 hour")} passed,
          {n(f"created_at < {AS_OF} - interval 48 hour")} failed from v_orders""",
    "dq_row_count": """
        select 'order_items' table_name, '2001-08-02' ds, a source_rows, b target_rows,
          20 * abs(a - b) < a within_tolerance
        from (select (select count(*) from v_order_items) a,
          (select count(*) from (select distinct order_id, product_id from v_order_items)) b)""",
    "dq_ref_integrity": f"""
        select 'cart_items' table_name, 'reference(cart_id)' "rule", '2024-01-31' ds,
          {n("k.id is not null")} passed, {n("k.id is null")} failed
        from v_cart_items i left join v_cart k on k.id = i.cart_id""",
    "dq_order_total": f"""
        select id, {money("total_price")} total_price, {money("items_total")} items_total, {reasons(
            ("total_negative", "total_price >= 0"), ("total_differs_from_items", "total_price = items_total"))}
          reject_reason from ({ITEMS_TOTAL})""",
    "dq_pass_rate": f"""
        select 'orders' table_name, 'total_negative' "rule", '2001-08-02' ds, {n("total_price >= 0")} passed,
          {n("total_price < 0")} failed from ({ITEMS_TOTAL})
        union all select 'orders', 'total_differs_from_items', '2001-08-02', {n("total_price = items_total")},
          {n("total_price <> items_total")} from ({ITEMS_TOTAL})""",
    "dq_missing_payment": f"""
        select id, status, {money("total_price")} total_price from v_orders o
        where status in ('DELIVERED','COMPLETED') and not exists (select 1 from v_payment p where p.id = o.payment_id)""",
    "dq_discount_range": f"""
        select 'discount' table_name, 'percent_0_100' "rule", '2001-08-02' ds,
          {n("discount_type <> '%' or \"value\" between 0 and 100")} passed,
          {n("discount_type = '%' and \"value\" not between 0 and 100")} failed from v_discount""",
    "scd2_customers": f"""
        with old as (select id, {TIER.format("spent")} tier from ({SPENT} and order_date < timestamp '1998-01-01'
            group by customer_id)),
        new as (select id, {TIER.format("spent")} tier from ({SPENT} and order_date < timestamp '2001-08-02'
            group by customer_id)
          where id in (select customer_id from v_orders where status = 'COMPLETED'
            and order_date >= timestamp '1999-06-01'))
        select old.id, old.tier, '1998-01-01' valid_from,
          case when new.tier is distinct from old.tier then '2001-08-02' end valid_to,
          new.tier is not distinct from old.tier is_current
        from old left join new on new.id = old.id
        union all
        select new.id, new.tier, '2001-08-02', null, true from new left join old on old.id = new.id
        where new.tier is distinct from old.tier""",
    "retention_filter": f"""
        select id, {moment("created_at")} created_at from v_orders where created_at >= {AS_OF} - interval 365 day""",
}


def _orders(where: str) -> str:
    return f"""
        select id, customer_id, payment_id, shipping_id, discount_id, order_channel_id,
          {moment("order_date")} order_date, {moment("created_at")} created_at, {moment("updated_at")} updated_at,
          status, cast(total_price as double) total_price, cast(profit as double) profit
        from v_orders where {where}"""


SQL["incremental_orders"] = _orders("cast(created_at as date) = date '1998-01-05'")
SQL["incremental_changed_orders"] = _orders(
    "cast(coalesce(updated_at, created_at) as date) = date '1998-01-05'"
)
SQL["incremental_by_day"] = f"""
    select id, customer_id, activity_type, product_id, channel, metadata, {moment("created_at")} created_at
    from v_activity where cast(created_at as date) = date '2024-01-15'"""
SQL["silver_orders"] = f"""
    select id, customer_id, payment_id, shipping_id, discount_id, order_channel_id,
      {shift("order_date")} order_date, {shift("created_at")} created_at, {shift("updated_at")} updated_at,
      status, cast(total_price as double) total_price, cast(profit as double) profit
    from v_orders where total_price >= 0"""
# The driver's tables hold the raw status text; the last step of each order by time.
SQL["latest_by_key"] = f"""
    select order_id, case rf || ls when 'NO' then ' Shipped ' when 'NF' then 'Delivering' when 'AO' then 'delivered '
        when 'AF' then 'Completed' when 'RO' then 'DeliveryFailed' when 'RF' then 'Cancelled' else 'Pending' end status,
      {moment("changed_at")} changed_at, line, product_id
    from (select *, row_number() over (partition by order_id
        order by changed_at desc, line desc, product_id desc) place
      from (select id order_id, null rf, null ls, order_date changed_at, 0 line, -1 product_id from v_orders
        union all select order_id, rf, ls, created_at, line, product_id from v_order_items)) where place = 1"""


def oracle() -> dict[str, str]:
    return {name: with_views(text) for name, text in SQL.items()}
