"""The derived retail tables of ``tallyhouse.adapters`` as SQL."""

from __future__ import annotations

import re


def cents(money: str) -> str:
    return f"cast(cast({money} as decimal(18,2)) * 100 as hugeint)"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Integer ratio rounded half-up to ``digits``; NULL when dividing by 0."""
    n, d, scale = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)", 10**digits
    rounded = f"(2 * abs({n}) * {scale} + {d}) // (2 * {d})"
    return (
        f"(case when {d} = 0 then null else "
        f"sign({n}) * cast({rounded} as double) / {scale}.0 end)"
    )


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def day(column: str) -> str:
    return f"strftime(cast({column} as date), '%Y-%m-%d')"


def channel(number: str) -> str:
    return f"(['Shopee','Lazada','Tiki','Website'])[cast({number} % 4 as int) + 1]"


OPENED = "timestamp '1995-01-01 00:00:00'"
UNIT_PRICE = (
    f"cast((2 * {cents('l_extendedprice')} + cast(l_quantity as hugeint)) // (2 * cast(l_quantity as hugeint))"
    " as decimal(18,0)) * cast(0.01 as decimal(3,2))"
)

VIEWS = {
    "v_geo": """
        select cast(n_nationkey as bigint) ward_code, n_name province_name, r_name region_name
        from nation join region on n_regionkey = r_regionkey""",
    "v_customers": f"""
        select c_custkey id, c_name name, 'c' || c_custkey || '@shop.example' email,
          '09' || lpad(cast(c_custkey as varchar), 8, '0') phone,
          cast(c_nationkey as bigint) geo_location_id, c_custkey % 5 + 1 order_channel_id,
          c_mktsegment segment,
          case when c_acctbal < 2500 then 'Bronze' when c_acctbal < 5000 then 'Silver'
               when c_acctbal < 7500 then 'Gold' else 'Platinum' end tier,
          cast({cents("abs(c_acctbal)")} // 1000 as int) loyalty_points,
          c_acctbal >= 0 is_active, {OPENED} created_at
        from customer""",
    "v_orders": """
        select o_orderkey id, o_custkey customer_id, o_orderkey payment_id, o_orderkey shipping_id,
          case when o_orderkey % 3 = 0 then o_custkey % 25 end discount_id,
          cast(substr(o_orderpriority, 1, 1) as bigint) order_channel_id,
          o_orderdate order_date, o_orderdate created_at,
          case when o_orderstatus = 'F' then o_orderdate + interval 3 day end updated_at,
          case when o_orderstatus = 'F' then case when o_orderkey % 10 = 0 then 'RETURNED' else 'COMPLETED' end
               when o_orderstatus = 'O' then case when o_orderkey % 10 = 0 then 'CANCELLED' else 'DELIVERED' end
               else 'PENDING' end status,
          cast(o_totalprice as decimal(18,2)) total_price,
          cast(cast(o_totalprice as decimal(18,2)) * cast(0.30 as decimal(3,2)) as decimal(18,2)) profit
        from orders""",
    "v_order_items": f"""
        select l_orderkey order_id, l_partkey product_id, l_suppkey warehouse_id, l_linenumber line,
          cast(l_quantity as int) quantity,
          case when l_linenumber <> 7 then cast({UNIT_PRICE} as decimal(12,2)) end unit_price,
          cast(l_extendedprice as decimal(18,2)) gross,
          cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as decimal(18,2))
            discount_amount,
          cast(cast(l_extendedprice as decimal(18,2))
            - cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as decimal(18,2))
            as decimal(18,2)) amount,
          l_returnflag rf, l_linestatus ls, l_shipdate created_at
        from lineitem""",
    "v_product": """
        select p_partkey id, p_name name, cast(regexp_extract(p_brand, '(\\d+)$', 1) as bigint) brand_id,
          cast(list_position(['STANDARD','SMALL','MEDIUM','LARGE','ECONOMY','PROMO'], p_type) as bigint)
            sub_category_id,
          p_brand brand_name, p_type sub_category_name,
          case when p_type in ('SMALL','MEDIUM','LARGE') then 'SIZED' else 'GRADED' end category_name,
          cast(p_retailprice as decimal(12,2)) price, p_size > 2 is_active
        from part""",
    "v_warehouse": """
        select s_suppkey id, s_name name, cast(s_nationkey as bigint) geo_location_id from supplier""",
    "v_partner": """
        select s_suppkey id, s_name name, cast(s_suppkey % 5 + 1 as int) rating from supplier""",
    "v_method": """
        select distinct cast(substr(o_orderpriority, 1, 1) as bigint) id, o_orderpriority name,
          cast(substr(o_orderpriority, 1, 1) as int) * 24 estimated_delivery_time, substr(o_orderpriority, 3) channel
        from orders""",
    "v_inventory": """
        select l_partkey * 100000 + l_suppkey id, l_partkey product_id, l_suppkey warehouse_id,
          cast(sum(cast(l_quantity as bigint)) % 101 as int) quantity, 10 safety_stock, 20 reorder_level,
          cast(any_value(price) * cast(0.70 as decimal(3,2)) as decimal(12,2)) unit_cost
        from lineitem left join v_product p on p.id = l_partkey
        group by l_partkey, l_suppkey""",
    "v_inventory_log": """
        select inventory_id, change_type,
          case when change_type in ('damage','sale') then -amount else amount end quantity_change,
          reference_id, line, created_at
        from (select l_partkey * 100000 + l_suppkey inventory_id,
            case when l_linenumber = 7 then 'damage' when l_linenumber = 6 then 'adjustment'
                 when l_returnflag = 'N' then 'sale' when l_returnflag = 'A' then 'restock' else 'return' end
              change_type,
            cast(l_quantity as int) amount, l_orderkey reference_id, l_linenumber line, l_shipdate created_at
          from lineitem)""",
    "v_order_return": """
        select i.order_id id, i.order_id, any_value(o_custkey) customer_id, 'reason_' || i.order_id % 7 reason,
          (['refund','exchange','repair'])[cast(i.order_id % 3 as int) + 1] return_type,
          (['pending','approved','rejected','processing','completed'])[cast(i.order_id % 5 as int) + 1] status,
          cast(sum(i.amount) as decimal(18,2)) refund_amount, max(i.created_at) created_at,
          case when i.order_id % 2 = 0 then max(i.created_at) + interval 5 day end resolved_at
        from v_order_items i join orders on o_orderkey = i.order_id
        where rf = 'R' group by i.order_id""",
    "v_shipment": """
        select o_orderkey id, any_value(s.partner) logistics_partner_id,
          cast(substr(any_value(o_orderpriority), 1, 1) as bigint) shipping_method_id,
          substr(any_value(o_orderpriority), 1, 1) in ('1','2') is_expedited,
          any_value(s.cost) shipping_cost,
          case when coalesce(any_value(s.n), 0) = 0 then 'Created' when any_value(s.n) % 5 = 0 then 'Failed'
               when any_value(s.n) % 5 = 1 then 'InTransit' when any_value(s.n) % 7 = 0 then 'ReturnToSender'
               else 'Delivered' end shipping_status,
          any_value(o_orderdate) created_at, any_value(o_orderdate) + interval 60 day estimated_delivery,
          any_value(s.actual) actual_delivery, cast(coalesce(any_value(s.n), 0) % 3 as int) delivery_attempts
        from orders left join (
          select l_orderkey, min(l_suppkey) partner, max(l_shipdate) actual, count(*) n,
            cast(sum(cast(l_tax as decimal(4,2))) * 100 as decimal(12,2)) cost
          from lineitem group by l_orderkey) s on s.l_orderkey = o_orderkey
        group by o_orderkey""",
    "v_activity": f"""
        select event_id id, user_id customer_id,
          case event_type when 'click' then 'add_to_cart' when 'signup' then 'search'
            when 'error' then 'remove_from_cart' else event_type end activity_type,
          event_id % 200 product_id, {channel("event_id")} channel, props metadata, ts created_at
        from events""",
    "v_cart": f"""
        select event_id id, user_id customer_id, {channel("event_id")} channel,
          (['active','checked_out','abandoned','expired'])[cast((event_id + user_id) % 4 as int) + 1] status,
          cast(value as decimal(12,2)) total_amount, cast(1 + event_id % 5 as int) item_count,
          ts created_at, ts updated_at, ts + interval 7 day expires_at
        from events where event_type = 'click'""",
    "v_cart_items": """
        select order_id cart_id, product_id, line, quantity,
          case when line = 6 then 0 else unit_price end unit_price, discount_amount, amount,
          rf <> 'R' is_active, created_at added_at
        from v_order_items""",
    "v_review": """
        select product_id, o_custkey customer_id, cast(1 + line % 5 as int) rating,
          case when ls = 'O' then 'Shopee' else 'Website' end source_system, order_id, line, created_at
        from v_order_items join orders on o_orderkey = order_id where rf = 'A'""",
    "v_wishlist": """
        select event_id id, user_id customer_id, event_id % 200 product_id, event_id % 3 <> 0 is_active, ts added_at
        from events where event_type in ('view','click')""",
    "v_discount": f"""
        select cast(k as bigint) id, case when k % 2 = 0 then '%' else 'fixed' end discount_type,
          cast(k * 4 as decimal(12,2)) "value", s start_date, s + to_days(k + 30) end_date, true is_active,
          s + to_days(k % 5 * 10) created_at
        from (select n_nationkey k, {OPENED} + to_days(n_nationkey * 90) s from nation)""",
    "v_payment": """
        select order_id id, cast(sum(gross) as decimal(18,2)) amount,
          max(case when rf = 'A' then 'Completed' else 'Pending' end) payment_status, min(created_at) created_at
        from v_order_items group by order_id""",
    "v_status_history": """
        select id order_id, 'PENDING' status, order_date changed_at, 0 line, -1 product_id from v_orders
        union all
        select order_id, case rf || ls when 'NO' then 'SHIPPED' when 'NF' then 'DELIVERING'
            when 'AO' then 'DELIVERED' when 'AF' then 'COMPLETED' when 'RO' then 'DELIVERYFAILED'
            else 'CANCELLED' end, created_at, line, product_id
        from v_order_items""",
    "v_payment_history": """
        select order_id payment_id,
          case rf when 'R' then 'Refunded' when 'A' then 'Completed' else 'Pending' end payment_status,
          cast(gross - 2000 as decimal(18,2)) amount, created_at changed_at, line, product_id
        from v_order_items""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it uses, directly or through other views."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_[a-z_]+\b", text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in ordered)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
