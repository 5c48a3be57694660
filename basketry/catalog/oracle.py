"""The registered queries as DuckDB SQL over the sample tables, written from the definitions.

Facts are grouped over the joined lines here and pre-summed per order in Spark, so the two check each other.
"""

from __future__ import annotations

from basketry.plans.staging import UNKNOWN_EMAIL
from basketry.sources.sample_tables import COLUMNS, raw_sql


def half_up(numerator: str, denominator: str, shift: int) -> str:
    """Whole-number quotient of `numerator * 10**shift`, rounded half away from zero."""
    up, down = 10 ** max(shift, 0), 10 ** max(-shift, 0)
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    size = f"((2*abs({n})*{up} + abs({d})*{down}) // (2*abs({d})*{down}))"
    return f"case when {d} <> 0 then (case when ({n} < 0) <> ({d} < 0) then -{size} else {size} end) end"


def mean(total: str, count: str, scale: int, digits: int) -> str:
    """Exact mean of values given as a sum of units of 10**-scale."""
    return f"cast({half_up(total, count, digits - scale)} as double) / 1e{digits}"


def ratio(part: str, whole: str, factor: str = "1e0") -> str:
    return f"cast({part} as double) * {factor} / nullif(cast({whole} as double), 0)"


def tier(price: str) -> str:
    return (
        f"case when {price} < 20 then 'budget' when {price} < 100 then 'mid' "
        f"when {price} < 300 then 'premium' else 'luxury' end"
    )


SEGMENT = (
    "case when rfm_score >= 10 then 'Champions' when rfm_score >= 7 then 'Loyal' "
    "when rfm_score >= 5 then 'At Risk' else 'Lost' end"
)
CENTS = "cast({} * 100 as hugeint)"


def cents(column: str) -> str:
    return CENTS.format(column)


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


def dbl(expression: str) -> str:
    return f"cast({expression} as double)"


def _fact_measures(margin_units: str, places: int) -> str:
    return f"""
    {dbl('sum(i.line_total)')} as order_total,
    count(i.item_id) as num_items,
    {mean('sum(' + cents('i.discount') + ')', 'count(i.discount)', 2, 4)} as avg_discount,
    {mean(f'sum({margin_units})', f'count({margin_units})', places, 4)} as avg_margin"""


def _scored(recency: str) -> str:
    return f"""
    select *, {SEGMENT} as rfm_segment from (
      select *, r_score + f_score + m_score as rfm_score from (
        select *, cast({recency} as integer) as r_score,
          cast(ntile(4) over (order by frequency nulls last, customer_id nulls last) as integer) as f_score,
          cast(ntile(4) over (order by monetary nulls last, customer_id nulls last) as integer) as m_score
        from rfm_base))"""


# Centres that customers are assigned to, with their numbers.
_CENTRES = "(0, -0.71e0, 0.83e0, 0.91e0), (1, 0.13e0, 0.07e0, -0.11e0), (2, 1.53e0, -1.09e0, -0.97e0), (3, -0.59e0, -0.67e0, -0.53e0)"
CTES: dict[str, str] = {name: raw_sql(name) for name in COLUMNS}
CTES |= {
    "dim_customers": f"""
      select customer_id, concat_ws(' ', first_name, last_name) as full_name, first_name, last_name,
        coalesce(email, '{UNKNOWN_EMAIL}') as email, city, state, country, segment,
        cast(signup_date as date) as signup_date, coalesce(cast(age as integer), 0) as age
      from (select *, row_number() over (partition by customer_id order by signup_date desc nulls last,
              age nulls last, city nulls last, country nulls last, email nulls last, first_name nulls last,
              last_name nulls last, segment nulls last, state nulls last) as rn from raw_customers)
      where rn = 1 and customer_id is not null""",
    "dim_products": f"""
      select product_id, product_name, category, price, cost,
        {half_up(cents('(price - cost)'), cents('price'), 4)} as margin_units,
        {tier('price')} as price_tier, stock_qty, cast(is_active as boolean) as is_active
      from raw_products where product_id is not null""",
    "stg_orders": """
      select order_id, customer_id, order_date, status, order_total,
        coalesce(shipping_city, 'Unknown') as shipping_city, coalesce(shipping_state, 'Unknown') as shipping_state,
        cast(year(order_date) as integer) as order_year, cast(month(order_date) as integer) as order_month,
        cast(dayofweek(order_date) as integer) as order_dow
      from raw_orders where order_id is not null""",
    "fct_orders": f"""
      select o.order_id, o.customer_id, o.order_date, o.order_year, o.order_month, o.order_dow + 1 as order_dow,
        o.status, o.shipping_city, o.shipping_state, sum(i.line_total) as exact_total,
        {_fact_measures('p.margin_units', 4)},
        coalesce(string_agg(distinct p.category, ',' order by p.category), '') as categories_purchased
      from stg_orders o left join raw_order_items i on o.order_id = i.order_id
        left join dim_products p on i.product_id = p.product_id
      group by 1,2,3,4,5,6,7,8,9""",
    "rfm_base": """
      select customer_id,
        cast(date_diff('day', max(order_date), (select max(order_date) from raw_orders)) as integer) as recency_days,
        count(order_id) as frequency, sum(order_total) as monetary,
        min(order_date) as first_order_date, max(order_date) as last_order_date
      from raw_orders where status = 'completed' group by customer_id""",
    "rfm_scored": _scored("ntile(4) over (order by recency_days desc nulls last, customer_id nulls last)"),
    "rfm_scored_asc": _scored("5 - ntile(4) over (order by recency_days nulls last, customer_id nulls last)"),
    "metrics": "select * from dim_customers left join rfm_scored using (customer_id)",
    "lines": """
      select i.*, p.product_name, p.category, p.price from raw_order_items i
        join raw_products p on i.product_id = p.product_id
        join raw_orders o on i.order_id = o.order_id
      where o.status = 'completed'""",
    "features": """
      select customer_id, rfm_segment, coalesce(recency_days, 0) as recency_days, coalesce(frequency, 0) as frequency,
        coalesce(monetary, 0) as monetary, coalesce(r_score, 0) as r_score, coalesce(f_score, 0) as f_score,
        coalesce(m_score, 0) as m_score, cast(recency_days >= 180 as integer) as churned
      from metrics where rfm_segment is not null""",
    "stand_in": """
      select *, cast(churn_probability > 0.5e0 as integer) as prediction from (
        select *, cast(customer_id * 37 % 101 as double) / 1e2 as churn_probability,
          cast(customer_id % 4 as integer) as cluster from features)""",
    "judged": """
      select s.*, case when churn_probability > 0 and churn_probability <= 0.3e0 then 'Low'
          when churn_probability > 0.3e0 and churn_probability <= 0.6e0 then 'Medium'
          when churn_probability > 0.6e0 and churn_probability <= 1 then 'High' end as churn_risk,
        ['Champions', 'Loyal', 'At Risk', 'Dormant'][place] as ml_segment
      from stand_in s join (
        select cluster, row_number() over (order by sum(monetary) / count(monetary) desc nulls last, cluster) as place
        from stand_in group by cluster) using (cluster)""",
    "scaled": f"""
      select customer_id, (v1 - avg(v1) over ()) / stddev_pop(v1) over () as z1,
        (v2 - avg(v2) over ()) / stddev_pop(v2) over () as z2, (v3 - avg(v3) over ()) / stddev_pop(v3) over () as z3
      from (select customer_id, {dbl('recency_days')} as v1, {dbl('frequency')} as v2, {dbl('monetary')} as v3
        from metrics where rfm_segment is not null)""",
    "nearest": f"""
      select customer_id, z1, z2, z3, arg_min(c, d) as cluster, min(d) as d from (
        select customer_id, z1, z2, z3, c, (z1 - a1) * (z1 - a1) + (z2 - a2) * (z2 - a2) + (z3 - a3) * (z3 - a3) as d
        from scaled, (values {_CENTRES}) as centres(c, a1, a2, a3)) group by all""",
    "series": """
      select *, cast(month(period) as integer) as month_num,
        sin(2e0 * pi() * month(period) / 12e0) as sin_month, cos(2e0 * pi() * month(period) / 12e0) as cos_month
      from (select period, order_total, cast(row_number() over (order by period) - 1 as integer) as period_idx
        from (select cast(date_trunc('month', order_date) as date) as period, sum(exact_total) as order_total
          from fct_orders where status = 'completed' and order_date is not null group by 1))""",
    "train": """
      select *, row_number() over (order by period desc) <= 3 as is_test, cast(order_total as double) as y,
        cast(period_idx as double) as x1 from series""",
    # Least squares by orthogonalising the three features one after the other.
    "fit1": """
      select regr_slope(y, x1) as by1, regr_intercept(y, x1) as ay1,
        regr_slope(sin_month, x1) as b2, regr_intercept(sin_month, x1) as a2,
        regr_slope(cos_month, x1) as b3, regr_intercept(cos_month, x1) as a3
      from train where not is_test""",
    "step1": """
      select train.*, sin_month - a2 - b2 * x1 as z2, cos_month - a3 - b3 * x1 as w3 from train, fit1""",
    "fit2": "select regr_slope(y, z2) as c2, regr_slope(w3, z2) as s32 from step1 where not is_test",
    "step2": "select step1.*, w3 - s32 * z2 as z3 from step1, fit2",
    "fit3": "select regr_slope(y, z3) as c3 from step2 where not is_test",
    "fitted": """
      select period, order_total, is_test, y, ay1 + by1 * x1 + c2 * z2 + c3 * z3 as prediction
      from step2, fit1, fit2, fit3""",
    "ahead0": """
      select cast(p + to_months(cast(k as integer)) as date) as period, cast(i + k as integer) as period_idx, t
      from (select max(period) as p, max(period_idx) as i, cast(max_by(order_total, period) as double) as t
        from series), (select unnest([1, 2, 3]) as k)""",
    "ahead1": """
      select *, sin(2e0 * pi() * month(period) / 12e0) as s, cos(2e0 * pi() * month(period) / 12e0) as c from ahead0""",
    "ahead2": """
      select period, period_idx, t, s - a2 - b2 * period_idx as z2, c - a3 - b3 * period_idx as w3 from ahead1, fit1""",
    "ahead": """
      select period, period_idx, t, ay1 + by1 * period_idx + c2 * z2 + c3 * (w3 - s32 * z2) as forecast
      from ahead2, fit1, fit2, fit3""",
}

# Which earlier queries each one reads.
NEEDS: dict[str, tuple[str, ...]] = {
    "dim_customers": ("raw_customers",),
    "dim_products": ("raw_products",),
    "stg_orders": ("raw_orders",),
    "fct_orders": ("stg_orders", "raw_order_items", "dim_products"),
    "rfm_base": ("raw_orders",),
    "rfm_scored": ("rfm_base",),
    "rfm_scored_asc": ("rfm_base",),
    "metrics": ("dim_customers", "rfm_scored"),
    "lines": ("raw_order_items", "raw_products", "raw_orders"),
    "features": ("metrics",),
    "stand_in": ("features",),
    "judged": ("stand_in",),
    "scaled": ("metrics",),
    "nearest": ("scaled",),
    "series": ("fct_orders",),
    "train": ("series",),
    "fit1": ("train",),
    "step1": ("fit1",),
    "fit2": ("step1",),
    "step2": ("fit2",),
    "fit3": ("step2",),
    "fitted": ("fit3",),
    "ahead0": ("series",),
    "ahead1": ("ahead0",),
    "ahead2": ("ahead1", "fit1"),
    "ahead": ("ahead2", "fit3"),
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, ()):
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "with " + ", ".join(f"{n} as ({CTES[n]})" for n in order) + " "


def _counts(source: str, column: str, count: str) -> str:
    return f"""select {column}, count(*) as {count}, {ratio('count(*)', 'sum(count(*)) over ()')} as share
      from {source} where {column} is not null group by {column}"""


PRODUCT_COLUMNS = (
    f"product_id, product_name, category, {dbl('price')} as price, {dbl('cost')} as cost, "
    f"{dbl('margin_units')} / 1e4 as margin, price_tier, stock_qty, is_active"
)
RFM_COLUMNS = (
    f"recency_days, frequency, {dbl('monetary')} as monetary, first_order_date, last_order_date, "
    "r_score, f_score, m_score, rfm_score, rfm_segment"
)
CUSTOMER_COLUMNS = (
    "customer_id, full_name, first_name, last_name, email, city, state, country, segment, signup_date, age"
)
QUARTILES = "[0, 0.25, 0.5, 0.75, 1]"


def _overview(where: str) -> str:
    done = "count(*) filter (status = 'completed')"
    return f"""
      select *, case when cancel_percent > 15 then 'High' when cancel_percent > 8 then 'Watch' else 'Healthy' end
        as cancel_status from (
      select {dbl("sum(exact_total) filter (status = 'completed')")} as total_revenue,
        {done} as completed_orders, {ratio(done, 'count(*)', '100e0')} as completed_percent,
        {ratio("sum(exact_total) filter (status = 'completed')", "count(exact_total) filter (status = 'completed')")}
          as avg_order_value,
        count(distinct customer_id) filter (status = 'completed') as unique_customers,
        {ratio("count(*) filter (status = 'cancelled')", 'count(*)', '100e0')} as cancel_percent
      from fct_orders where {where})"""


def _gate(name: str, relation: str, bound: int, metric: str, table: str) -> str:
    op = "=" if relation == "==" else relation
    return f"""select '{name}' as check_name, '{relation}' as relation, cast({bound} as bigint) as bound,
      {metric} as observed, {metric} {op} {bound} as passed from {table}"""


def _test(model: str, column: str, kind: str, failures: str) -> str:
    return f"""select '{model}' as model, '{column}' as column_name, '{kind}' as test, failures,
      failures = 0 as passed from ({failures})"""


def _duplicates(table: str, column: str) -> str:
    return f"""select count(*) as failures from (select {column} from {table} where {column} is not null
      group by 1 having count(*) > 1)"""


def _check(name: str, value: str, table: str) -> str:
    return f"select '{name}' as check_name, cast(null as varchar) as detail, {dbl(value)} as value from {table}"


MODEL_TABLES = {
    "stg_customers": ("dim_customers", "customer_id"),
    "stg_orders": ("stg_orders", "order_id"),
    "stg_products": ("dim_products", "product_id"),
    "stg_order_items": ("raw_order_items", "item_id"),
}

_SPREAD = f"""
  select rfm_segment, customers, round(q[1], 4) as minimum, round(q[2], 4) as q1, round(q[3], 4) as median,
    round(q[4], 4) as q3, round(q[5], 4) as maximum
  from (select rfm_segment, count(*) as customers, quantile_cont({dbl('monetary')}, {QUARTILES}) as q
    from metrics where rfm_segment is not null group by 1)"""

_CHURN_SPREAD = _SPREAD.replace(dbl("monetary"), "churn_probability").replace("metrics where", "judged where").replace(", 4)", ", 9)")

_SPLIT = """
  select customer_id, churned, rn <= (2 * n + 5) // 10 as is_test from (
    select customer_id, churned, count(*) over (partition by churned) as n,
      row_number() over (partition by churned order by md5(concat(customer_id, ':42'))) as rn from features)"""

_ROC = f"""
  select {ratio('fp', 'n')} as fpr, {ratio('tp', 'p')} as tpr, threshold from (
    select threshold, sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp,
      sum(pos) over () as p, sum(neg) over () as n
    from (select churn_probability as threshold, sum(churned) as pos, sum(1 - churned) as neg
      from stand_in group by 1))
  union all select 0e0, 0e0, null"""

_CLASSES = """
  classes as (
    select c.class, coalesce(tp / nullif(pred, 0)::double, 0) as precision, coalesce(tp / nullif(act, 0)::double, 0)
      as recall, coalesce(2 * tp / nullif(pred + act, 0)::double, 0) as f1, act as support, tp
    from (select k as class, count(*) filter (prediction = k) as pred, count(*) filter (churned = k) as act,
        count(*) filter (churned = k and prediction = k) as tp
      from stand_in, (select unnest([0, 1]) as k) group by 1) c)"""

_REPORT = f"""
  select case class when 0 then 'Active' else 'Churned' end as class, round(precision, 9) as precision,
    round(recall, 9) as recall, round(f1, 9) as f1, support from classes
  union all select 'accuracy', null, null, round({ratio('sum(tp)', 'sum(support)')}, 9), {big('sum(support)')}
    from classes
  union all select 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
    {big('sum(support)')} from classes
  union all select 'weighted avg', round({ratio('sum(precision * support)', 'sum(support)')}, 9),
    round({ratio('sum(recall * support)', 'sum(support)')}, 9), round({ratio('sum(f1 * support)', 'sum(support)')}, 9),
    {big('sum(support)')} from classes"""

_MART = (
    _with("stg_orders", "dim_customers", "raw_order_items", "dim_products")
    + f"""select o.order_id, o.customer_id, c.full_name as customer_name, c.segment as customer_segment, o.order_date,
      o.order_year, o.order_month, o.status, o.shipping_city, o.shipping_state,
      {_fact_measures('p.margin_units', 4)}
      from stg_orders o left join dim_customers c on o.customer_id = c.customer_id
      left join raw_order_items i on o.order_id = i.order_id left join dim_products p on i.product_id = p.product_id
      group by 1,2,3,4,5,6,7,8,9,10"""
)

_MONEY_MEAN = mean("sum({})".format(cents("monetary")), "count(monetary)", 2, 1)

ORACLE: dict[str, str] = {
    "raw_customers": _with("raw_customers") + "select * from raw_customers",
    "dim_customers": _with("dim_customers") + f"select {CUSTOMER_COLUMNS} from dim_customers",
    "dim_customers_strict_name": _with("dim_customers")
    + "select customer_id, first_name || ' ' || last_name as full_name from dim_customers",
    "dedup_counts": _with("raw_customers", "dim_customers")
    + """select 'raw' as stage, count(*) as rows from raw_customers
      union all select 'latest_per_key', count(*) from dim_customers
      union all select 'any_per_key', count(*) from (select distinct customer_id from raw_customers)""",
    "dim_products": _with("dim_products") + f"select {PRODUCT_COLUMNS} from dim_products",
    "stg_orders": _with("stg_orders") + f"select * replace ({dbl('order_total')} as order_total) from stg_orders",
    "stg_order_items": _with("raw_order_items")
    + f"""select item_id, order_id, product_id, quantity, {dbl('unit_price')} as unit_price,
      {dbl('discount')} as discount, {dbl('line_total')} as line_total,
      {dbl('round(unit_price - unit_price * discount, 2)')} as net_price
      from raw_order_items where item_id is not null""",
    "line_total_check": _with("raw_order_items")
    + """select count(*) as lines, count(*) filter (line_total is distinct from
      cast(round(unit_price * (1 - discount), 2) as decimal(18,2))) as differing from raw_order_items""",
    "fct_events": _with("raw_events")
    + """select event_id, coalesce(cast(customer_id as varchar), 'ANONYMOUS') as customer_id, session_id, event_type,
      coalesce(cast(product_id as varchar), 'NONE') as product_id, event_ts, device, os,
      cast(event_ts as date) as event_date, cast(hour(event_ts) as integer) as event_hour,
      customer_id is null as is_anonymous from raw_events""",
    "weekday_forms": _with("stg_orders")
    + """select order_id, order_dow + 1 as dow_sunday1, order_dow as dow_sunday0,
      cast(isodow(order_date) - 1 as integer) as dow_monday0 from stg_orders""",
    "fct_orders": _with("fct_orders") + "select * exclude (exact_total) from fct_orders",
    "fct_orders_maintained": _with("fct_orders") + "select * exclude (exact_total) from fct_orders",
    "fct_orders_versions": _with("fct_orders") + "select * exclude (exact_total) from fct_orders",
    "overview_kpis_pruned": _with("fct_orders") + _overview("order_year in (1996, 1998)"),
    "product_revenue_spread": _with("raw_order_items", "raw_products")
    + f"""select i.product_id, category, count(*) as lines, {dbl('sum(line_total)')} as revenue
      from raw_order_items i left join raw_products p on i.product_id = p.product_id group by 1, 2""",
    "customer_orders_spread": _with("stg_orders", "dim_customers")
    + """select order_id, o.customer_id, status, full_name, segment
      from stg_orders o left join dim_customers c on o.customer_id = c.customer_id""",
    "customers_by_month": _with("fct_orders")
    + """select order_year, order_month, count(distinct customer_id) as unique_customers
      from fct_orders where status = 'completed' group by all""",
    "customers_by_year": _with("fct_orders")
    + "select order_year, count(distinct customer_id) as unique_customers from fct_orders where status = 'completed' group by all",
    "customers_in_years": _with("fct_orders")
    + """select count(distinct customer_id) as unique_customers
      from fct_orders where status = 'completed' and order_year in (1996, 1998)""",
    "fct_orders_raw_margin": _with("stg_orders", "raw_order_items", "raw_products")
    + f"""select o.order_id, {mean('sum(p.u)', 'count(p.u)', 12, 4)} as avg_margin
      from stg_orders o left join raw_order_items i on o.order_id = i.order_id
      left join (select product_id, {half_up(cents('(price - cost)'), cents('price'), 12)} as u from raw_products) p
        on i.product_id = p.product_id
      group by o.order_id, o.customer_id, o.order_date, o.status, o.shipping_city, o.shipping_state""",
    "mart_orders": _MART,
    "mart_orders_any_copies": _MART,
    "revenue_reconciliation": _with("raw_orders", "raw_order_items")
    + f"""select status, count(*) as orders, {dbl('sum(order_total)')} as header_total,
      {dbl('coalesce(sum(t), 0)')} as lines_total, {dbl('sum(order_total) - coalesce(sum(t), 0)')} as difference,
      count(*) filter (order_total <> coalesce(t, 0)) as orders_differing
      from raw_orders left join (select order_id, sum(line_total) as t from raw_order_items group by 1) using (order_id)
      group by status""",
    "rfm_base": _with("rfm_base") + f"select * replace ({dbl('monetary')} as monetary) from rfm_base",
    "rfm_scored": _with("rfm_scored") + f"select customer_id, {RFM_COLUMNS} from rfm_scored",
    "rfm_scored_asc": _with("rfm_scored_asc") + f"select customer_id, {RFM_COLUMNS} from rfm_scored_asc",
    "rfm_scored_ranged": _with("rfm_scored") + f"select customer_id, {RFM_COLUMNS} from rfm_scored",
    "customer_metrics_left": _with("metrics") + f"select {CUSTOMER_COLUMNS}, {RFM_COLUMNS} from metrics",
    "customer_metrics_inner": _with("dim_customers", "rfm_scored")
    + f"""select c.customer_id, c.full_name, c.segment, recency_days, frequency, {dbl('monetary')} as monetary,
      r_score, f_score, m_score, rfm_score, rfm_segment
      from rfm_scored s join dim_customers c on s.customer_id = c.customer_id""",
    "rfm_segment_breakdown": _with("metrics")
    + f"""select rfm_segment, count(*) as customers,
      {mean('sum(' + cents('monetary') + ')', 'count(monetary)', 2, 2)} as avg_spend,
      {mean('sum(recency_days)', 'count(recency_days)', 0, 1)} as avg_recency_days
      from metrics where rfm_segment is not null group by 1""",
    "top_revenue_months": _with("fct_orders")
    + f"""select order_year, order_month, count(order_id) as orders, {dbl('sum(exact_total)')} as revenue
      from fct_orders where status = 'completed' group by 1, 2
      order by sum(exact_total) desc nulls last, 1, 2 limit 5""",
    "category_revenue": _with("lines")
    + f"""select category, count(distinct order_id) as num_orders, {dbl('sum(line_total)')} as total_revenue,
      {mean('sum(' + cents('line_total') + ')', 'count(line_total)', 2, 2)} as avg_line_value
      from lines group by 1""",
    "top_products": _with("lines")
    + f"""select product_name, category, {dbl('price')} as price, {tier('price')} as price_tier,
      count(item_id) as times_ordered, {dbl('sum(line_total)')} as total_revenue
      from lines group by product_name, category, lines.price
      order by sum(line_total) desc nulls last, product_name, category, lines.price limit 20""",
    "monthly_kpis": _with("fct_orders")
    + f"""select order_year, order_month, count(order_id) as num_orders, {dbl('sum(exact_total)')} as revenue,
      count(distinct customer_id) as unique_customers,
      concat(order_year, '-', lpad(cast(order_month as varchar), 2, '0')) as period
      from fct_orders where status = 'completed' group by order_year, order_month""",
    "monthly_revenue": _with("fct_orders")
    + f"""select strftime(order_date, '%Y-%m') as period, {dbl('sum(exact_total)')} as revenue
      from fct_orders where status = 'completed' and order_date is not null group by 1""",
    "overview_kpis": _with("fct_orders") + _overview("order_year is not null"),
    "overview_kpis_by_years": _with("fct_orders") + _overview("order_year in (1996, 1998)"),
    "year_choices": _with("stg_orders") + "select distinct order_year from stg_orders where order_year is not null",
    "category_choices": _with("raw_products") + "select distinct category from raw_products where category is not null",
    "status_breakdown": _with("fct_orders")
    + _counts("(select * from fct_orders where order_year is not null)", "status", "orders"),
    "weekday_revenue": _with("fct_orders")
    + f"""select cast(isodow(order_date) - 1 as integer) as dow, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun']
      [isodow(order_date)] as day, {dbl('sum(exact_total)')} as revenue
      from fct_orders where status = 'completed' and order_date is not null group by 1, 2""",
    "product_kpis": _with("dim_products")
    + f"""select count(*) as products, count(*) filter (is_active) as active_products,
      {ratio('count(*) filter (is_active)', 'count(*)', '100e0')} as active_percent,
      count(distinct category) as categories from dim_products""",
    "price_tier_distribution": _with("dim_products") + _counts("dim_products", "price_tier", "products"),
    "customer_kpis": _with("dim_customers")
    + f"""select count(*) as customers, count(*) filter (segment = 'VIP') as vip_customers,
      count(*) filter (segment = 'At-Risk') as at_risk_customers,
      {ratio("count(*) filter (segment = 'At-Risk')", 'count(*)', '100e0')} as at_risk_percent,
      count(*) filter (segment = 'New') as new_customers from dim_customers""",
    "customer_segment_distribution": _with("dim_customers") + _counts("dim_customers", "segment", "customers"),
    "rfm_distribution": _with("metrics") + _counts("metrics", "rfm_segment", "customers"),
    "recency_monetary_points": _with("metrics")
    + f"""select customer_id, rfm_segment, recency_days, {dbl('monetary')} as monetary, frequency, rfm_score
      from metrics where rfm_segment is not null""",
    "spend_histogram": _with("metrics")
    + f"""select cast(b as integer) as bin, round(mn + (mx - mn) / 40e0 * (b - 1), 2) as low,
      round(mn + (mx - mn) / 40e0 * b, 2) as high, count(v) as customers
      from (select min({dbl('monetary')}) as mn, max({dbl('monetary')}) as mx from metrics),
        (select unnest(range(1, 41)) as b)
      left join (select {dbl('monetary')} as v from metrics where monetary is not null)
        on b = least(40, cast(floor(40e0 * (v - mn) / (mx - mn)) as integer) + 1)
      group by b, mn, mx""",
    "spend_spread_by_segment": _with("metrics") + _SPREAD,
    "spend_spread_ranged": _with("metrics") + _SPREAD,
    "run_statistics": _with("raw_orders")
    + f"""select count(*) as total_orders, {dbl('sum(order_total)')} as total_revenue,
      count(distinct customer_id) as unique_customers from raw_orders where status = 'completed'""",
    "warehouse_counts": _with("dim_customers", "dim_products", "fct_orders", "metrics", "raw_events")
    + " union all ".join(
        f"select '{name}' as tbl, count(*) as rows from {table}"
        for name, table in (
            ("dim_customers", "dim_customers"),
            ("dim_products", "dim_products"),
            ("fct_orders", "fct_orders"),
            ("fct_customer_metrics", "metrics"),
            ("fct_events", "raw_events"),
        )
    ),
    "ingest_profile": _with("raw_customers", "raw_orders", "raw_order_items", "raw_events")
    + " union all ".join(
        [
            _check("Total customers", "count(*)", "raw_customers"),
            _check("Duplicate customers", "count(*) - count(distinct customer_id)", "raw_customers"),
            _check("Missing emails", "count(*) filter (email is null)", "raw_customers"),
            _check("Total orders", "count(*)", "raw_orders"),
            _check("Missing shipping city", "count(*) filter (shipping_city is null)", "raw_orders"),
            _check("Revenue (completed)", "sum(order_total) filter (status = 'completed')", "raw_orders"),
            _check("Total order items", "count(*)", "raw_order_items"),
            _check("Total events", "count(*)", "raw_events"),
            _check("Anonymous events", "count(*) filter (customer_id is null)", "raw_events"),
            f"select 'Orders by status', status, {dbl('count(*)')} from raw_orders group by status",
        ]
    ),
    "dq_unique": _with(*(table for table, _ in MODEL_TABLES.values()))
    + " union all ".join(
        _test(model, column, "unique", _duplicates(table, column)) for model, (table, column) in MODEL_TABLES.items()
    ),
    "dq_not_null": _with(*(table for table, _ in MODEL_TABLES.values()))
    + " union all ".join(
        _test(model, column, "not_null", f"select count(*) filter ({column} is null) as failures from {table}")
        for model, table, column in (
            *((m, t, c) for m, (t, c) in MODEL_TABLES.items()),
            ("stg_customers", "dim_customers", "email"),
        )
    ),
    "dq_accepted_values": _with("dim_customers", "stg_orders")
    + " union all ".join(
        _test(model, column, "accepted_values", f"select count(*) filter ({column} not in {vals}) as failures from {t}")
        for model, t, column, vals in (
            ("stg_customers", "dim_customers", "segment", ("VIP", "Regular", "At-Risk", "New")),
            ("stg_orders", "stg_orders", "status", ("completed", "pending", "cancelled", "refunded")),
        )
    ),
    "dq_gate_report": _with("raw_orders", "raw_customers")
    + " union all ".join(
        [
            _gate("No null order IDs", "==", 0, "count(*) filter (order_id is null)", "raw_orders"),
            _gate("No negative revenue", "==", 0, "count(*) filter (order_total < 0)", "raw_orders"),
            _gate("Customer count sanity", ">=", 900, "count(distinct customer_id)", "raw_customers"),
        ]
    ),
    "churn_features": _with("features") + f"select * replace ({dbl('monetary')} as monetary) from features",
    "stratified_split": _with("features") + _SPLIT,
    "stratified_split_ranged": _with("features") + _SPLIT,
    "churn_risk_bins": _with("stand_in")
    + """select customer_id, churn_probability, case when churn_probability > 0 and churn_probability <= 0.3e0 then 'Low'
      when churn_probability > 0.3e0 and churn_probability <= 0.6e0 then 'Medium'
      when churn_probability > 0.6e0 and churn_probability <= 1 then 'High' end as churn_risk from stand_in""",
    "confusion_matrix": _with("stand_in")
    + "select churned as actual, prediction as predicted, count(*) as rows from stand_in group by 1, 2",
    "classification_report": _with("stand_in").rstrip() + ", " + _CLASSES + _REPORT,
    "roc_auc": _with("stand_in")
    + f"""select {ratio('sum(pos * (2 * (n - fp) + neg))', '2 * max(p) * max(n)')} as roc_auc from (
      select pos, neg, sum(neg) over (order by s desc) as fp, sum(pos) over () as p, sum(neg) over () as n
      from (select churn_probability as s, sum(churned) as pos, sum(1 - churned) as neg from stand_in group by 1))""",
    "roc_curve": _with("stand_in") + _ROC,
    "roc_curve_ranged": _with("stand_in") + _ROC,
    "cluster_profile": _with("stand_in")
    + f"""select cluster, customers, avg_recency, avg_frequency, avg_spend,
      ['High Value', 'Mid Value', 'Low Value', 'Dormant'][row_number() over (order by m desc nulls last, cluster)]
        as label
      from (select cluster, count(customer_id) as customers,
        {mean('sum(recency_days)', 'count(recency_days)', 0, 1)} as avg_recency,
        {mean('sum(frequency)', 'count(frequency)', 0, 1)} as avg_frequency, {_MONEY_MEAN} as avg_spend,
        {ratio('sum(monetary)', 'count(monetary)')} as m from stand_in group by 1)""",
    "kmeans_nearest": _with("nearest")
    + "select customer_id, cast(cluster as integer) as cluster, round(d, 6) + 0e0 as squared_distance from nearest",
    "kmeans_step": _with("nearest")
    + """select cast(cluster as integer) as cluster, count(*) as customers, round(sum(d), 6) as cost,
      round(avg(z1), 6) + 0e0 as z_recency_days, round(avg(z2), 6) + 0e0 as z_frequency, round(avg(z3), 6) + 0e0 as z_monetary
      from nearest group by 1""",
    "churn_kpis_fixed": _with("judged")
    + f"""select count(*) filter (churn_risk = 'High') as high_risk,
      {ratio("count(*) filter (churn_risk = 'High')", 'count(*)', '100e0')} as high_risk_percent,
      count(*) filter (ml_segment = 'Champions') as champions,
      {ratio("count(*) filter (ml_segment = 'Champions')", 'count(*)', '100e0')} as champions_percent,
      round(avg(churn_probability), 9) as avg_churn_probability,
      case when avg(churn_probability) > 0.5e0 then 'High' when avg(churn_probability) > 0.3e0 then 'Moderate' else 'Low' end
        as churn_status from judged""",
    "churn_risk_distribution_fixed": _with("judged") + _counts("judged", "churn_risk", "customers"),
    "ml_segment_distribution_fixed": _with("judged") + _counts("judged", "ml_segment", "customers"),
    "churn_spread_by_segment_fixed": _with("judged") + _CHURN_SPREAD,
    "top_churn_fixed": _with("judged")
    + f"""select customer_id, rfm_segment, recency_days, frequency, {dbl('monetary')} as monetary, churn_probability
      from judged order by churn_probability desc, customer_id limit 20""",
    "customer_insights_fixed": _with("judged")
    + "select customer_id, churn_probability, prediction, churn_risk, cluster, ml_segment from judged",
    "scaled_features": _with("metrics")
    + "select customer_id, "
    + ", ".join(
        f"round(({dbl(c)} - avg({dbl(c)}) over ()) / stddev_pop({dbl(c)}) over (), 6) + 0e0 as z_{c}"
        for c in ("recency_days", "frequency", "monetary")
    )
    + " from metrics where rfm_segment is not null",
    "series_features": _with("series")
    + f"""select period, {dbl('order_total')} as order_total, period_idx, month_num, round(sin_month, 9) + 0e0 as sin_month,
      round(cos_month, 9) + 0e0 as cos_month from series""",
    "forecast_fit": _with("fitted")
    + f"select period, {dbl('order_total')} as order_total, is_test, round(prediction, 2) as prediction from fitted",
    "forecast_metrics": _with("fitted")
    + """select round(avg(abs(y - prediction)), 2) as mae,
      round(sqrt(avg((y - prediction) * (y - prediction))), 2) as rmse from fitted where is_test""",
    "forecast_next": _with("ahead")
    + """select period, period_idx, round(forecast, 2) as forecast,
      round((forecast / t - 1) * 100, 6) as change_percent from ahead""",
    "forecast_report": _with("ahead", "fitted")
    + """select strftime(period, '%Y-%m') as month, round(forecast, 2) as forecast,
      round((forecast / t - 1) * 100, 6) as change_percent, round(mae, 2) as mae,
      case when mae < 10000 then 'Accurate' when mae < 25000 then 'Moderate' else 'Review model' end as error_status
      from ahead, (select avg(abs(y - prediction)) as mae from fitted where is_test)""",
}
