"""SQL text of the report views: they read the star schema of the gold
namespace by name, so a report is as current as the tables are, in any session.

Rules and parameters are those of ``reports``; ``as_of`` None stands for the
day on which a view is read.
"""

from __future__ import annotations

from layercake.plans import reports
from layercake.plans.analysis import VIP_MIN_LIFESPAN_MONTHS, VIP_MIN_SPEND_EXCLUSIVE
from layercake.sources.catalog import Layers


def _months(start: str, end: str) -> str:
    return f"CAST((year({end}) - year({start})) * 12 + month({end}) - month({start}) AS INT)"


def _steps(value: str, cuts, labels, beyond: str) -> str:
    """The label of the first cut that ``value`` does not exceed."""
    steps = " ".join(f"WHEN {value} <= {c} THEN '{t}'" for c, t in zip(cuts, labels))
    return f"CASE {steps} {beyond} END"


def _segment(spend: str, threshold) -> str:
    old = f"lifespan >= {VIP_MIN_LIFESPAN_MONTHS}"
    return (f"CASE WHEN {old} AND {spend} > {threshold} THEN 'VIP' "
            f"WHEN {old} AND {spend} <= {threshold} THEN 'Regular' ELSE 'New' END")


_PER_MONTH = "CASE WHEN lifespan = 0 THEN total_sales ELSE total_sales div nullif(lifespan, 0) END"


def report_views(layers: Layers, as_of=None, spend_threshold=VIP_MIN_SPEND_EXCLUSIVE) -> dict[str, str]:
    """Name -> SQL text of the three report views."""
    gold = layers.gold
    today = "current_date()" if as_of is None else f"DATE '{as_of}'"
    tier = _steps("total_sales", reports.TIER_CUTS, reports.TIER_LABELS,
                  f"WHEN total_sales > {reports.TIER_CUTS[-1]} THEN '{reports.TIER_LABELS[-1]}'")
    age = _steps("customer_age", reports.AGE_CUTS, reports.AGE_LABELS, f"ELSE '{reports.AGE_OTHER}'")
    return {
        "customer_spending": f"""
WITH spent AS (
  SELECT customer_key, CAST(sum(sales_amount) AS BIGINT) AS total_spending,
         {_months('min(order_date)', 'max(order_date)')} AS lifespan
  FROM {gold}.fact_sales GROUP BY customer_key)
SELECT first_name || ' ' || last_name AS customer_name, total_spending, lifespan,
       {_segment('total_spending', spend_threshold)} AS customer_segment
FROM spent LEFT JOIN {gold}.dim_customers USING (customer_key)""",
        "customers_report": f"""
WITH sales AS (
  SELECT customer_key, count(DISTINCT order_number) AS total_orders, count(DISTINCT product_key) AS total_products,
         CAST(sum(sales_amount) AS BIGINT) AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_quantity,
         min(order_date) AS first_order, max(order_date) AS last_order
  FROM {gold}.fact_sales GROUP BY customer_key),
named AS (
  SELECT s.*, customer_number, concat_ws('', first_name, ' ', last_name) AS customer_name,
         CAST(year({today}) - year(birth_date) AS INT) AS customer_age,
         {_months('first_order', 'last_order')} AS lifespan
  FROM sales s LEFT JOIN {gold}.dim_customers c ON c.customer_key = s.customer_key)
SELECT customer_key, customer_number, customer_name, customer_age, {age} AS age_group,
       {_segment('total_sales', spend_threshold)} AS customer_segment, first_order, last_order,
       {_months('last_order', today)} AS recency, total_orders, total_sales, total_quantity, total_products, lifespan,
       total_sales div nullif(total_orders, 0) AS average_order_value, {_PER_MONTH} AS average_monthly_spent
FROM named""",
        "products_report": f"""
WITH priced AS (
  SELECT *, CAST((abs(CAST(sales_amount AS BIGINT)) * 20 + abs(quantity)) div nullif(2 * abs(CAST(quantity AS BIGINT)), 0)
                 * sign(sales_amount) * sign(quantity) / 10D AS DOUBLE) AS average_selling_price
  FROM {gold}.fact_sales WHERE price IS NOT NULL AND product_key IS NOT NULL),
sales AS (
  SELECT product_key, order_date, average_selling_price, count(DISTINCT order_number) AS total_orders,
         count(DISTINCT customer_key) AS total_customers, CAST(sum(sales_amount) AS BIGINT) AS total_sales,
         CAST(sum(quantity) AS BIGINT) AS total_quantity, {_months('order_date', 'order_date')} AS lifespan
  FROM priced GROUP BY product_key, order_date, average_selling_price),
-- a row a month: few, whatever the sales; the later months of each calendar month, itself included
monthly AS (
  SELECT day, sum(s) OVER later div nullif(sum(c) OVER later, 0) AS average_monthly_revenue
  FROM (SELECT trunc(order_date, 'month') AS day, sum(total_sales) AS s, count(total_sales) AS c
        FROM sales JOIN {gold}.dim_products USING (product_key) GROUP BY trunc(order_date, 'month'))
  WINDOW later AS (PARTITION BY month(day) ORDER BY day DESC))
SELECT product_key, product_name, category, sub_category, cost, total_orders, total_sales, total_quantity,
       total_customers, lifespan,
       CASE WHEN total_orders = 0 THEN 0L ELSE total_sales div total_orders END AS average_order_revenue,
       average_selling_price, {_months('order_date', today)} AS recency, average_monthly_revenue,
       {_PER_MONTH} AS average_monthly_revenue_second, {tier} AS performance_sales_products
FROM sales JOIN {gold}.dim_products USING (product_key) LEFT JOIN monthly ON day <=> trunc(order_date, 'month')""",
    }
