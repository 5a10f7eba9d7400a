"""Report views: customer spending, customer report, product report.

``as_of`` replaces the wall clock (ages, recency, date validity) so results
are reproducible.  Thresholds are parameters with the source defaults.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.functions.exprs import (
    band, concat_nulls_as_empty, int_div, month_diff, round_ratio, year_diff)
from layercake.operators.keys import lookup_side
from layercake.session import materialize
from layercake.plans.analysis import (
    VIP_MIN_LIFESPAN_MONTHS, VIP_MIN_SPEND_EXCLUSIVE, customer_spending_base, segment)

# Fixed values of the source reports.
AGE_CUTS = (19, 29, 39, 49)
AGE_LABELS = ("Under 20", "20-29", "30-39", "40-49")
AGE_OTHER = "50 And Above"
TIER_CUTS = (5000, 20000, 50000)
TIER_LABELS = ("Low Performers", "Mid Performers", "High Performers", "Top Performers")


def _as_of(as_of) -> F.Column:
    return F.lit(str(as_of)).cast("date")


def customer_spending(fact: DataFrame, dim_customers: DataFrame,
                      spend_threshold=VIP_MIN_SPEND_EXCLUSIVE,
                      min_lifespan=VIP_MIN_LIFESPAN_MONTHS) -> DataFrame:
    """Per customer: name, spend, lifespan, segment; sorted by segment.

    The result has one row per customer, so the segment (3 values) alone
    would range-partition the sort into 3 tasks; the spend and name
    tie-breakers spread it evenly without changing the segment order."""
    cs = customer_spending_base(fact, dim_customers)
    return (cs.select("customer_name", "total_spending", "lifespan",
                      segment("lifespan", "total_spending", spend_threshold, min_lifespan)
                      .alias("customer_segment"))
              .orderBy(F.desc("customer_segment"), F.desc("total_spending"),
                       F.asc("customer_name")))


def customers_report(fact: DataFrame, dim_customers: DataFrame, as_of: dt.date | str,
                     spend_threshold=VIP_MIN_SPEND_EXCLUSIVE,
                     min_lifespan=VIP_MIN_LIFESPAN_MONTHS) -> DataFrame:
    """One row per customer key with KPIs.  Aggregated on the fact first (two
    distinct counts -> one Expand + two-phase aggregate), then joined to the
    dimension once per customer."""
    agg = fact.groupBy("customer_key").agg(
        F.countDistinct("order_number").alias("total_orders"),
        F.sum("sales_amount").cast("long").alias("total_sales"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.countDistinct("product_key").alias("total_products"),
        F.max("order_date").alias("last_order"),
        F.min("order_date").alias("first_order"))
    dim = dim_customers.select("customer_key", "customer_number", "first_name", "last_name",
                               "birth_date")
    j = agg.join(dim, "customer_key", "left")
    today = _as_of(as_of)
    base = j.select(
        "customer_key", "customer_number",
        concat_nulls_as_empty("first_name", F.lit(" "), "last_name").alias("customer_name"),
        year_diff("birth_date", today).alias("customer_age"),
        "first_order", "last_order", "total_orders", "total_sales", "total_quantity",
        "total_products", month_diff("first_order", "last_order").alias("lifespan"))
    ls, ts = F.col("lifespan"), F.col("total_sales")
    return base.select(
        "customer_key", "customer_number", "customer_name", "customer_age",
        band("customer_age", AGE_CUTS, AGE_LABELS, AGE_OTHER).alias("age_group"),
        segment("lifespan", "total_sales", spend_threshold, min_lifespan)
        .alias("customer_segment"),
        "first_order", "last_order",
        month_diff("last_order", today).alias("recency"),
        "total_orders", "total_sales", "total_quantity", "total_products", "lifespan",
        int_div(ts, "total_orders").alias("average_order_value"),
        F.when(ls == 0, ts).otherwise(int_div(ts, ls)).alias("average_monthly_spent"))


def _tier(col):
    return band(col, TIER_CUTS, TIER_LABELS, None)


def products_report(fact: DataFrame, dim_products: DataFrame, as_of: dt.date | str
                    ) -> DataFrame:
    """Product report at the grain the source actually groups by: product x
    order date x rounded unit price (so lifespan is 0, or NULL without a date).

    The 'average monthly revenue' is a truncating running average over rows
    of the same calendar month, newest month first, peers included.  A window
    partitioned by MONTH() would put 1/12 of the rows in each of 12 tasks;
    instead the rows are pre-aggregated per year-month (at most 12 x 9999
    rows, a hard bound from the DATE range), the running sums are taken there
    and broadcast back.  The fact is scanned and aggregated once.

    A group holds few sales, mostly one, so combining before the shuffle takes
    memory and leaves the rows, three times over for two distinct counts.  The
    sales are therefore dealt by the whole group key first, and all later steps
    run where they are: a customer counts at its first sale of a group, so that
    one distinct count is left, which needs no copies of the rows."""
    grain = ["product_key", "order_date", "average_selling_price"]
    asp = round_ratio("sales_amount", "quantity", 1, ints=True)
    f = (fact.filter(F.col("price").isNotNull() & F.col("product_key").isNotNull())
             .select("product_key", "order_date", asp.alias("average_selling_price"),
                     "order_number", "customer_key", "sales_amount", "quantity")
             # the price's hash: Spark would not take a dealing by doubles for that of its groups
             .withColumn("_price", F.hash("average_selling_price"))
             .repartition("product_key", "order_date", "_price"))
    own = Window.partitionBy(*grain, "_price", "customer_key").orderBy("customer_key")
    new = F.col("customer_key").isNotNull() & (F.row_number().over(own) == 1)
    agg = f.withColumn("_new", new.cast("long")).groupBy(*grain, "_price").agg(
        F.countDistinct("order_number").alias("total_orders"),
        F.sum("sales_amount").cast("long").alias("total_sales"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.sum("_new").alias("total_customers")).drop("_price")
    # both grains come from one aggregate of the fact, written once
    agg = materialize(agg, fact.sparkSession, "product_days")
    # order_date is a grouping key, so first = last order = order_date
    agg = agg.withColumns({"last_order": F.col("order_date"),
                           "first_order": F.col("order_date")})
    dim = dim_products.select("product_key", "product_name", "category", "sub_category", "cost")
    j = agg.join(dim, "product_key", "inner").withColumn(
        "_month", F.trunc("order_date", "month"))

    # the months need no names, only whether there is a product
    per_month = agg.join(lookup_side(dim.select("product_key")), "product_key", "inner").groupBy(
        F.trunc("order_date", "month").alias("_month")).agg(
        F.sum("total_sales").alias("_s"), F.count("total_sales").alias("_c"))
    w = Window.partitionBy(F.month("_month")).orderBy(F.col("_month").desc())
    running = per_month.select(
        F.col("_month").alias("_m"),
        int_div(F.sum("_s").over(w), F.sum("_c").over(w)).alias("average_monthly_revenue"))
    j = j.join(F.broadcast(running), j["_month"].eqNullSafe(running["_m"]), "left")

    today = _as_of(as_of)
    ls, ts, to = (F.col("lifespan"), F.col("total_sales"), F.col("total_orders"))
    base = j.withColumn("lifespan", month_diff("first_order", "last_order"))
    return base.select(
        "product_key", "product_name", "category", "sub_category", "cost",
        "total_orders", "total_sales", "total_quantity", "total_customers", "lifespan",
        F.when(to == 0, F.lit(0).cast("long")).otherwise(int_div(ts, to))
        .alias("average_order_revenue"),
        "average_selling_price",
        month_diff("last_order", today).alias("recency"),
        "average_monthly_revenue",
        F.when(ls == 0, ts).otherwise(int_div(ts, ls)).alias("average_monthly_revenue_second"),
        _tier(ts).alias("performance_sales_products"))


def products_report_by_product(fact: DataFrame, dim_products: DataFrame,
                               as_of: dt.date | str) -> DataFrame:
    """The product report at its documented grain: one row per product."""
    f = fact.filter(F.col("price").isNotNull() & F.col("product_key").isNotNull())
    agg = f.groupBy("product_key").agg(
        F.countDistinct("order_number").alias("total_orders"),
        F.sum("sales_amount").cast("long").alias("total_sales"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.countDistinct("customer_key").alias("total_customers"),
        F.max("order_date").alias("last_order"),
        F.min("order_date").alias("first_order"))
    dim = dim_products.select("product_key", "product_name", "category", "sub_category", "cost")
    j = agg.join(dim, "product_key", "inner")
    today = _as_of(as_of)
    base = j.withColumn("lifespan", month_diff("first_order", "last_order"))
    ls, ts, to = F.col("lifespan"), F.col("total_sales"), F.col("total_orders")
    return base.select(
        "product_key", "product_name", "category", "sub_category", "cost",
        "first_order", "last_order", "total_orders", "total_sales", "total_quantity",
        "total_customers", "lifespan",
        F.when(to == 0, F.lit(0).cast("long")).otherwise(int_div(ts, to))
        .alias("average_order_revenue"),
        round_ratio(ts, "total_quantity", 1).alias("average_selling_price"),
        month_diff("last_order", today).alias("recency"),
        F.when(ls == 0, ts).otherwise(int_div(ts, ls)).alias("average_monthly_revenue"),
        _tier(ts).alias("performance_sales_products"))
