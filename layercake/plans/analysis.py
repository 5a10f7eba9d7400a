"""Analytical queries over the star schema (trend, cumulative, year over
year, part-to-whole, segmentation).

Scale notes
-----------
* Facts are aggregated on the fact's own keys *before* joining a dimension
  (dimension attributes are functionally dependent on the surrogate key), so
  joins see one row per key instead of one per sale, and the hash
  aggregates do map-side partial aggregation - a hot key cannot swamp a task.
* Windows run only on already-aggregated rows: per year (bounded by the
  9999 years a DATE can hold) or per (year, product name).
* The grand total of the part-to-whole query is a scalar subquery - no
  cross join and no single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.functions.exprs import (
    concat_null_propagating, int_avg, int_avg_over, int_div, month_diff, pct_text, round_ratio)

from layercake.operators.distinct import distinct_words, roll_up
from layercake.operators.windows import running_totals
from layercake.session import materialize

# Segment rule defaults (fixed values of the source reports).
VIP_MIN_LIFESPAN_MONTHS = 12
VIP_MIN_SPEND_EXCLUSIVE = 5000


def segment(lifespan, spend, threshold=VIP_MIN_SPEND_EXCLUSIVE,
            min_lifespan=VIP_MIN_LIFESPAN_MONTHS):
    """VIP / Regular / New; NULL lifespan or spend falls to New."""
    ls, sp = F.col(lifespan), F.col(spend)
    return (F.when((ls >= min_lifespan) & (sp > threshold), F.lit("VIP"))
             .when((ls >= min_lifespan) & (sp <= threshold), F.lit("Regular"))
             .otherwise(F.lit("New")))


def yearly_trend(fact: DataFrame, date_col="order_date", measure="sales_amount",
                 customer="customer_key", qty="quantity") -> DataFrame:
    d = F.col(date_col)
    return (fact.filter(d.isNotNull())
                .groupBy(F.year(d).alias("order_year"))
                .agg(F.sum(measure).cast("long").alias("total_sales"),
                     F.countDistinct(customer).alias("total_customers"),
                     F.sum(qty).cast("long").alias("total_quantity"))
                .orderBy("order_year"))


def monthly_trend(fact: DataFrame, date_col="order_date", measure="sales_amount",
                  customer="customer_key", qty="quantity") -> DataFrame:
    """Per year and month NAME (so months sort alphabetically, as written)."""
    d = F.col(date_col)
    return (fact.filter(d.isNotNull())
                .groupBy(F.year(d).alias("order_year"),
                         F.date_format(d, "MMMM").alias("order_month"))
                .agg(F.sum(measure).cast("long").alias("total_sales"),
                     F.countDistinct(customer).alias("total_customers"),
                     F.sum(qty).cast("long").alias("total_quantity"))
                .orderBy("order_year", "order_month"))


def distinct_trend(fact: DataFrame, date_col="order_date", customer="customer_key",
                   product="product_key") -> DataFrame:
    """Distinct customers and products by month, by year and over all time.

    The fact is read once: years and the total come from the months' words."""
    d = F.col(date_col)
    words = distinct_words(fact.filter(d.isNotNull()),
                           [F.year(d).alias("order_year"), F.month(d).alias("order_month")],
                           [F.col(customer), F.col(product)])
    words = materialize(words, fact.sparkSession, "distinct_words")
    return roll_up(words, ["order_year", "order_month"], ["total_customers", "total_products"],
                   {"month": 2, "year": 1, "all": 0})


def _yearly_totals(fact, date_col, measure, price):
    d = F.col(date_col)
    return (fact.filter(d.isNotNull())
                .groupBy(F.trunc(d, "year").alias("order_date"))
                .agg(F.sum(measure).cast("long").alias("total_sales"),
                     int_avg(price).alias("average_price")))


def cumulative_as_written(fact: DataFrame, date_col="order_date", measure="sales_amount",
                          price="price") -> DataFrame:
    """Yearly totals with the 'running total' exactly as specified: it is
    partitioned by its own order column, so it equals the year's total; the
    moving average price is a truncating cumulative average."""
    y = _yearly_totals(fact, date_col, measure, price)
    own = Window.partitionBy("order_date").orderBy("order_date")
    # one row per year: the global ordered window is bounded by the year count
    upto = Window.orderBy("order_date")
    return y.select(
        "order_date", "total_sales",
        F.sum("total_sales").over(own).cast("long").alias("running_total_sales"),
        int_avg_over("average_price", upto).alias("moving_average_price"))


def cumulative_intended(fact: DataFrame, date_col="order_date", measure="sales_amount",
                        price="price") -> DataFrame:
    """Same, with a true running total across years."""
    y = _yearly_totals(fact, date_col, measure, price)
    upto = Window.orderBy("order_date")
    return y.select(
        "order_date", "total_sales",
        F.sum("total_sales").over(upto).cast("long").alias("running_total_sales"),
        int_avg_over("average_price", upto).alias("moving_average_price"))


def cumulative_daily(fact: DataFrame, date_col="order_date", measure="sales_amount",
                     price="price", grain: str = "day") -> DataFrame:
    """The cumulative totals at a finer grain (any unit of ``date_trunc``):
    per day its sales, the running total of all days up to it, and the
    truncating running average of the days' average prices.  Running totals go
    over ranges of days, so no task gets them all."""
    day = F.date_trunc(grain, F.col(date_col)).cast("date")
    days = (fact.filter(F.col(date_col).isNotNull()).groupBy(day.alias("order_date"))
                .agg(F.sum(measure).cast("long").alias("total_sales"), int_avg(price).alias("average_price")))
    run = running_totals(days, [], [F.asc("order_date")], {
        "running_total_sales": F.col("total_sales"), "_prices": F.col("average_price"),
        "_days": F.col("average_price").isNotNull().cast("long")}, name="cumulative_daily")
    return run.select("order_date", "total_sales", "running_total_sales",
                      int_div("_prices", "_days").alias("moving_average_price"))


def product_performance_yoy(fact: DataFrame, dim_products: DataFrame,
                            group_col="product_name", date_col="order_date",
                            measure="sales_amount") -> DataFrame:
    """Per (year, product name): sales vs the product's own truncating
    average and vs the previous year."""
    d = F.col(date_col)
    pre = (fact.filter(d.isNotNull())
               .groupBy(F.year(d).alias("order_year"), "product_key")
               .agg(F.sum(measure).alias("_s")))
    j = pre.join(dim_products.select("product_key", group_col), "product_key", "left")
    yearly = j.groupBy("order_year", group_col).agg(
        F.sum("_s").cast("long").alias("current_sales"))
    whole = Window.partitionBy(group_col)
    ordered = Window.partitionBy(group_col).orderBy("order_year")
    avg_s = int_avg_over("current_sales", whole)
    prev = F.lag("current_sales").over(ordered)
    cur = F.col("current_sales")
    out = yearly.select(
        "order_year", group_col, "current_sales",
        avg_s.alias("avg_sales"), (cur - avg_s).alias("diff_avg"),
        prev.alias("previous_year_sales"), (cur - prev).alias("diff_previous_year"))
    da, dp = F.col("diff_avg"), F.col("diff_previous_year")
    return (out.withColumns({
        "avg_change": F.when(da < 0, "Below Avg").when(da > 0, "Above Avg").otherwise("On Avg"),
        "previous_year_change": F.when(dp > 0, "Sales Increasing")
                                 .when(dp < 0, "Sales Decreasing").otherwise("No Changes"),
    }).select("order_year", group_col, "current_sales", "avg_sales", "diff_avg",
              "avg_change", "previous_year_sales", "diff_previous_year",
              "previous_year_change")
      .orderBy(group_col, "order_year"))


def part_to_whole(fact: DataFrame, dim_products: DataFrame, group_col="category",
                  measure="sales_amount") -> DataFrame:
    """Share of total sales per category, as a number and as '%' text."""
    pre = fact.groupBy("product_key").agg(F.sum(measure).alias("_s"))
    per = (pre.join(dim_products.select("product_key", group_col), "product_key", "left")
              .groupBy(group_col).agg(F.sum("_s").cast("long").alias("total_sales")))
    grand = per.select(F.sum("total_sales")).scalar()
    pct = round_ratio(F.col("total_sales").cast("decimal(38,0)") * 100, grand, 2)
    return (per.select(group_col, "total_sales", pct.alias("sales_pct"))
               .withColumn("sales_percentage", pct_text("sales_pct"))
               .orderBy(F.desc("total_sales")))


def customer_spending_base(fact: DataFrame, dim_customers: DataFrame,
                           date_col="order_date", measure="sales_amount") -> DataFrame:
    """Per customer key: name (first + ' ' + last, NULL-propagating), spend,
    first/last order and lifespan in month boundaries."""
    pre = fact.groupBy("customer_key").agg(
        F.sum(measure).cast("long").alias("total_spending"),
        F.min(date_col).alias("first_order_date"),
        F.max(date_col).alias("last_order_date"))
    dim = dim_customers.select("customer_key", "first_name", "last_name")
    j = pre.join(dim, "customer_key", "left")
    return j.select(
        "customer_key",
        concat_null_propagating("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "total_spending", "first_order_date", "last_order_date",
        month_diff("first_order_date", "last_order_date").alias("lifespan"))


def segment_counts(fact: DataFrame, dim_customers: DataFrame,
                   spend_threshold=VIP_MIN_SPEND_EXCLUSIVE,
                   min_lifespan=VIP_MIN_LIFESPAN_MONTHS) -> DataFrame:
    """Customers per segment (COUNT(customer_key): the unmatched group counts 0)."""
    cs = customer_spending_base(fact, dim_customers)
    return (cs.withColumn("customer_segment",
                          segment("lifespan", "total_spending", spend_threshold, min_lifespan))
              .groupBy("customer_segment")
              .agg(F.count("customer_key").alias("total_customers"))
              .orderBy(F.desc("customer_segment")))
