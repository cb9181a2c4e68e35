"""Metrics on the marts.

Rates count TRUE over NOT NULL (three-valued flags), never over all rows.
Delivery time is reported as exact median and 90th percentile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import count_known, count_true, pct, rate_pct
from ..operators.joins import sum_through
from ..operators.ranking import cumulative_share, share_of_total, top_n
from ..operators.sequence import percentiles_within
from .extracts import calendar, with_bucket
from .scope import REFERENCE_BUCKETS, REFERENCE_OPEN_BUCKET, REFERENCE_SLOW_TAIL_DAYS


def revenue_totals(items_fact: DataFrame) -> DataFrame:
    """K1-K4: revenue_net, revenue_gross, freight_cost, contribution, plus
    freight as % of net revenue."""
    return items_fact.agg(
        F.sum("revenue_net").alias("revenue_net"),
        F.sum("revenue_gross").alias("revenue_gross"),
        F.sum("freight_cost").alias("freight_cost"),
        F.sum("contribution_after_freight").alias("contribution_after_freight"),
    ).withColumn("freight_pct", pct(F.col("freight_cost"), F.col("revenue_net")))


def freight_burden(items_fact: DataFrame, dim: DataFrame, key: str, attr: str) -> DataFrame:
    """K5: freight as % of net revenue per dimension attribute."""
    return (sum_through(items_fact, dim, key, [attr],
                        {"revenue_net": "revenue_net", "freight_cost": "freight_cost"})
            .withColumn("freight_pct", pct(F.col("freight_cost"), F.col("revenue_net"))))


def delivery_time(orders_fact: DataFrame) -> DataFrame:
    """K6: median, p90 and mean delivery days of delivered orders. Integer
    days keep the exact-percentile buffer at one counter per distinct day."""
    d = orders_fact.where(F.col("delivery_days").isNotNull())
    return d.agg(F.count(F.lit(1)).alias("delivered_orders"),
                 F.percentile("delivery_days", 0.5).alias("median_days"),
                 F.percentile("delivery_days", 0.9).alias("p90_days"),
                 F.avg("delivery_days").alias("mean_days"))


def delivery_time_from_days(days: DataFrame) -> DataFrame:
    """K6 from the day-value aggregate: no fact is scanned."""
    d, n = days.where(F.col("delivery_days").isNotNull()), F.col("orders")
    return d.agg(F.coalesce(F.sum(n), F.lit(0)).alias("delivered_orders"),
                 F.percentile("delivery_days", 0.5, n).alias("median_days"),
                 F.percentile("delivery_days", 0.9, n).alias("p90_days"),
                 F.try_divide(F.sum(F.col("delivery_days") * n).cast("double"), F.sum(n).cast("double")).alias("mean_days"))


def lateness(orders_fact: DataFrame) -> DataFrame:
    """K7: late orders, delivered orders, late and on-time rates (%)."""
    late, known = count_true("is_late"), count_known("is_late")
    return orders_fact.agg(late.alias("late_orders"), known.alias("delivered_orders"),
                           pct(late, known).alias("late_pct"),
                           pct(known - late, known).alias("on_time_pct"))


def delivery_time_exact(orders_ext: DataFrame) -> DataFrame:
    """K8: percentiles of fractional delivery days. Continuous values may
    have as many distinct values as rows, so the exact percentile is computed
    by distributed ranking of value counts instead of a per-group value
    buffer; count and mean come from the same counts."""
    out = percentiles_within(orders_ext, [], "delivery_days_exact",
                             {"median_days_exact": 0.5, "p90_days_exact": 0.9},
                             count="delivered_orders", mean="mean_days_exact")
    return out.select("delivered_orders", "mean_days_exact", "median_days_exact", "p90_days_exact")


def negative_review_rate(orders_fact: DataFrame, delivered_only: bool = False) -> DataFrame:
    """K9: share of reviewed orders with a negative score, in %. By default
    over all fact rows, as the validation query; ``delivered_only`` limits
    it to orders with a delivery time."""
    f = orders_fact.where(F.col("delivery_days").isNotNull()) if delivered_only else orders_fact
    neg, known = count_true("is_negative_review"), count_known("is_negative_review")
    return f.agg(neg.alias("negative_reviews"), known.alias("reviewed_orders"),
                 pct(neg, known).alias("negative_pct"))


def late_vs_on_time(orders_fact: DataFrame) -> DataFrame:
    """Orders, mean score and negative rate, late against on time."""
    return (orders_fact.where(F.col("is_late").isNotNull())
            .groupBy("is_late")
            .agg(F.count(F.lit(1)).alias("orders"),
                 count_known("is_negative_review").alias("reviewed_orders"),
                 F.avg("review_score").alias("mean_score"),
                 rate_pct("is_negative_review", None).alias("negative_pct")))


def state_scorecard(days: DataFrame) -> DataFrame:
    """Per customer state - revenue, share of revenue, freight %, late
    rate, median delivery days, all from the day-value aggregate (medians
    cannot be recombined from state x month medians, but they can from the
    counts of day values). Both facts carry the same revenue."""
    card = (days.where("known_customer").groupBy("state")
            .agg(F.sum("revenue_net").alias("revenue_net"), F.sum("freight_cost").alias("freight_cost"),
                 F.sum("orders").alias("orders"), pct(F.sum("late_orders"), F.sum("delivered_orders")).alias("late_pct"),
                 F.percentile("delivery_days", 0.5, F.col("orders")).alias("median_days"))
            .withColumn("freight_pct", pct(F.col("freight_cost"), F.col("revenue_net"))))
    return share_of_total(card, "revenue_net", "revenue_share_pct")


def state_revenue_ranking(items_fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """States ranked by revenue with the running share of the total
    (how much the top states carry)."""
    rev = sum_through(items_fact, dim_customer, "customer_id", ["state"], {"revenue_net": "revenue_net"})
    return cumulative_share(rev, "revenue_net", "state")


def category_scorecard(items_fact: DataFrame, dim_product: DataFrame, n: int = 12) -> DataFrame:
    """Top-n categories by revenue with freight % and item count."""
    agg = (sum_through(items_fact, dim_product, "product_id", ["category_name_en"],
                       {"revenue_net": "revenue_net", "freight_cost": "freight_cost"}, count_as="items")
           .withColumn("freight_pct", pct(F.col("freight_cost"), F.col("revenue_net"))))
    return top_n(agg, "revenue_net", n, "category_name_en")


def slow_tail(orders_fact: DataFrame, days: int = REFERENCE_SLOW_TAIL_DAYS) -> DataFrame:
    """Orders delivered in more than ``days`` days - revenue, share of
    all fact revenue, negative-review rate."""
    slow = F.col("delivery_days") > days
    neg = F.count_if(slow & F.coalesce(F.col("is_negative_review"), F.lit(False)))
    known = F.count(F.when(slow, F.col("is_negative_review")))
    revenue = F.sum(F.when(slow, F.col("revenue_net")))
    return orders_fact.agg(F.count_if(slow).alias("orders"), revenue.alias("revenue_net"),
                           neg.alias("negative_reviews"), known.alias("reviewed_orders"),
                           pct(neg, known).alias("negative_pct"),
                           pct(revenue, F.sum("revenue_net")).alias("revenue_share_pct"))


def customer_counts(orders_fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders, distinct persons, surplus orders (orders - persons) and
    repeat customers (persons with more than one order)."""
    per_person = sum_through(orders_fact.withColumn("_one", F.lit(1)), dim_customer, "customer_id",
                             ["customer_unique_id"], {"n": "_one"})
    return per_person.agg(F.sum("n").alias("orders"),
                          F.count("customer_unique_id").alias("persons"),
                          (F.sum("n") - F.count("customer_unique_id")).alias("surplus_orders"),
                          F.count_if(F.col("n") > 1).alias("repeat_customers"))


def review_coverage(orders_fact: DataFrame) -> DataFrame:
    """Share of in-scope orders with a review."""
    return orders_fact.agg(F.count(F.lit(1)).alias("orders"),
                           F.count("review_score").alias("reviewed_orders"),
                           pct(F.count("review_score"), F.count(F.lit(1))).alias("coverage_pct"))


def scope_totals(items_fact: DataFrame, orders_fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders, items, distinct persons and states in scope."""
    c = dim_customer.select("customer_id", "customer_unique_id", "state")
    # grouped once per (person, state), then per person with their few states: no DISTINCT expansion of rows
    pairs = (orders_fact.select("customer_id").join(c, "customer_id").groupBy("customer_unique_id", "state")
             .agg(F.count(F.lit(1)).alias("n")))
    persons = (pairs.groupBy("customer_unique_id").agg(F.sum("n").alias("n"), F.collect_set("state").alias("states"))
               .select("customer_unique_id", "n", F.posexplode_outer("states").alias("i", "state")))
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    return persons.agg(F.coalesce(F.sum(F.when(first, F.col("n"))), F.lit(0)).alias("orders"),
                       F.count(F.when(first, F.col("customer_unique_id"))).alias("customers"),
                       F.size(F.collect_set("state")).cast("bigint").alias("states")) \
                  .select("orders", items_fact.agg(F.count(F.lit(1))).scalar().alias("items"),
                          "customers", "states")


def headline_buckets(orders_fact: DataFrame, buckets=REFERENCE_BUCKETS,
                     open_bucket=REFERENCE_OPEN_BUCKET) -> DataFrame:
    """Orders and negative-review rate (1 decimal) per delivery bucket."""
    return (with_bucket(orders_fact, buckets, open_bucket).groupBy("delivery_bucket")
            .agg(F.count(F.lit(1)).alias("orders"),
                 rate_pct("is_negative_review", 1).alias("negative_pct"),
                 F.min("delivery_days").alias("_first_day"))
            .orderBy("_first_day").drop("_first_day"))


def monthly_series(orders_fact: DataFrame, dim_date: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    """Orders and revenue per month of the date spine, months without
    orders kept with zeros. The fact is summed per month first; the month
    list is the spine's distinct months."""
    d = dim_date.select("date_key", "year_month")
    per_month = (orders_fact.join(calendar(dim_date, calendar_rows), "date_key").groupBy("year_month")
                 .agg(F.count(F.lit(1)).alias("orders"), F.sum("revenue_net").alias("revenue_net")))
    months = d.select("year_month").distinct()
    return (months.join(per_month, "year_month", "left")
            .select("year_month", F.coalesce("orders", F.lit(0)).alias("orders"),
                    F.coalesce("revenue_net", F.lit(0).cast("decimal(20,2)")).alias("revenue_net")))


def purchase_vs_delivery_months(orders: DataFrame) -> DataFrame:
    """Orders per month by purchase date beside orders per month by
    delivery date (all staged orders), full outer join on month."""
    p = (orders.groupBy(F.date_format("purchased_at", "yyyy-MM").alias("year_month"))
         .agg(F.count(F.lit(1)).alias("orders_purchased")))
    d = (orders.where(F.col("delivered_at").isNotNull())
         .groupBy(F.date_format("delivered_at", "yyyy-MM").alias("year_month"))
         .agg(F.count(F.lit(1)).alias("orders_delivered")))
    return (p.join(d, "year_month", "full")
            .select("year_month", F.coalesce("orders_purchased", F.lit(0)).alias("orders_purchased"),
                    F.coalesce("orders_delivered", F.lit(0)).alias("orders_delivered")))


def payment_methods(payments: DataFrame, exclude=("not_defined",)) -> DataFrame:
    """Payments, orders and value per payment type, placeholder types
    excluded; payments of unknown (NULL) type stay."""
    p = payments.where(~F.coalesce(F.col("payment_type").isin(*exclude), F.lit(False))) if exclude else payments
    return (p.groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("payments"),
                 F.count_distinct("order_id").alias("orders"),
                 F.sum("payment_value").alias("payment_value")))
