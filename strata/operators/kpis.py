"""KPI tables over the gold star schema, refreshed in full or from the partials of changed months.

Each monthly KPI joins the fact to the date dimension (bounded by the number
of calendar days, so it is broadcast), keeps shipped lines and aggregates
per ``yyyy-MM``: partial aggregates are combined map-side, so only one row
per month and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import year_month
from strata.operators.ranking import global_rank
from strata.session import stage


def _flag(c: str) -> Column:
    """0/1 integer flag as a condition (non-zero is true)."""
    return F.col(c) != 0


def _ratio(num: Column, den: Column) -> Column:
    """num / den; NULL when den is 0."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def shipped_by_month(fact: DataFrame, dim_date: DataFrame, aggs: list[Column]) -> DataFrame:
    """Shipped lines joined to their calendar day, aggregated per month.

    Grouping is on the month's first day (cheap on every line); the
    ``yyyy-MM`` text is formatted on the aggregated rows only.
    """
    d = F.broadcast(dim_date.select("full_date", "date_key"))
    lines = fact.where(_flag("is_shipped")).join(d, "date_key", "inner")
    per_month = lines.groupBy(F.trunc("full_date", "month").alias("__month")).agg(*aggs)
    return per_month.select(year_month("__month").alias("year_month"),
                            *[c for c in per_month.columns if c != "__month"])


def monthly_measures(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every measure of the five monthly KPIs, in one pass over the shipped
    lines (one scan of the fact instead of one per KPI table).  Averages are
    kept as sum and count so each KPI derives them exactly."""
    met = F.when(_flag("sla_met"), 1).otherwise(0)
    late = F.when(_flag("is_late"), 1).otherwise(0)
    late_delay = F.when(_flag("is_late"), F.col("delay_days"))
    return shipped_by_month(fact, dim_date, [
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("gross_amount").alias("sum_gross"),
        F.sum(F.col("discount") * F.col("gross_amount")).alias("sum_discount_value"),
        F.sum(met).cast("bigint").alias("n_on_time"),
        F.sum(late).cast("bigint").alias("n_late"),
        F.sum("delay_days").cast("bigint").alias("sum_delay"),
        F.count("delay_days").alias("n_delay"),
        F.sum(late_delay).cast("bigint").alias("sum_late_delay"),
        F.count(late_delay).alias("n_late_delay"),
    ])


def partials(fact: DataFrame, dim_date: DataFrame, keep: list[str]) -> DataFrame:
    """Mergeable sums per month and product, and per the columns ``keep`` (what the table of
    partials is partitioned by, in whose ranges the rows come): every KPI is a sum of these rows.  Lines that are not shipped
    count in no sum, but their month has rows, so that it is known to have been read."""
    shipped = _flag("is_shipped")

    def of(value: Column, also: Column | None = None) -> Column:
        return F.sum(F.when(shipped if also is None else shipped & also, value))

    d = F.broadcast(dim_date.select("full_date", "date_key"))
    # Most lines are their month's only ones of the product, so combining before the shuffle
    # gains nothing.  The slim lines are dealt by ranges of what the rows are written and
    # grouped by: one shuffle, and few folders to a task.
    slim = fact.select(*dict.fromkeys([*keep, "date_key", "product_id", "is_shipped", "quantity", "gross_amount",
                                       "discount", "sla_met", "is_late", "delay_days"]))
    lines = slim.repartitionByRange(*keep, "product_id").join(d, "date_key", "left")
    return lines.groupBy(*keep, F.trunc("full_date", "month").alias("month"), "product_id").agg(
        F.count(F.when(shipped, 1)).alias("n_lines"),
        of(F.col("quantity")).cast("bigint").alias("sum_quantity"),
        of(F.col("gross_amount")).alias("sum_gross"),
        of(F.col("discount") * F.col("gross_amount")).alias("sum_discount_value"),
        F.count(F.when(shipped & _flag("sla_met"), 1)).alias("n_on_time"),
        F.count(F.when(shipped & _flag("is_late"), 1)).alias("n_late"),
        of(F.col("delay_days")).cast("bigint").alias("sum_delay"),
        F.count(F.when(shipped, F.col("delay_days"))).alias("n_delay"),
        of(F.col("delay_days"), _flag("is_late")).cast("bigint").alias("sum_late_delay"),
        F.count(F.when(shipped & _flag("is_late"), F.col("delay_days"))).alias("n_late_delay"))


def measures_of(parts: DataFrame) -> DataFrame:
    """``monthly_measures`` from ``partials``."""
    names = ["n_lines", "sum_gross", "sum_discount_value", "n_on_time", "n_late", "sum_delay", "n_delay",
             "sum_late_delay", "n_late_delay"]
    per_month = parts.where("n_lines > 0 AND month IS NOT NULL").groupBy("month").agg(
        *[F.sum(c).alias(c) for c in names])
    return per_month.select(year_month("month").alias("year_month"), *names)


def revenue_of(parts: DataFrame) -> DataFrame:
    """``product_revenue`` from ``partials``."""
    return parts.where("n_lines > 0").groupBy("product_id").agg(
        F.sum("sum_quantity").cast("bigint").alias("total_quantity"), F.sum("sum_gross").alias("total_revenue"))


def _c(name: str) -> Column:
    return F.col(name)


def billing_from(m: DataFrame) -> DataFrame:
    return m.select("year_month", _c("sum_gross").alias("total_billing"),
                    _c("n_lines").alias("total_orders")).orderBy("year_month")


def sla_from(m: DataFrame) -> DataFrame:
    return m.select("year_month", _c("n_lines").alias("total_orders"),
                    _c("n_on_time").alias("orders_on_time"),
                    _ratio(_c("n_on_time"), _c("n_lines")).alias("sla_rate"),
                    _ratio(_c("sum_delay"), _c("n_delay")).alias("avg_delay_days")
                    ).orderBy("year_month")


def delay_from(m: DataFrame) -> DataFrame:
    return m.select("year_month", _c("n_lines").alias("total_orders"),
                    _c("n_late").alias("total_late_orders"),
                    _ratio(_c("n_late"), _c("n_lines")).alias("late_rate"),
                    _ratio(_c("sum_late_delay"), _c("n_late_delay")).alias("avg_delay_days")
                    ).orderBy("year_month")


def average_ticket_from(m: DataFrame) -> DataFrame:
    return m.select("year_month", _c("sum_gross").alias("total_revenue"),
                    _c("n_lines").alias("total_orders"),
                    _ratio(_c("sum_gross"), _c("n_lines")).alias("avg_ticket")
                    ).orderBy("year_month")


def discount_from(m: DataFrame) -> DataFrame:
    return m.select("year_month", _c("sum_gross").alias("total_gross"),
                    _c("sum_discount_value").alias("total_discount_value"),
                    _ratio(_c("sum_discount_value"), _c("sum_gross")).alias("discount_rate")
                    ).orderBy("year_month")


def monthly_billing(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return billing_from(monthly_measures(fact, dim_date))


def sla(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return sla_from(monthly_measures(fact, dim_date))


def delay(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return delay_from(monthly_measures(fact, dim_date))


def average_ticket(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return average_ticket_from(monthly_measures(fact, dim_date))


def discount(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return discount_from(monthly_measures(fact, dim_date))


def product_revenue(fact: DataFrame) -> DataFrame:
    """Quantity and revenue of the shipped lines per product."""
    return (fact.where(_flag("is_shipped")).groupBy("product_id")
            .agg(F.sum("quantity").cast("bigint").alias("total_quantity"),
                 F.sum("gross_amount").alias("total_revenue")))


def top_products(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Revenue per product, its global rank and its share of all revenue.

    The fact is aggregated per product *before* the join (one row per
    product crosses the shuffle instead of every line); the grand total is a
    scalar subquery and the rank is computed without a single-partition
    window (``ranking.global_rank``).
    """
    return top_products_from(product_revenue(fact), dim_product)


def top_products_from(per_product: DataFrame, dim_product: DataFrame) -> DataFrame:
    p = dim_product.select("product_id", "product_name")
    agg = per_product.join(p, "product_id", "inner")
    # Read three times below (values, ranks, total): computed once, so that all
    # of them see the same sums.
    agg = stage(agg, "product-revenue")
    total = agg.agg(F.sum("total_revenue")).scalar()
    ranked = global_rank(agg, "total_revenue", "revenue_rank", descending=True)
    return (ranked.select("product_id", "product_name", "total_quantity", "total_revenue",
                          "revenue_rank",
                          _ratio(F.col("total_revenue"), total).alias("revenue_share"))
            .orderBy(F.col("total_revenue").desc()))


# KPI table -> projection of the shared monthly measures.
FROM_MEASURES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "agg_monthly_billing": billing_from,
    "agg_sla": sla_from,
    "agg_delay": delay_from,
    "agg_monthly_average_ticket": average_ticket_from,
    "agg_monthly_discount": discount_from,
}

MONTHLY_KPIS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "agg_monthly_billing": monthly_billing,
    "agg_sla": sla,
    "agg_delay": delay,
    "agg_monthly_average_ticket": average_ticket,
    "agg_monthly_discount": discount,
}


# The KPI tables the analytics layer refreshes, in order.
KPI_ORDER = ["agg_monthly_billing", "agg_sla", "agg_delay", "agg_top_products",
             "agg_monthly_average_ticket", "agg_monthly_discount"]
