"""Discount rules, discounts in force and the split over order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, or_zero
from tallyhouse.operators.sequence import asof_join
from tallyhouse.operators.skew import key_sizes, salted_join
from tallyhouse.operators.validation import Rule, validate

# Fixed value: the highest percentage a discount may grant.
MAX_PERCENT = 70


def discount_rules() -> list[Rule]:
    percent = F.col("discount_type") == "%"
    return [
        Rule("start_after_end", F.col("start_date") <= F.col("end_date")),
        Rule("ends_before_creation", F.col("end_date") >= F.col("created_at")),
        Rule("percent_too_high", ~percent | (F.col("value") <= MAX_PERCENT)),
        Rule("value_not_positive", F.col("value") > 0),
    ]


def validate_discounts(discount: DataFrame) -> DataFrame:
    return validate(discount, discount_rules())


def in_force(discount: DataFrame, at: str) -> DataFrame:
    """Active discounts whose period contains the moment ``at``."""
    moment = F.lit(at).cast(discount.schema["start_date"].dataType)
    return discount.filter(
        F.col("is_active") & (F.col("start_date") <= moment) & (F.col("end_date") >= moment)
    )


# Levels of the halved time line: moments are counted in microseconds.
LEVELS = 60


def _moment(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _spans(begin: Column, end: Column) -> Column:
    """The moments from ``begin`` up to ``end``, cut into spans of 2^level that start at multiples of their length.

    Each level has two spans at most, so a period of any length is a short list.
    """

    def at(level: Column) -> Column:
        first = F.call_function("shiftright", begin + F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1, level)
        last = F.call_function("shiftright", end, level)
        span = lambda place: F.struct(level.alias("level"), place.alias("place"))
        open_ = first < last
        return F.array(F.when(open_ & (first % 2 != 0), span(first)), F.when(open_ & (last % 2 != 0), span(last - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at)))


def discount_timeline(discount: DataFrame) -> DataFrame:
    """``since, discounts, best_discount_id, best_value`` from every moment at which a period begins or has ended.

    Periods include both of their ends. The best discount has the largest value, the lowest id on a tie.
    Each period becomes a few spans of a halved time line, each moment looks at the one span of every level that
    holds it: two numbers combine per span, and no period is repeated by day or by moment.
    """
    periods = discount.filter(F.col("is_active") & (F.col("start_date") <= F.col("end_date"))).select(
        "id", "value", _moment("start_date").alias("begin"), (_moment("end_date") + 1).alias("end")
    )
    spans = (
        periods.select("id", "value", F.explode(_spans(F.col("begin"), F.col("end"))).alias("span"))
        .groupBy("span")
        .agg(F.count(F.lit(1)).alias("covered"), F.max(F.struct("value", (-F.col("id")).alias("place"))).alias("best"))
    )
    since = periods.select(F.explode(F.array("begin", "end")).alias("since")).distinct()
    levels = F.sequence(F.lit(0), F.lit(LEVELS))
    looked = F.transform(levels, lambda l: F.struct(l.alias("level"), F.call_function("shiftright", F.col("since"), l).alias("place")))
    return (
        since.select("since", F.explode(looked).alias("span"))
        .join(spans, "span", "left")
        .groupBy("since")
        .agg(F.sum("covered").alias("discounts"), F.max("best").alias("best"))
        .select(
            "since",
            F.coalesce("discounts", F.lit(0)).alias("discounts"),
            (-F.col("best.place")).alias("best_discount_id"),
            F.col("best.value").alias("best_value"),
        )
    )


def discounts_in_force(orders: DataFrame, discount: DataFrame) -> DataFrame:
    """Per order: how many discounts were in force and the largest one.

    The periods make a time line of states, and each order takes the state of its moment. Orders without any
    discount are kept, also those without a moment.
    """
    moments = orders.select(F.col("id").alias("order_id"), _moment("order_date").alias("_moment"))
    state = ["discounts", "best_discount_id", "best_value"]
    found = asof_join(moments, discount_timeline(discount), [], "_moment", "since", state)
    return found.select("order_id", or_zero("discounts").alias("discounts"), "best_discount_id", "best_value")


def discount_split(
    items: DataFrame, orders: DataFrame, discount: DataFrame, counted: DataFrame | None = None
) -> DataFrame:
    """Spread the discount of an order over its lines.

    A percentage applies to each line, a fixed sum is shared equally. The
    line amount never drops below 0. Lines of orders without a discount keep
    a discount of 0. Lines are counted in ``counted`` when given: the plain
    table is cheaper to count than a join made from it.
    """
    terms = discount.select(F.col("id").alias("discount_id"), "discount_type", "value")
    per_order = key_sizes(items if counted is None else counted, ["order_id"])
    order_terms = (
        orders.select(F.col("id").alias("order_id"), "discount_id")
        .join(terms, "discount_id", "left")
        .join(per_order, "order_id")
    )
    line = F.col("unit_price") * F.col("quantity")
    share = (
        F.when(F.col("discount_type") == "%", F.round(line * F.col("value") / 100, 2))
        .when(F.col("discount_type") == "fixed", F.round(F.col("value") / F.col("_rows"), 2))
        .otherwise(F.lit(0))
    )
    return (
        salted_join(items, order_terms, "order_id", "inner", sizes=per_order)
        .withColumn("discount_amount", money(share))
        .withColumn("amount", money(F.greatest(line - F.col("discount_amount"), F.lit(0))))
        .drop("_rows", "value")
    )
