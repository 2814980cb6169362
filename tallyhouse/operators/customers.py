"""Tiers, loyalty points, customer codes and open choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import money, or_zero, status_is
from tallyhouse.operators.orders import lifetime_spend, padded
from tallyhouse.operators.sequence import dense_sequence
from tallyhouse.operators.skew import absent_from

# Least spend and point factor per tier, highest tier first.
TIER_RULES = (
    ("Platinum", 50_000_000, 3.0),
    ("Gold", 20_000_000, 2.0),
    ("Silver", 5_000_000, 1.5),
    ("Bronze", None, 1.0),
)
# Fixed value: money per loyalty point.
MONEY_PER_POINT = 10_000


def tier_of(spent: Column) -> Column:
    """Tier reached with the given spend."""
    *ranked, (lowest, _, _) = TIER_RULES
    tier = None
    for name, least, _ in ranked:
        tier = F.when(spent >= least, name) if tier is None else tier.when(spent >= least, name)
    return tier.otherwise(lowest)


def loyalty_points(spent: Column) -> Column:
    """Points for the spend, weighted by tier and rounded half-up to an integer."""
    points = F.floor(spent / MONEY_PER_POINT)
    tier = tier_of(spent)
    factor = None
    for name, _, weight in TIER_RULES:
        value = F.lit(weight).cast("decimal(3,1)")
        factor = F.when(tier == name, value) if factor is None else factor.when(tier == name, value)
    return F.round(points * factor, 0).cast("int")


def customer_tiers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with lifetime spend, tier and points."""
    spend = lifetime_spend(orders).withColumnRenamed("customer_id", "id")
    spent = F.col("total_spent")
    return (
        customers.select("id")
        .join(spend, "id", "left")
        .withColumns({"total_spent": money(or_zero("total_spent")), "completed_orders": or_zero("completed_orders")})
        .withColumns({"tier": tier_of(spent), "loyalty_points": loyalty_points(spent)})
        .withColumnRenamed("id", "customer_id")
    )


def customer_codes(customers: DataFrame, channels: DataFrame) -> DataFrame:
    """``KH_<channel>_001`` numbered per channel in id order, and the e-mail made from it."""
    names = channels.select(F.col("id").alias("order_channel_id"), F.col("name").alias("_channel"))
    numbered = dense_sequence(customers, "id", "_number", groups=["order_channel_id"])
    code = F.concat(F.lit("KH_"), F.col("_channel"), F.lit("_"), padded(F.col("_number"), 3))
    email = F.concat(F.lower(F.replace("customer_code", F.lit("_"), F.lit("."))), F.lit("@gmail.com"))
    return (
        numbered.join(names, "order_channel_id", "left")
        .withColumn("customer_code", code)
        .withColumn("email", email)
        .drop("_number", "_channel")
    )


def customers_without_cart(customers: DataFrame, cart: DataFrame) -> DataFrame:
    """Active customers who have no active cart."""
    open_carts = cart.filter(status_is("status", "active"))
    return absent_from(customers.filter("is_active"), open_carts, {"id": "customer_id"})


# Numbers in a word of a bitmap, whose sign stays free, and words of a chunk of the catalogue.
WORD, CHUNK = 62, 1024


def first_gaps(taken: DataFrame, owner: str, number: str) -> DataFrame:
    """Per owner: how many different numbers from 1 on it has (``owned``), and the first that it lacks (``gap``).

    The numbers of an owner become bits of words, which combine before the shuffle, so repeats cost nothing
    and an owner of very many numbers is spread by words. A chunk of words knows its first word that is not full; an owner
    has one row for each chunk in which it has anything.
    """
    place = F.col(number) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % WORD).cast("int"))
    words = (
        taken.select(owner, F.floor(place / WORD).cast("bigint").alias("_word"), bit.alias("_bit"))
        .groupBy(owner, "_word")
        .agg(F.bit_or("_bit").alias("_bits"))
    )
    # The lowest bits that are all set, counted: what changes by adding one, but the bit that it sets.
    ones = F.bit_count(F.col("_bits").bitwiseXOR(F.col("_bits") + 1)) - 1
    full = F.col("_bits") == (1 << WORD) - 1
    chunk = F.floor(F.col("_word") / CHUNK).cast("bigint")
    per_chunk = (
        words.withColumn("_chunk", chunk)
        .groupBy(owner, "_chunk")
        .agg(
            F.sum(F.bit_count("_bits")).alias("_n"),
            F.min(F.when(~full, F.col("_word") * WORD + ones)).alias("_open"),
            F.array_sort(F.collect_list(F.when(full, F.col("_word") % CHUNK))).alias("_full"),
        )
    )
    in_chunk = F.sequence(F.lit(0).cast("bigint"), F.lit(CHUNK - 1).cast("bigint"))
    # The first word that is not full may be one with some bits or one without any.
    not_full = F.get(F.array_except(in_chunk, "_full"), 0)
    at_word = F.when(F.size("_full") == 0, F.lit(0)).otherwise(not_full)
    empty = (F.col("_chunk") * CHUNK + at_word) * WORD
    # An open word begins no earlier than the first word that is not full, so the lower of the two is right.
    gap = F.when(at_word.isNotNull(), F.when(F.floor(F.col("_open") / WORD) == F.col("_chunk") * CHUNK + at_word, F.col("_open")).otherwise(empty))
    per_owner = (
        per_chunk.withColumn("_gap", gap)
        .groupBy(owner)
        .agg(
            F.sum("_n").alias("owned"),
            F.min("_gap").alias("_gap"),
            F.array_sort(F.collect_list(F.when(F.col("_gap").isNull(), F.col("_chunk")))).alias("_done"),
        )
    )
    # Whole chunks from the first on push the gap behind them; the first chunk that is not whole may be absent.
    chunks = F.sequence(F.lit(0).cast("bigint"), F.size("_done").cast("bigint"))
    first = F.get(F.array_except(chunks, "_done"), 0) * (CHUNK * WORD)
    found = F.when(F.col("_gap").isNull() | (F.col("_gap") >= first + CHUNK * WORD), first).otherwise(F.col("_gap"))
    return per_owner.select(owner, "owned", (found + 1).alias("gap"))


def open_choices(owners: DataFrame, owned: DataFrame, owner: str, product: DataFrame) -> DataFrame:
    """Per owner: how many active products are not owned yet and the first of them.

    ``owned`` holds (owner, product_id) pairs. Products are numbered 1..P;
    the first free one is the first number missing among the owned numbers,
    so no pair that is not owned is ever formed.
    """
    catalogue = dense_sequence(product.filter("is_active").select("id"), "id", "_number").select(
        F.col("id").alias("product_id"), "_number"
    )
    total = product.filter("is_active").agg(F.count(F.lit(1))).scalar()
    taken = owned.filter(F.col(owner).isNotNull()).select(owner, "product_id").join(catalogue, "product_id")
    free = (
        owners.select(F.col("id").alias(owner))
        .join(first_gaps(taken, owner, "_number"), owner, "left")
        .select(
            owner,
            (total - or_zero("owned")).alias("open_products"),
            F.coalesce("gap", F.lit(1)).cast("bigint").alias("_number"),
        )
    )
    return free.join(catalogue, "_number", "left").select(
        owner, "open_products", F.col("product_id").alias("first_product_id")
    )


def wishlist_candidates(customers: DataFrame, wishlist: DataFrame, product: DataFrame) -> DataFrame:
    """Per active customer: how many active products are not wished for yet, and the first of them."""
    return open_choices(customers.filter("is_active"), wishlist, "customer_id", product)
