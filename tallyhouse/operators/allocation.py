"""Order lines take stock: each line from the fullest warehouse of the moment.

Lines of a product are served in their order. A line is served whole by the warehouse that has most left, if that
is enough, and what it takes is gone for the lines behind it. The stock of a product's warehouses is the state
of a fold over its lines, which Spark runs for all products at once.

A hot product would put its lines into one fold. Its stock only falls, so a line that wants more than the
fullest warehouse holds now is never served later. Slices of the lines that can still be served are
folded one after the other with the state handed on; all others, usually almost all, never enter a fold. After
a slice either every line in it was served, or the fullest warehouse fell below some line's quantity, so there are no
more rounds than different quantities and slices of served lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import or_zero
from tallyhouse.operators.sequence import HOT_ROWS, running_total, split_hot
from tallyhouse.session import materialise

# Lines that one inner fold takes; results of a product are put together from these parts.
PART = 256
# Lines of a hot product in a slice.
SLICE = 100_000

_STOCK = "array<struct<quantity:bigint,place:bigint,warehouse_id:bigint>>"
_TAKEN = "struct<inventory_id:bigint,allocated_warehouse_id:bigint,total_before:bigint>"
# Names of fields repeat columns of the lines, so the line is only asked for its quantity. One-element arrays give a value a name.
_SERVED = """named_struct(
    'stock', transform(state.stock, s -> if(s.place = top.place,
        named_struct('quantity', s.quantity - greatest(line.quantity, 0), 'place', s.place, 'warehouse_id', s.warehouse_id), s)),
    'total', state.total - greatest(line.quantity, 0),
    'done', array_append(state.done, named_struct(
        'inventory_id', -top.place, 'allocated_warehouse_id', top.warehouse_id, 'total_before', state.total)))"""
_REFUSED = """named_struct('stock', state.stock, 'total', state.total, 'done', array_append(state.done, named_struct(
    'inventory_id', cast(null as bigint), 'allocated_warehouse_id', cast(null as bigint), 'total_before', state.total)))"""
_FOLD = f"""aggregate(
    transform(sequence(0, (size(_lines) - 1) div {PART}), k -> slice(_lines, k * {PART} + 1, {PART})),
    named_struct('stock', coalesce(_stock, cast(array() as {_STOCK})), 'total', _total, 'done', cast(array() as array<array<{_TAKEN}>>)),
    (outer, part) -> transform(array(aggregate(
        part,
        named_struct('stock', outer.stock, 'total', outer.total, 'done', cast(array() as array<{_TAKEN}>)),
        (state, line) -> transform(array(array_max(state.stock)), top -> if(top.quantity >= line.quantity, {_SERVED}, {_REFUSED}))[0]
    )), inner -> named_struct('stock', inner.stock, 'total', inner.total, 'done', array_append(outer.done, inner.done)))[0])"""


def stock_vectors(inventory: DataFrame) -> DataFrame:
    """Per product: the stock of every warehouse, in an array, and their sum."""
    stock = F.col("quantity").cast("bigint")
    entry = F.struct(stock.alias("quantity"), (-F.col("id")).alias("place"), F.col("warehouse_id").cast("bigint").alias("warehouse_id"))
    held = inventory.filter("quantity is not null and product_id is not null")
    return held.groupBy("product_id").agg(F.collect_list(entry).alias("_stock"), F.sum(stock).alias("_total"))


def _folded(lines: DataFrame, vectors: DataFrame, fields: Sequence[Column]) -> DataFrame:
    """Per product: its lines in order and the fold over them."""
    grouped = lines.groupBy("product_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_lines"))
    return grouped.join(vectors, "product_id", "left").withColumn("_fold", F.expr(_FOLD))


def _each_line(folded: DataFrame) -> DataFrame:
    zipped = F.arrays_zip("_lines", F.flatten("_fold.done").alias("_taken"))
    return folded.select("product_id", F.explode(zipped).alias("_row")).select("product_id", "_row._lines.*", "_row._taken.*")


def _judged(served: DataFrame) -> DataFrame:
    short = F.col("total_before").isNull() | (F.col("total_before") < F.col("quantity"))
    reason = F.when(F.col("inventory_id").isNull(), F.when(short, "insufficient_stock").otherwise("no_single_warehouse"))
    return served.withColumn("reject_reason", reason).drop("total_before")


def _hot_lines(hot: DataFrame, vectors: DataFrame, order: Sequence[str], hot_rows: int, slice_rows: int) -> DataFrame:
    """Lines of hot products with what they took; see the module's text."""
    rows = materialise(hot.withColumn("_row", F.monotonically_increasing_id()))
    place = F.struct(*order)
    wanted = rows.select("product_id", place.alias("_at"), "quantity", "_row")
    # One row for each hot product from here on, and one small row for each line of a slice.
    opening = materialise(rows.select("product_id").distinct().join(vectors, "product_id"))
    state = opening.withColumn("_last", F.lit(None).cast(wanted.schema["_at"].dataType))
    taken = []
    nth = F.row_number().over(Window.partitionBy("product_id").orderBy("_at"))
    while True:
        now = F.broadcast(state.select("product_id", "_last", F.array_max("_stock")["quantity"].alias("_most")))
        able = wanted.join(now, "product_id").filter("quantity <= _most and (_last is null or _at > _last)")
        slice_ = able.withColumn("_nth", nth).filter(F.col("_nth") <= slice_rows).drop("_nth")
        fields = [F.col(c) for c in ("_at", "quantity", "_row")]
        folded = materialise(_folded(slice_, state.drop("_last"), fields))
        if folded.isEmpty():
            break
        taken.append(_each_line(folded).filter("inventory_id is not null").select("_row", "inventory_id", "allocated_warehouse_id"))
        onward = folded.select("product_id", F.col("_fold.stock").alias("_s"), F.col("_fold.total").alias("_t"), F.element_at("_lines", -1)["_at"].alias("_l"))
        state = materialise(
            state.join(onward, "product_id", "left").select(
                "product_id", F.coalesce("_s", "_stock").alias("_stock"), F.coalesce("_t", "_total").alias("_total"), F.coalesce("_l", "_last").alias("_last")
            )
        )
    empty = rows.select("_row", F.lit(None).cast("bigint").alias("inventory_id"), F.lit(None).cast("bigint").alias("allocated_warehouse_id")).limit(0)
    served = empty
    for part in taken:
        served = served.unionByName(part)
    # What was there when a refused line came: the opening stock without what was taken by then.
    known = rows.join(served, "_row", "left").withColumn(
        "_took", F.when(F.col("inventory_id").isNotNull(), F.greatest(F.col("quantity"), F.lit(0))).otherwise(0).cast("bigint")
    )
    summed = running_total(known, ["product_id"], order, "_took", "_gone", hot_rows)
    totals = F.broadcast(opening.select("product_id", "_total"))
    return summed.join(totals, "product_id", "left").withColumn("total_before", F.col("_total") - (F.col("_gone") - F.col("_took")))


def allocate_in_turn(
    items: DataFrame,
    inventory: DataFrame,
    order: Sequence[str] = ("created_at", "id"),
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE,
) -> DataFrame:
    """Every line with ``inventory_id, allocated_warehouse_id, reject_reason``, stock being used up line by line.

    ``order`` must be a total order of a product's lines. Of equally full warehouses the lowest inventory id serves. A line that
    finds less stock in all warehouses together is refused as ``insufficient_stock``, one that no single warehouse
    can serve as ``no_single_warehouse``. A line without a positive quantity takes nothing. A line without a quantity cannot be served, one without a
    product or with an unstocked one finds no stock. A stock row without a quantity is left out.
    """
    columns = [c for c in items.columns if c != "product_id"]
    rest = [c for c in columns if c not in order]
    vectors = stock_vectors(inventory)
    ordinary, hot = split_hot(items, ["product_id"], hot_rows)
    plain = _judged(_each_line(_folded(ordinary, vectors, [F.col(c) for c in (*order, *rest)])))
    result = [*items.columns, "inventory_id", "allocated_warehouse_id", "reject_reason"]
    if hot is None:
        return plain.select(*result)
    return plain.select(*result).unionByName(_judged(_hot_lines(hot, vectors, order, hot_rows, slice_rows)).select(*result))


def remaining_stock(items: DataFrame, inventory: DataFrame, allocated: DataFrame | None = None, order: Sequence[str] = ("created_at", "id")) -> DataFrame:
    """Stock rows after the lines took theirs: ``id, product_id, warehouse_id, opening, taken, quantity``."""
    served = allocate_in_turn(items, inventory, order) if allocated is None else allocated
    took = served.filter("inventory_id is not null").groupBy(F.col("inventory_id").alias("id")).agg(
        F.sum(F.greatest(F.col("quantity"), F.lit(0))).alias("taken")
    )
    return inventory.join(took, "id", "left").select(
        "id", "product_id", "warehouse_id", F.col("quantity").cast("bigint").alias("opening"), or_zero("taken").alias("taken"),
        (F.col("quantity") - or_zero("taken")).alias("quantity"),
    )
