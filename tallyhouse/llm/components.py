"""Connected components of a table of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import materialise


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, root)`` for each id in ``links (a, b)``: root is the smallest id reachable.

    Each round keeps for every id the link to its smallest neighbour, links
    its other neighbours to that one, and then lets every id skip to where
    its own target points. Roots sink to the smallest id and path lengths halve,
    so the rounds grow with the logarithm of the longest path. Every round's
    links are checkpointed. Hot ids are targets only after one round; the
    join on a target meets one row per id on its other side, which is stored
    first so that both sides are shuffled alike and Spark can split a large partition.

    Links of an id to itself and links with a null are ignored. Ids without any
    other link are absent from the result.
    """
    links = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(rounds):
        nearest = materialise(links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        # The other, larger neighbours of an id hang on its smallest one.
        forked = nearest.where("n > 1").select("a", "m")
        hung = links.join(forked, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        onward = nearest.select(F.col("a").alias("m"), F.col("m").alias("next"))
        jumped = nearest.join(onward, "m", "left").select("a", F.coalesce("next", "m").alias("b"), F.col("next").isNotNull().alias("moved"))
        jumped = materialise(jumped)
        settled = jumped.where("moved").isEmpty() and nearest.where("n > 1").isEmpty()
        if settled:
            return jumped.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
                jumped.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
            )
        links = materialise(jumped.select("a", "b").unionByName(hung).distinct())
    raise RuntimeError(f"links did not settle in {rounds} rounds")
