"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored

#: A key with more rows than this, or than a share of all rows, does not meet its rows in one task.
LEAST_ROWS, MOST_KEYS = 100, 50_000


def join_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, spread: str, total: int
) -> DataFrame:
    """``rows`` with what ``per_key`` says of their key, in a join in which no task gets a hot key.

    ``per_key`` has a row for each key, with ``n``, how many of the ``total`` rows have it. Of keys
    with more than a ``MOST_KEYS``-th of all rows there are fewer than ``MOST_KEYS``, so they are sent to
    every task; their rows are spread by another column, the other keys' rows, few for each, meet
    their key's row in the shuffle.
    """
    said = [c for c in per_key.columns if c not in (key, "n")]
    often = F.col("n") > max(LEAST_ROWS, total // MOST_KEYS)
    hot = per_key.where(often).select(
        key, *(F.col(c).alias(f"hot_{c}") for c in said), F.lit(True).alias("hot")
    )
    is_hot = F.coalesce("hot", F.lit(False))
    marked = rows.join(F.broadcast(hot), key, "left").withColumns(
        {"hot": is_hot, "meets": F.when(is_hot, F.col(spread)).otherwise(F.col(key))}
    )
    cold = per_key.where(~often).select(F.lit(False).alias("hot"), F.col(key).alias("meets"), *said)
    return marked.join(cold, ["hot", "meets"], "left").select(
        *rows.columns, *(F.coalesce(f"hot_{c}", c).alias(c) for c in said)
    )


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    return (
        join_per_key(both, least, "a", "b", 2 * total)
        .where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    linked = join_per_key(edges, least, "a", "b", total).where("b <> m")
    others = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, of every node of edges (a, b).

    Alternates large and small stars until nothing changes, then every node is linked to its root.
    Each round is a stored table. Loops, repeated edges and either direction are fine;
    NULL ends are ignored; no edges give no rows. A node's edges are aggregated in the tasks that
    have them before any shuffle, and a node with very many edges meets what was found for it
    in those tasks too, so it is not gathered in one place.
    """
    edges = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        now = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if now == before or not now.n:
            break
        before = now
        larger = stored(_large_star(edges, now.n), "edges")
        edges = stored(_small_star(larger, now.n), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
