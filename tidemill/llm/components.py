"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import discard, stored


#: Narrow tables of at most so many rows (some 10 MB) are taken by one task: no shuffle is worth its many small tasks for them.
SMALL = 250_000


def sized(rows: DataFrame) -> tuple[DataFrame, int]:
    """A stored narrow table, in one partition if it is small, and its number of rows."""
    n = rows.count()
    return (rows.coalesce(1) if n <= SMALL else rows), n


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; two nodes have one root if a path joins them.

    Rounds of contraction: every node goes to the neighbour (or itself) that is first in the round's random order, and links
    are drawn anew between the places reached, until none is left. A round removes a constant share of the nodes of
    any shape, chains and stars alike. Each round is written to the shared folder; a node with very many links is
    aggregated before the shuffle and its links are split by the join. Self-links make single nodes.
    """
    table = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    edges, left = sized(table)
    moves: list[DataFrame] = []
    while not moves or left:
        first = edges.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(len(moves)))).alias("b"))
        ahead = F.xxhash64("b", F.lit(len(moves))) < F.xxhash64("a", F.lit(len(moves)))
        move = stored(first.select("a", F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("to")), "moves")
        moves.append(move)
        ends = move.coalesce(1) if left <= SMALL else move
        half = edges.join(ends, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
        both = half.join(ends, "a").select(F.col("x").alias("a"), F.col("to").alias("b"))
        following = stored(both.where(F.col("a") != F.col("b")).distinct(), "links")
        discard(table)
        table = following
        edges, left = sized(table)
    out = moves[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for move in moves[1:]:
        out = out.join(move.select(F.col("a").alias("root"), "to"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root"))
    done = stored(out, "components")
    discard(table, *moves)
    return done
