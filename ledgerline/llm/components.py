"""Connected components of an edge table, as Spark joins and aggregates.

Alternates the two classic star contractions until nothing changes: each node's
larger neighbours are hung onto its smallest neighbour (large star), then its
smaller ones are (small star).  A round is an aggregate with map-side combine
(the minimum per node, so a hot node never gathers its neighbours) and an equi
join that adaptive execution may split.  Nodes and edges stay in tables; the
driver sees one row of counts per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _hang(arcs: DataFrame) -> DataFrame:
    """Arcs (a, b) -> arcs with the smallest of {a} and a's neighbours, ``m``."""
    lows = arcs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return arcs.join(lows, "a")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) LONG edges -> (node, root): the smallest node reachable, for every
    node that has an edge to another node.

    Self loops and repeated edges are allowed; rows with a NULL end are ignored;
    an empty edge table gives an empty result.
    """
    e = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _hang(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = _hang(large)
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = saved(small.select("x.a", "x.b").where("a <> b").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError("components did not settle; raise max_rounds")
