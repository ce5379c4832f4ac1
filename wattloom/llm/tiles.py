"""Which documents to compare: blocks of clusters, and the tiles where blocks meet.

Documents that share a token must meet in one task, and no two more than once.  A
cluster of documents linked by any tokens may hold much of the corpus, although most of
its documents share nothing, so it is not compared as a whole:

1. A document's head is its token of the longest list.  Documents of one head form
   blocks of their own if they are many, and are pooled by the head's hash if few, so
   copies of one text mostly lie in the same few blocks.
2. Two blocks make a tile only if they hold a common token.  If the common tokens meet
   as many documents of a block as it has, the whole block goes to the tile; otherwise
   only the documents that have such a token.

A document goes to no more tiles than the lists of its tokens reach blocks, nor to more
than there are blocks in its cluster.  All tables here hold numbers only, and a list is
never gathered in one place: it appears as counts per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.workspace import materialize


def tiles(clusters: DataFrame, lists: DataFrame, block: int) -> DataFrame:
    """``ref, i, j, side, pack``: the tiles that each document goes to.

    ``clusters`` (``ref, cluster``) are components over shared tokens; ``lists``
    (``ref, first``) has each document's tokens, without repeats.  Any two documents of
    a common token meet in tile ``(i, j)`` of their blocks, on side 0 and 1, or in tile
    ``(i, i)``, both on side 0.  Tiles of fewer than ``block`` rows share a ``pack``
    with others, up to ``block`` rows together on average; others have their own.
    """
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    sized = clusters.join(sizes, "cluster")
    listed = materialize(
        lists.select("ref", "first")
        .join(sized.where(F.col("size") > block), "ref")
        .select("ref", "cluster", "size", F.explode("first").alias("token")),
        "postings",
    )
    blocks = materialize(
        _blocks(listed, block).union(
            sized.where(F.col("size") <= block).select("ref", F.col("cluster").alias("own"))
        ),
        "blocks",
    )
    placed = listed.select("ref", "token").join(blocks, "ref")
    spread = materialize(placed.groupBy("token", "own").agg(F.count("*").alias("met")), "spread")
    meets = spread.join(spread.select("token", F.col("own").alias("other")), "token").where("own <> other")

    held = blocks.groupBy("own").agg(F.count("*").alias("held"))
    sides = (
        meets.groupBy("own", "other")
        .agg(F.sum("met").alias("met"))
        .join(held, "own")
        .selectExpr("own", "other", "least(met, held) AS rows", "met >= held AS whole")
        .union(held.selectExpr("own", "own AS other", "held AS rows", "true AS whole"))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    )
    totals = sides.groupBy("i", "j").agg(F.sum("rows").alias("total"))
    sides = materialize(sides.join(totals, ["i", "j"]), "sides")
    rest = sides.where(F.col("total") < block).agg(F.sum("rows")).first()[0] or 0
    tile = F.xxhash64("i", "j")
    sides = sides.select(
        "own", "other", "whole", "i", "j",
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        F.when(F.col("total") < block, F.pmod(tile, F.lit(max(1, rest // block)))).otherwise(tile).alias("pack"),
    )
    columns = ["ref", "i", "j", "side", "pack"]
    whole = blocks.join(sides.where("whole"), "own").select(columns)
    some = (
        meets.join(sides.where("NOT whole"), ["own", "other"])
        .join(placed, ["token", "own"])
        .select(columns)
        .distinct()
    )
    return whole.union(some)


def _blocks(listed: DataFrame, block: int) -> DataFrame:
    """``ref, own``: the block of each document, a hash; equal hashes only merge blocks."""
    lengths = listed.groupBy("token").agg(F.count("*").alias("n"))
    heads = (
        listed.join(lengths, "token")
        .groupBy("ref", "cluster", "size")
        .agg(F.max(F.struct("n", "token"))["token"].alias("head"))
    )
    many = heads.groupBy("head").agg(F.count("*").alias("held"))
    parts = lambda n: F.ceil(F.col(n) / block)
    own = F.xxhash64("head", F.pmod(F.xxhash64("ref"), parts("held")))
    pooled = F.xxhash64("cluster", F.pmod(F.xxhash64("head"), parts("size")))
    return heads.join(many, "head").select(
        "ref", F.when(2 * F.col("held") >= block, own).otherwise(pooled).alias("own")
    )
