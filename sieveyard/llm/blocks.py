"""Components of the items that share a block and pass an exact check, without the square of a block's size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written
from .components import connected_components


def shared_blocks(index: DataFrame) -> DataFrame:
    """The rows of index (key, node, ...) whose key has two rows or more; one shuffle by key, written down."""
    return written(index.withColumn("times", F.count("*").over(W.partitionBy("key"))).filter("times > 1").drop("times"), "blocks")


def block_components(
    index: DataFrame, payload: list[str], fits: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], check: Callable[[DataFrame], DataFrame], rounds: int, first: tuple[str | Column, ...] = (),
    size: Callable[[Callable[[str], Column]], Column] | None = None, alike: Callable[[Column, Column], Column] | None = None, enough: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """(node, comp) for the nodes that have a link; every pair that shares a key and fits is either checked or already connected.

    index: key, node and payload columns. fits(a, b) is a cheap condition on two rows' payloads that
    every link meets under one of its keys at least; check(pairs of a, b) returns the linked ones.

    A round takes one node of each open block (the least by the columns `first`, then by a hash of the
    node and the round, so that many blocks take the same one) and checks it against the block's nodes of other components; the last round checks
    all pairs of a block that are still in different components. Blocks within one component are
    done. A group of copies so costs a few pairs for each member.

    With size(row), alike(n, m) and enough(keys, n, m), the last round counts the keys that a pair of alike sizes shares as it finds them, and
    keeps a pair whose count is enough for its sizes. alike is the part of fits that sizes alone decide, so it goes before the count: blocks that are left hold all keys that two nodes of different components share.
    """
    comp, links, tested = None, None, None
    for r in range(rounds):
        if comp is None:
            block = index.withColumn("comp", F.col("node"))
        else:
            block = written(index.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "blocks-open")
            open_keys = block.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
            block = block.join(open_keys, "key")
        ours = F.struct("node", "comp", *payload)
        last = r == rounds - 1
        if last:
            hubs = block.select("key", ours.alias("hub"))
        else:
            hubs = block.groupBy("key").agg(F.min_by(ours, F.struct(*first, F.xxhash64("node", F.lit(r)), "node")).alias("hub"))
        a, b = (lambda c: F.col(f"hub.{c}")), (lambda c: F.col(c))
        keep = fits(a, b) & (a("comp") != b("comp"))
        if last:
            keep &= a("node") < b("node")
        ends = [F.least(a("node"), b("node")).alias("a"), F.greatest(a("node"), b("node")).alias("b")]
        if last and enough is not None:
            apart = (a("comp") != b("comp")) & (a("node") < b("node")) & alike(size(a), size(b))
            found = block.join(hubs, "key").filter(apart).select(*ends, fits(a, b).alias("fits"), size(a).alias("n"), size(b).alias("m"))
            counted = found.groupBy("a", "b").agg(F.count("*").alias("keys"), F.bool_or("fits").alias("fits"), F.max("n").alias("n"), F.max("m").alias("m"))
            pairs = counted.filter(F.col("fits") & enough(F.col("keys"), F.col("n"), F.col("m"))).select("a", "b")
        else:
            pairs = block.join(hubs, "key").filter(keep).select(*ends).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "blocks-pairs")
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        found = written(check(pairs).select("a", "b"), "blocks-links")
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty() or comp is None:
            comp = connected_components(links)
    return comp
