"""Connected components by alternating large-star and small-star joins; nothing goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for each end of a link; comp is the smallest node of its component.

    Large-star hangs a node's larger neighbours on its smallest one, small-star does so with the
    smaller neighbours; rounds grow with the logarithm of the number of nodes, and end when all edges
    are stars: each node hangs on one centre, and no centre on another node. Each round is written to the shared folder. Groups are
    grouped sums and joins that Spark can spill, never lists of neighbours. Self-links and repeated
    links are allowed; an empty table gives an empty result.
    """
    with scratch(links.sparkSession):
        edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components")
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            own = low.filter("m < u").select("u", F.col("m").alias("v"))
            hung = written(large.unionByName(own).filter("u <> v").distinct(), "components")
            least = hung.groupBy("u").agg(F.min("v").alias("m"))
            small = hung.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
            edges = written(small.filter("u <> v").distinct(), "components")
            hangs = edges.groupBy("u").agg(F.min("v").alias("comp"), F.count("*").alias("n"))
            if hangs.filter("n > 1").isEmpty() and edges.select("v").join(hangs.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
                break
        ends = links.select(F.col(a).alias("node")).unionByName(links.select(F.col(b).alias("node"))).distinct()
        return written(ends.join(hangs.select(F.col("u").alias("node"), "comp"), "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "components", keep=True)
