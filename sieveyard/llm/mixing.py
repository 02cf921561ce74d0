"""Mixing sources to target weights by Sainte-Lague apportionment. Native expressions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_or_empty, word_count, written

#: Rows of one id and text that stay together on a line.
PIECE_ROWS = 1024


def source_targets(sizes: DataFrame, weights: tuple[int, ...], total_share: float, max_repeat: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source.

    Sources in code-point order, null last, take the weights in turn. Targets share total_share of
    all sizes by weight; one above max_repeat times its source's size stops there, and the excess is
    shared anew. In order of capacity for a weight, the stopped sources come first, so running sums
    find them without iterating. The windows hold one row a source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeat)
    everything = W.partitionBy()
    before = W.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    own = ranked.withColumns({
        "goal": F.sum("source_size").over(everything) * F.lit(float(total_share)), "all_weight": F.sum("weight").over(everything),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)), "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    own = own.withColumn("full", F.col("cap") * (F.col("all_weight") - F.col("weight_before")) < F.col("weight") * (F.col("goal") - F.col("cap_before")))
    own = own.withColumns({"cap_full": F.coalesce(F.sum(F.expr("if(full, cap, 0)")).over(everything), F.lit(0)), "weight_full": F.sum(F.expr("if(full, weight, 0)")).over(everything)})
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.try_divide(F.col("weight") * (F.col("goal") - F.col("cap_full")), (F.col("all_weight") - F.col("weight_full")).cast("double")))
    return own.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null, keeping the left side's."""
    other = right.withColumnsRenamed({c: f"__{c}" for c in on})
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on], how).drop(*[f"__{c}" for c in on])


def sainte_lague(cells: DataFrame, group: list[str], key: str) -> DataFrame:
    """cells with `seats`: `total` seats of each group dealt to the highest quotients weight / 1, 3, 5 ...

    cells: group columns, key, weight, total (the same in a group). Rounding weight * total / sum
    places all but at most half as many seats as there are cells; only quotients near those
    are listed, each cell's share of them and two more to either side, so rows follow the cells and
    never the seats. Ties go to the lower key. Cells without weight get none.
    """
    of = W.partitionBy(*group)
    quota = F.col("weight") * F.col("total") / F.sum("weight").over(of)
    near = cells.filter("weight > 0").withColumns({"quota": quota, "around": (F.ceil(F.col("weight") / F.sum("weight").over(of) * F.count("*").over(of) / 2) + 2).cast("long")})
    near = near.withColumn("low", F.greatest(F.floor(F.col("quota") + 0.5) - F.col("around"), F.lit(0)).cast("long"))
    near = near.withColumn("open", F.col("total") - F.sum("low").over(of))
    listed = near.select(*group, key, "open", "low", "weight", F.explode(F.sequence(F.col("low") + 1, (F.floor(F.col("quota") + 0.5) + F.col("around")).cast("long"))).alias("seat"))
    place = F.row_number().over(of.orderBy((F.col("weight") / (2 * F.col("seat") - 1)).desc(), key, "seat"))
    won = listed.withColumn("place", place).groupBy(*group, key).agg((F.first("low") + F.count_if(F.col("place") <= F.col("open"))).alias("seats"))
    return _joined(cells, won, [*group, key], "left").withColumn("seats", F.coalesce("seats", F.lit(0)))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
    total_share: float = 1.5, max_repeat: int = 2, block_words: int = 16, shard_words: int = 250_000, seed: int = 17,
) -> DataFrame:
    """Words that a mix takes from each document: id_col, size, source_size, target, taken.

    Blocks of block_words words are dealt to sources by Sainte-Lague on their targets, and each
    source's blocks to its shards (documents by seeded hash) on their sizes. In a shard, documents
    in seeded order lie on one line of words; the quota runs along it from the start, around again if
    it is longer than the line, and at most max_repeat times. Blocks are counted, never listed.
    A source has a shard for every shard_words of its words. Rows that repeat id and text are one item of
    a line while they are few; many are dealt to shards by thousands.

    Null texts have no words; null sources are one source, in the last place. Repeated rows count each. An
    empty table gives an empty result. Other columns are ignored. Reruns agree: order and shard come from hashes.
    """
    sizes = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text_col).alias("h"), word_count(text_or_empty(text_col)).alias("size"))
    sizes = sizes.groupBy("id", "source", "h", "size").agg(F.count("*").alias("times"))
    sizes = written(sizes.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {PIECE_ROWS}")))), "mix-sizes")
    sizes = sizes.withColumn("times", F.least(F.lit(PIECE_ROWS), F.col("times") - F.col("piece") * PIECE_ROWS)).withColumn("width", F.col("size") * F.col("times"))
    lines = sizes.groupBy("source").agg(F.greatest(F.ceil(F.sum("width") / shard_words), F.lit(1)).cast("int").alias("lines"))
    # A source may hold most rows: its rows are dealt to parts, and its number of lines stands in each.
    dealt = sizes.withColumn("part", F.pmod(F.xxhash64("id", "h"), F.lit(16)).cast("int"))
    sizes = _joined(dealt, lines.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(15)))), ["source", "part"]).drop("part")
    sizes = sizes.withColumn("shard", F.pmod(F.xxhash64("id", "h", "piece", F.lit(seed)), F.col("lines")).cast("int")).drop("lines")
    cells = written(sizes.groupBy("source", "shard").agg(F.sum("width").alias("weight")), "mix-cells")
    targets = written(source_targets(cells.groupBy("source").agg(F.sum("weight").alias("source_size")), weights, total_share, max_repeat), "mix-targets")
    blocks = targets.select(F.lit(0).alias("all"), F.col("source"), F.col("target").alias("weight"), F.round(F.sum("target").over(W.partitionBy()) / block_words).cast("long").alias("total"))
    quotas = sainte_lague(blocks, ["all"], "source").select("source", F.col("seats").alias("total"))
    dealt = _joined(cells, _joined(targets, quotas, ["source"]), ["source"])
    dealt = written(sainte_lague(dealt, ["source"], "shard"), "mix-quotas")
    own = _joined(sizes, dealt, ["source", "shard"])
    own = own.select("id", "h", "piece", "times", "source", "shard", "size", "width", "source_size", "target", "weight", F.least(F.col("seats") * block_words, F.col("weight") * max_repeat).alias("quota"))
    line = W.partitionBy("source", "shard").orderBy(F.xxhash64("id", "h", "piece", F.lit(seed + 1)), "id", "h", "piece").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = own.withColumn("end", F.sum("width").over(line))
    rounds = F.coalesce(F.expr("try_divide(quota - quota % weight, weight)").cast("long"), F.lit(0))
    rest = F.col("quota") - rounds * F.col("weight")
    again = F.greatest(F.lit(0), F.least(rest, "end") - (F.col("end") - F.col("width")))
    own = own.withColumns({"rounds": rounds, "again": again}).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    of_row = F.greatest(F.lit(0), F.least(F.col("size"), F.col("again") - (F.col("k") - 1) * F.col("size")))
    taken = F.when(F.col("size") > 0, F.col("rounds") * F.col("size") + of_row).otherwise(F.lit(0)).cast("long")
    return own.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))
