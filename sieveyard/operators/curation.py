"""Keep-first dedup, seeded splits, leakage reports, multi-source union: all by keyed, deterministic order."""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import written

SPLITS = ("train", "validation", "test")


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key by the given total order; null keys are one key. One shuffle on the keys."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def global_rank(rows: DataFrame, digest: str, tie: Sequence[str | Column], name: str = "rank", total: str = "total") -> DataFrame:
    """rows with their 1-based place in the order of a hexadecimal digest, and the number of all, without sorting all in one task.

    The digest's first four digits cut the order into at most 65,536 parts of like size. Their sizes,
    summed up, are a table of that bound, joined back; inside a part a window counts.
    """
    cut = rows.withColumn("__part", F.substring(digest, 1, 4))
    sizes = cut.groupBy("__part").agg(F.count("*").alias("__n"))
    so_far = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, W.currentRow))
    before = sizes.select("__part", (so_far - F.col("__n")).alias("__before"), F.sum("__n").over(W.partitionBy()).alias(total))
    place = F.row_number().over(W.partitionBy("__part").orderBy(digest, *tie))
    return cut.join(F.broadcast(before), "__part").withColumn(name, (F.col("__before") + place).cast("long")).drop("__part", "__before")


def seeded(seed: int, *key: Column) -> Column:
    return F.sha2(F.concat(F.lit(str(seed)), *key), 256)


def _last_of(keys: DataFrame, sizes: list[tuple[str, int]], n: int) -> tuple[str, str] | None:
    """(digest, key) of the n-th row of keys (__h, __key) in that order; None for n = 0. sizes: rows by the digest's first four digits, in order."""
    if n < 1:
        return None
    for part, size in sizes:
        if n <= size:
            break
        n -= size
    ordered = F.row_number().over(W.orderBy("__h", "__key"))  # one part of at most 65,536
    row = keys.filter(F.substring("__h", 1, 4) == part).withColumn("n", ordered).filter(F.col("n") == n).first()
    return row["__h"], row["__key"]


def _split_of(digest: Column, key: Column, keys: DataFrame, validation: float, test: float) -> Column:
    """The split of a row by the place of its (digest, key) among keys (__h, __key, a row for each, written): an expression of two bounds.

    int(n * ratio) keys are test, as many by their ratio validation, in that order; the rest train. Doubles, truncated. Only sizes by the
    digest's first four digits (at most 65,536) and the two bounds go to the driver, and no row is moved.
    """
    sizes = [(r[0], r["count"]) for r in keys.groupBy(F.substring("__h", 1, 4).alias("part")).count().orderBy("part").collect()]
    total = sum(n for _, n in sizes)
    n_test, n_validation = int(total * float(test)), int(total * float(validation))
    out, own = F.lit("train"), F.struct(digest.alias("h"), key.alias("k"))
    for name, n in (("validation", n_test + n_validation), ("test", n_test)):
        last = _last_of(keys, sizes, n)
        if last:
            out = F.when(own <= F.struct(F.lit(last[0]).alias("h"), F.lit(last[1]).alias("k")), name).otherwise(out)
    return out


def split_rows(rows: DataFrame, key: str, validation: float = 0.05, test: float = 0.05, seed: int = 42) -> DataFrame:
    """Row-wise split by seeded order of a unique key. Rows of one content may part: see split_by_hash. One pass over the keys finds the bounds."""
    name = F.col(key).cast("string")
    keys = written(rows.select(seeded(seed, name).alias("__h"), name.alias("__key")), "split-keys")
    return rows.withColumn("split", _split_of(seeded(seed, name), name, keys, validation, test))


#: Most contents that the old order shuffles on the driver.
MOST_OLD_KEYS = 1_000_000


def split_by_hash(rows: DataFrame, hash_col: str, seq: str, validation: float = 0.05, test: float = 0.05, seed: int = 42, compat: str | None = None) -> DataFrame:
    """Split by content: all rows of one hash go to one split, cut by numbers of hashes.

    A row without a hash is a group of its own, named by its seq. One pass over the hashes finds the bounds; rows are then
    told apart by an expression and never moved. compat="mt" shuffles the sorted
    hashes with Python's generator on the driver, for exact old memberships of small sets (MOST_OLD_KEYS, else it raises); the
    default order is SHA-256 of seed and hash, in parallel.
    """
    key = F.when(F.coalesce(F.col(hash_col), F.lit("")) != "", F.col(hash_col)).otherwise(F.concat(F.lit("missing-content-hash-"), F.col(seq).cast("string")))
    groups = rows.select(key.alias("__key")).distinct()
    if compat == "mt":
        keys = sorted(r[0] for r in groups.limit(MOST_OLD_KEYS + 1).collect())
        if len(keys) > MOST_OLD_KEYS:
            raise ValueError(f"compat='mt' shuffles on the driver and takes at most {MOST_OLD_KEYS} contents")
        random.Random(seed).shuffle(keys)
        n_test, n_validation = int(len(keys) * test), int(len(keys) * validation)
        parts = [(k, "test" if i < n_test else "validation" if i < n_test + n_validation else "train") for i, k in enumerate(keys)]
        table = rows.sparkSession.createDataFrame(parts, "__key string, split string")
        return rows.withColumn("__key", key).join(table, "__key").drop("__key")
    keys = written(groups.select(seeded(seed, F.col("__key")).alias("__h"), "__key"), "split-keys")
    return rows.withColumn("split", _split_of(seeded(seed, key), key, keys, validation, test))


def split_statistics(rows: DataFrame, hash_col: str, split_col: str = "split") -> DataFrame:
    """(split, examples, unique_hashes); empty hashes do not count as hashes."""
    return rows.groupBy(F.col(split_col).alias("split")).agg(F.count("*").alias("examples"), F.countDistinct(F.when(F.col(hash_col) != "", F.col(hash_col))).alias("unique_hashes"))


def leaking_hashes(rows: DataFrame, hash_col: str, by: str = "split") -> DataFrame:
    """(content_hash, n, places): hashes in more than one split (or source), with those, sorted."""
    pairs = rows.filter(F.coalesce(F.col(hash_col), F.lit("")) != "").select(F.col(hash_col).alias("content_hash"), F.col(by).alias("place")).distinct()
    found = pairs.groupBy("content_hash").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("place")).alias("places"))
    return found.filter("n > 1")


def integrity_report(rows: DataFrame, hash_col: str, split_col: str = "split", by_hash: bool = True, most: int = 10_000) -> DataFrame:
    """One row: leakage_count, duplicate_hashes_across_splits (the first `most` by hash), split_statistics, split_by_content_hash.

    leaking_hashes gives all of the leaks as a table, whatever their number.
    """
    found = written(leaking_hashes(rows, hash_col, split_col), "split-leaks")
    first = found.orderBy("content_hash").limit(most)
    leaks = found.agg(F.count("*").alias("leakage_count")).crossJoin(
        first.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("content_hash", "places")))).alias("duplicate_hashes_across_splits"))
    )
    stats = split_statistics(rows, hash_col, split_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", F.struct("examples", "unique_hashes"))))).alias("split_statistics"))
    return leaks.crossJoin(stats).withColumn("split_by_content_hash", F.lit(by_hash))


def exclusion_reason(hash_: Column, missing: Column) -> Column:
    """Why a row does not go into the model-ready set: no hash first, then missing symbols; null if it does."""
    return F.when(F.coalesce(hash_, F.lit("")) == "", "missing_hash").when(F.size(missing) > 0, "missing_symbols")


def union_sources(parts: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """UNION ALL of (split, source, rows) in order, tagged with both; no dedup across sources."""
    tagged = [df.withColumns({"split": F.lit(split), "model_ready_source": F.lit(source), "part": F.lit(i)}) for i, (split, source, df) in enumerate(parts)]
    return reduce(DataFrame.unionByName, tagged)


def tag_parts(rows: DataFrame, source_col: str = "source", split_col: str = "split") -> DataFrame:
    """rows of several sources that are in one table already, tagged as union_sources would: model_ready_source, and `part`, by split and then source (null last).

    One pass: the sources, a row each, are numbered and joined back.
    """
    names = rows.select(F.col(source_col).alias("__s")).distinct()
    numbered = names.select("__s", (F.row_number().over(W.orderBy(F.col("__s").asc_nulls_last())) - 1).alias("__k"), F.count("*").over(W.partitionBy()).alias("__n"))
    place = F.array_position(F.array(*map(F.lit, SPLITS)), F.col(split_col)) - 1
    out = rows.join(numbered, F.col(source_col).eqNullSafe(F.col("__s")))
    return out.withColumns({"model_ready_source": F.col(source_col), "part": (place * F.col("__n") + F.col("__k")).cast("int")}).drop("__s", "__k", "__n")


def head(rows: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows by an explicit order (a top-k in each task, then one of n rows)."""
    return rows.orderBy(*order).limit(n)
