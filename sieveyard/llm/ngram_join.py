"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_components, shared_blocks
from .common import arrow_batches, row_type, scratch, words, written

_MULTIPLIERS = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_SLICES = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit: hashes are ordered and cut, so all bits must be alike."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams; shorter texts are one n-gram, empty ones have none."""
    from xxhash import xxh3_64_intdigest

    own = words(text or "")
    if not own:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, own), np.uint64, len(own))
    n = min(size, len(own))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        total = (total + h[k : len(h) - n + 1 + k]) * _MULTIPLIERS[k]
    return np.unique(_mix(total))


def _sketch_slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _scan(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """A row (id, n, digest) for each document, and each task's counts of n-grams by slot of a fixed-size sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        counts = np.zeros(1 << bits, np.uint32)
        names = ["id", "n", "digest", "slice", "counts"]
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
                slots, times = np.unique(_sketch_slots(np.concatenate(sets), bits), return_counts=True) if sets else ([], [])
                counts[slots] += times.astype(np.uint32)
                digests = [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())],
                    names=names,
                )
        for k, part in enumerate(np.split(np.minimum(counts, 65535).astype("<u2"), _SLICES)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["__id"].dataType)
    return docs.select("__id", "__text").mapInArrow(run, row_type(id=docs.schema["__id"].dataType, n="long", digest="binary", slice="int", counts="binary"))


def _merged(sketches: DataFrame, bits: int) -> np.ndarray:
    """The corpus sketch: 2 bytes a slot, a size that the parameter fixes. Sums saturate, so order of merging is free."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(blob), "<u2").astype(np.uint32)
                sums[k] = np.minimum(sums[k] + part, 65535) if k in sums else part
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.astype("<u2").tobytes(), 1)], pa.binary())], names=["slice", "counts"])

    counts = np.zeros(1 << bits, np.uint16)
    width = (1 << bits) // _SLICES
    for row in sketches.repartition(_SLICES // 4, "slice").mapInArrow(add, "slice int, counts binary").collect():
        part = np.frombuffer(zlib.decompress(bytes(row.counts)), "<u2")
        at = row.slice * width
        counts[at : at + width] = np.minimum(counts[at : at + width].astype(np.uint32) + part, 65535)
    return counts


def prefix(keys: np.ndarray, frequency: np.ndarray, bits: int, percent: int) -> np.ndarray:
    """The rarest n-grams of a set, as many as any partner must share one of.

    A partner shares at least ceil(percent * n / 100) n-grams, so it misses fewer than those left
    out plus one; under one order for all documents, both prefixes then have an n-gram in common.
    The sketch only sets the order: its errors cost time, never a pair.
    """
    n = len(keys)
    take = n - -(-percent * n // 100) + 1
    return keys[np.lexsort((keys, frequency[_sketch_slots(keys, bits)]))[:take]]


def _nodes(docs: DataFrame, frequency: np.ndarray, size: int, bits: int, percent: int) -> DataFrame:
    """(node, digest, id, h, n, keys): each distinct set once, with its prefix in order, and the id and XXH64 of a text that has it."""
    shared = docs.sparkSession.sparkContext.broadcast(frequency)  # 2 ** (bits + 1) bytes, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest, xxh64_intdigest

        counts, seen = shared.value, set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows, hashes, digests, sizes, keys = [], [], [], [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    s = shingle_set(text, size)
                    digest = xxh3_128_digest(s.tobytes())
                    if len(s) and digest not in seen:  # copies in one task need not be sent again
                        if len(seen) >= 1 << 20:
                            seen.clear()
                        seen.add(digest)
                        rows.append(k)
                        hashes.append(xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42))  # as Spark's xxhash64()
                        digests.append(digest)
                        sizes.append(len(s))
                        keys.append(prefix(s, counts, bits, percent).view(np.int64))
                if rows:
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in keys])]), pa.int32()), pa.array(np.concatenate(keys)))
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0).take(pa.array(rows)), pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), lists], names=["digest", "id", "h", "n", "keys"])

    sets = docs.select("__id", "__text").mapInArrow(run, row_type(digest="binary", id=docs.schema["__id"].dataType, h="long", n="long", keys="array<bigint>"))
    once = sets.groupBy("digest").agg(F.min_by(F.struct("id", "h", "n", "keys"), F.struct("id", "h")).alias("s")).select("digest", "s.*")
    return written(once.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")


def _overlaps(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose exact overlap passes, counted on their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = []
            for k, x in enumerate(a):
                if x != last:
                    last, mine = x, shingle_set(batch.column(2)[k].as_py(), size)
                other = shingle_set(batch.column(3)[k].as_py(), size)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                good.append(100 * both >= percent * (len(mine) + len(other) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(good, pa.bool_())], names=["a", "b", "linked"])

    t = texts
    joined = pairs.join(t.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(t.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, sketch_bits: int = 22, rounds: int = 2) -> DataFrame:
    """Documents linked by 100 * |A and B| >= percent * |A or B| of their word n-gram sets, as components.

    Returns id_col, n_shingles, component_id (the smallest id reachable, itself included). Every
    link between different sets counts: no cap on partners, buckets or candidates.

    Method: equal sets first become one node. The incidence matrix keeps each node's prefix of
    rarest n-grams, whose length follows from the size bound. Its product with itself is taken block
    by block (a block: the nodes of one n-gram). Nodes of one block that are already connected need
    no entry of the product, so each round multiplies one node of a block with those it isn't yet
    connected to, keeps pairs within the bounds that sizes and the place in the prefix set, counts their
    exact overlaps, and joins components; the last round takes all entries that are left. The product is thus exact up to
    links inside a component, and large groups of copies cost a multiple of their size, not its square.

    Null, empty or blank texts have an empty set and link with nothing; texts of fewer than size words
    have one n-gram. Repeated rows and ids keep a row each; rows of one id belong together. A null id
    takes part, and is only returned where a component has no other. Other columns are ignored,
    whatever their names. sketch_bits and rounds change the time, never the result.
    """
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    with arrow_batches(docs.sparkSession):
        seen = written(_scan(own, size, sketch_bits), "jaccard-scan")
    sets = seen.filter("slice is null").select("id", "n", "digest")
    with scratch(docs.sparkSession), arrow_batches(docs.sparkSession):
        frequency = _merged(seen.filter("slice is not null").select("slice", "counts"), sketch_bits)
        nodes = _nodes(own, frequency, size, sketch_bits, percent)
        index = shared_blocks(nodes.select("node", F.col("n").cast("int").alias("n"), F.posexplode("keys").alias("pos", "key")))
        members = index.select("node").distinct().join(nodes.select("node", F.col("id").alias("__own"), "h"), "node")
        found = own.join(members, own["__id"].eqNullSafe(members["__own"]) & (F.xxhash64("__text") == F.col("h")))
        texts = written(found.groupBy("__own", "h", "node").agg(F.first("__text").alias("text")).select("node", "text"), "jaccard-texts")

        def bound(a, b):
            """Two sets of sizes n share at most what stands from their first common key on, in either prefix."""
            most = F.least(a("n") - a("pos"), b("n") - b("pos"))
            return (F.lit(100 + percent) * most >= F.lit(percent) * (a("n") + b("n"))) & (F.lit(100) * F.least(a("n"), b("n")) >= F.lit(percent) * F.greatest(a("n"), b("n")))

        # A block's first node is the one with the fewest rarer n-grams: of near copies, the least edited, which links with most.
        comp = block_components(index, ["n", "pos"], bound, lambda pairs: _overlaps(pairs, texts, size, percent).filter("linked"), rounds, ("pos",))
        firsts = sets.filter("n > 0").groupBy("digest").agg(F.min("id").alias("id"))
        out = nodes.select("node", "digest").join(comp, "node", "left").select("digest", F.coalesce("comp", "node").alias("comp")).join(firsts, "digest")
        low = out.groupBy("comp").agg(F.min("id").alias("component_id"))
        label = written(out.join(low, "comp").select("digest", "component_id"), "jaccard-labels", keep=True)
    full = sets.filter("n > 0").join(label, "digest").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(sets.filter("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))
